"""Column expressions for prices, ratios, ordering and time buckets.

All of them are built-in expressions that stay inside whole-stage code generation, and all of them
yield NULL instead of raising on bad input, so that bad rows reach the quality rules.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import MONEY

# The bar widths of the Gold layer, in seconds.
TIMEFRAME_SECONDS = {"1m": 60, "5m": 300, "1h": 3600, "1d": 86400}

_MICROS = 1_000_000


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return as_col(c).try_cast(MONEY)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole-second difference of two timestamps, each floored to its second first."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def bucket_start(ts: Column | str, timeframe: str) -> Column:
    """Start of the UTC bucket holding `ts`, by integer arithmetic on the microsecond value."""
    if timeframe not in TIMEFRAME_SECONDS:
        raise ValueError(f"unknown timeframe {timeframe!r}; use one of {list(TIMEFRAME_SECONDS)}")
    micros = F.unix_micros(as_col(ts))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(TIMEFRAME_SECONDS[timeframe] * _MICROS)))


def vwap(notional: Column, volume: Column) -> Column:
    """Volume-weighted price of two summed columns; NULL for an empty volume."""
    return F.try_divide(notional, volume)


def trade_order(ts: Column | str = "event_ts", trade_id: Column | str = "trade_id") -> Column:
    """One sortable number per trade: event time first, exchange sequence number second.

    Opening and closing prices need a total order, and a struct holding a string would push the
    aggregate from hash to sort. A decimal of micros x 2^64 + (sequence + 2^63) keeps the hash aggregate
    and is exact for every 64-bit sequence number, negative ones too; ids without a number fall back to
    their hash.
    """
    ident = as_col(trade_id)
    sequence = F.coalesce(
        F.substring_index(ident, ":", -1).try_cast("bigint"), F.xxhash64(ident)
    )
    micros = F.unix_micros(as_col(ts)).cast("decimal(19,0)")
    return micros * F.lit(Decimal(2**64)) + (F.lit(Decimal(2**63)) + sequence)
