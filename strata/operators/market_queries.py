"""The analytic queries on Silver trades, as SQL text with parameters.

`as_of` is a literal for stored tables, so that day partitions are pruned at planning time; without
it the anchor is the newest value in the table, found by a scalar subquery.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from strata.sources.tables import day

# The symbols of the cross-section query.
CROSS_SECTION = ("BTCUSDT", "ETHUSDT", "SOLUSDT", "AAPL", "MSFT")
# The symbols of its richer variant.
CROSS_SECTION_CRYPTO = ("BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT")

_LAST_DAY = "(SELECT max(event_date) FROM {trades})"
_LAST_TS = "(SELECT max(event_ts) FROM {trades})"


def _day_anchor(as_of: date | datetime | str | None) -> str:
    return _LAST_DAY if as_of is None else f"DATE'{day(as_of)}'"


def _ts_anchor(as_of: datetime | str | None) -> str:
    return _LAST_TS if as_of is None else f"TIMESTAMP'{as_of}'"


def _run(trades: DataFrame, sql: str, **args) -> DataFrame:
    return trades.sparkSession.sql(sql, args=args, trades=trades)


def single_symbol(trades: DataFrame, symbol: str = "BTCUSDT", as_of=None) -> DataFrame:
    """All trades of one symbol from the last day on."""
    return _run(
        trades,
        "SELECT * FROM {trades} WHERE symbol = :symbol "
        f"AND event_date >= {_day_anchor(as_of)} - INTERVAL '1' DAY",
        symbol=symbol,
    )


def single_symbol_summary(trades: DataFrame, symbol: str = "BTCUSDT", as_of=None) -> DataFrame:
    """Count and average price of one symbol from the last day on."""
    return _run(
        trades,
        "SELECT count(*) AS trade_count, avg(price) AS avg_price FROM {trades} "
        "WHERE symbol = :symbol "
        f"AND event_date >= {_day_anchor(as_of)} - INTERVAL '1' DAY",
        symbol=symbol,
    )


def hourly_vwap(
    trades: DataFrame, symbol: str = "BTCUSDT", as_of=None, ordered: bool = False
) -> DataFrame:
    """Hourly vwap and volume of one symbol over a week."""
    return _run(
        trades,
        "SELECT date_trunc('HOUR', event_ts) AS hour, "
        "try_divide(sum(notional), sum(quantity)) AS vwap, sum(quantity) AS volume "
        "FROM {trades} WHERE symbol = :symbol "
        f"AND event_date >= {_day_anchor(as_of)} - INTERVAL '7' DAY "
        "GROUP BY 1" + (" ORDER BY 1" if ordered else ""),
        symbol=symbol,
    )


def cross_section(
    trades: DataFrame, symbols: tuple[str, ...] = CROSS_SECTION, as_of=None
) -> DataFrame:
    """Volume, trade count and average price per symbol over the last hour.

    The day condition follows from the time condition; it is spelled out to prune partitions.
    """
    names = ", ".join(f"'{name}'" for name in symbols)
    start = f"{_ts_anchor(as_of)} - INTERVAL '1' HOUR"
    return _run(
        trades,
        "SELECT symbol, sum(quantity) AS volume, count(*) AS trade_count, avg(price) AS avg_price "
        f"FROM {{trades}} WHERE symbol IN ({names}) AND event_ts >= {start} "
        f"AND event_date >= to_date({start}) GROUP BY symbol",
    )


def count_by_symbol(trades: DataFrame) -> DataFrame:
    """Trades per symbol over the whole table."""
    return _run(trades, "SELECT symbol, count(*) AS trade_count FROM {trades} GROUP BY symbol")
