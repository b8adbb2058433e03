"""The shipped rule sets. The clock is always a parameter, so both halves of a split agree."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import QualityGate, Rule
from strata.session import stage

# Symbols the trade feed may carry.
KNOWN_SYMBOLS = (
    "BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT",
    "AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "NVDA", "SPY", "QQQ",
)
# Spellings of a bar width that a bar feed may carry.
BAR_TIMEFRAMES = ("1Min", "5Min", "15Min", "1Hour", "1Day", "1m", "5m", "1h", "1d")
# Spellings of the canonical one-minute bar, the only input of the wider bars.
ONE_MINUTE = ("1m", "1Min")
# Stored tables spell a width in one way, so that one bar has one key.
SHORT_TIMEFRAMES = {"1Min": "1m", "5Min": "5m", "1Hour": "1h", "1Day": "1d"}


def short_timeframe(column: str = "timeframe") -> Column:
    spelled = F.col(column)
    for long, short in SHORT_TIMEFRAMES.items():
        spelled = F.when(F.col(column) == long, short).otherwise(spelled)
    return spelled


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _clock(as_of: datetime | str | None) -> str:
    return "current_timestamp()" if as_of is None else f"TIMESTAMP'{as_of}'"


def trade_gate(as_of: datetime | str | None = None) -> QualityGate:
    """Silver trade rules; names, codes, severities and texts are fixed values."""
    crypto = "symbol RLIKE 'USDT$'"
    return QualityGate([
        Rule("BR-001", "PRICE_NOT_POSITIVE", "error", "price > 0", "price > 0"),
        # Both branches are spelled out so that a NULL symbol matches neither.
        Rule("BR-002", "PRICE_OUT_OF_RANGE", "error", "price in sanity range",
             f"CASE WHEN {crypto} THEN price BETWEEN 0.000001 AND 10000000 "
             f"WHEN NOT {crypto} THEN price BETWEEN 0.01 AND 1000000 END"),
        Rule("BR-003", "QUANTITY_NOT_POSITIVE", "error", "quantity > 0", "quantity > 0"),
        Rule("BR-004", "SYMBOL_UNKNOWN", "error", "symbol in allowlist",
             f"symbol IN ({_quoted(KNOWN_SYMBOLS)})"),
        Rule("BR-005", "EVENT_TS_INVALID", "error",
             "event_ts not null, not >1min future, not before 2015",
             "event_ts BETWEEN TIMESTAMP'2015-01-01' "
             f"AND {_clock(as_of)} + INTERVAL '1' MINUTE"),
        Rule("BR-006", "TRADE_ID_MISSING", "error", "trade_id not null", "trade_id IS NOT NULL"),
        Rule("BR-007", "LATE_ARRIVAL", "warning", "ingest_ts - event_ts < 5 minutes",
             "unix_seconds(ingest_ts) - unix_seconds(event_ts) < 300"),
    ])


def bar_gate() -> QualityGate:
    """Silver bar rules; names, codes, severities and texts are fixed values."""
    return QualityGate([
        Rule("BAR-001", "BAR_TIMESTAMP_NULL", "error", "bar_open_ts not null",
             "bar_open_ts IS NOT NULL"),
        Rule("BAR-002", "BAR_SYMBOL_NULL", "error", "symbol not null", "symbol IS NOT NULL"),
        Rule("BAR-003", "BAR_TIMEFRAME_INVALID", "error", "timeframe known",
             f"timeframe IN ({_quoted(BAR_TIMEFRAMES)})"),
        Rule("BAR-004", "BAR_HIGH_LOW_INVERTED", "error", "high >= low", "high >= low"),
        Rule("BAR-005", "BAR_OPEN_OUT_OF_RANGE", "error", "low <= open <= high",
             "open BETWEEN low AND high"),
        Rule("BAR-006", "BAR_CLOSE_OUT_OF_RANGE", "error", "low <= close <= high",
             "close BETWEEN low AND high"),
        Rule("BAR-007", "BAR_VOLUME_NEGATIVE", "error", "volume >= 0", "volume >= 0"),
    ])


def gold_bar_gate() -> QualityGate:
    """Gold bar rules; names, codes, severities and texts are fixed values."""
    return QualityGate([
        Rule("GR-001", "BAR_INCONSISTENT", "error",
             "high >= max(open, close), low <= min(open, close), high >= low",
             "high >= low AND open BETWEEN low AND high AND close BETWEEN low AND high"),
        Rule("GR-002", "VOLUME_NEGATIVE", "error", "volume >= 0", "volume >= 0"),
    ])


BAR_KEY = ("symbol", "bar_open_ts", "timeframe")


def repeated_keys(df: DataFrame, key=BAR_KEY) -> DataFrame:
    """GR-003: keys held by more than one row. Counts are combined before the shuffle, so a key
    that holds a third of the table costs one partial row per task."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def split_on_unique_key(df: DataFrame, key=BAR_KEY) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is unique, and all rows of repeated keys.

    The repeated keys are stored first. Their size is known then: few are broadcast and the rows stay
    where they are; many meet the rows in a plain join of two exchanges, in which adaptive execution
    cuts a hot key over several tasks. NULL keys are compared as values.
    """
    repeated = stage(
        df.sparkSession,
        repeated_keys(df, key).select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(key))),
        "repeated-keys",
    )
    match = F.lit(True)
    for i, c in enumerate(key):
        match = match & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return df.join(repeated, match, "left_anti"), df.join(repeated, match, "left_semi")
