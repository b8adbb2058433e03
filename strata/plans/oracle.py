"""Building blocks of the oracle SQL: the same inputs, written independently for DuckDB.

Prices and quantities are kept as integers (ten-thousandths), so sums are exact and rounding half up
can be written as integer division.
"""

from __future__ import annotations

from strata.operators.rules import KNOWN_SYMBOLS
from strata.plans.inputs import AS_OF, SYMBOL

_KNOWN = ", ".join(f"'{s}'" for s in KNOWN_SYMBOLS)

TRADES = f"""
t AS (
  SELECT event_id, {SYMBOL} AS symbol,
         CAST(value AS DECIMAL(18,4)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,4)) AS quantity,
         ts AS event_ts, ts + (event_id % 400) * INTERVAL 1 SECOND AS ingest_ts,
         user_id % 2 = 0 AS buyer_is_maker
  FROM events),
trades AS (
  SELECT *, CAST(event_ts AS DATE) AS event_date,
         CASE WHEN buyer_is_maker THEN 'sell' ELSE 'buy' END AS side,
         'binance:' || event_id AS trade_id,
         CAST(epoch_us(ingest_ts) // 1000000 - epoch_us(event_ts) // 1000000 AS INTEGER) AS late_arrival_sec,
         CAST(price * 10000 AS BIGINT) AS p4, CAST(quantity * 10000 AS BIGINT) AS q4
  FROM t)"""

# Failing is FALSE or NULL, hence coalesce.
FLAGS = f"""
flags AS (
  SELECT *,
    NOT coalesce(price > 0, false) AS f1,
    NOT coalesce(CASE WHEN regexp_matches(symbol, 'USDT$') THEN price BETWEEN 0.000001 AND 10000000
                 ELSE price BETWEEN 0.01 AND 1000000 END, false) AS f2,
    NOT coalesce(quantity > 0, false) AS f3,
    NOT coalesce(symbol IN ({_KNOWN}), false) AS f4,
    NOT coalesce(event_ts >= TIMESTAMP '2015-01-01' AND event_ts <= TIMESTAMP '{AS_OF}' + INTERVAL 1 MINUTE, false) AS f5,
    NOT coalesce(trade_id IS NOT NULL, false) AS f6,
    NOT coalesce(late_arrival_sec < 300, false) AS f7
  FROM trades),
judged AS (
  SELECT *, f1 OR f2 OR f3 OR f4 OR f5 OR f6 AS bad,
    concat_ws(',', CASE WHEN f1 THEN 'PRICE_NOT_POSITIVE' END, CASE WHEN f2 THEN 'PRICE_OUT_OF_RANGE' END,
      CASE WHEN f3 THEN 'QUANTITY_NOT_POSITIVE' END, CASE WHEN f4 THEN 'SYMBOL_UNKNOWN' END,
      CASE WHEN f5 THEN 'EVENT_TS_INVALID' END, CASE WHEN f6 THEN 'TRADE_ID_MISSING' END,
      CASE WHEN f7 THEN 'LATE_ARRIVAL' END) AS codes
  FROM flags)"""

CLEAN = f"{TRADES},{FLAGS},\nclean AS (SELECT * FROM judged WHERE NOT bad)"

TRADE_COLS = """event_ts, ingest_ts, event_date, 'binance' AS source, 'crypto' AS asset_class, symbol, side,
  CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
  CAST(price * quantity AS DOUBLE) AS notional, trade_id, late_arrival_sec"""


def half_up(numerator: str, denominator: str) -> str:
    """Quotient of non-negative integers rounded half up to an integer; NULL for a zero divisor."""
    return f"(2 * ({numerator}) + ({denominator})) // nullif(2 * ({denominator}), 0)"


# vwap in millionths: p4 x q4 has scale 8 and q4 scale 4, so the quotient x 10^6 is n * 100 / d.
MINUTE = f"""{CLEAN},
minute AS (
  SELECT date_trunc('minute', event_ts) AS bar_open_ts, symbol,
         arg_min(p4, event_ts) AS open, max(p4) AS high, min(p4) AS low, arg_max(p4, event_ts) AS close,
         sum(q4) AS volume, count(*) AS trade_count,
         {half_up("sum(p4 * q4) * 100", "sum(q4)")} AS vwap6
  FROM clean GROUP BY 1, 2)"""

_E4 = "CAST({0} AS DOUBLE) / 10000.0 AS {0}"
BAR_COLS = ", ".join(_E4.format(c) for c in ("open", "high", "low", "close", "volume")) + (
    ", CAST(vwap6 AS DOUBLE) / 1000000.0 AS vwap, CAST(trade_count AS BIGINT) AS trade_count"
)


def wide_bars(timeframe: str) -> str:
    """CTE body for bars of one width from `minute`."""
    bucket = {
        "5m": "time_bucket(INTERVAL 5 MINUTE, bar_open_ts)",
        "1h": "date_trunc('hour', bar_open_ts)",
        "1d": "CAST(date_trunc('day', bar_open_ts) AS TIMESTAMP)",
    }[timeframe]
    # vwap6 x volume has scale 10 and volume scale 4, so the quotient x 10^6 is n / d.
    return f"""
  SELECT {bucket} AS bucket, symbol, arg_min(open, bar_open_ts) AS open, max(high) AS high,
         min(low) AS low, arg_max(close, bar_open_ts) AS close, sum(volume) AS volume,
         {half_up("sum(vwap6 * volume)", "sum(volume)")} AS vwap6, sum(trade_count) AS trade_count
  FROM minute GROUP BY 1, 2"""


def wide_select(timeframe: str) -> str:
    return (
        f"SELECT bucket AS bar_open_ts, symbol, 'crypto' AS asset_class, {BAR_COLS}, "
        f"'{timeframe}' AS timeframe, CAST(bucket AS DATE) AS bar_date FROM ({wide_bars(timeframe)})"
    )


QUARANTINE = f"""{TRADES},{FLAGS},
quarantine AS (
  SELECT *, ingest_ts AS quarantined_ts, least(3, late_arrival_sec // 100) AS attempts
  FROM judged WHERE bad),
outcomes AS (
  SELECT *, CASE WHEN attempts >= 3 THEN 'exhausted'
                 WHEN quarantined_ts < TIMESTAMP '{{as_of}}' - INTERVAL {{hours}} HOUR THEN 'waiting'
                 WHEN NOT (f1 OR f2 OR f3 OR f5 OR f6) THEN 'promoted'
                 WHEN attempts + 1 >= 3 THEN 'archived' ELSE 'retry' END AS outcome,
         concat_ws(',', CASE WHEN f1 THEN 'PRICE_NOT_POSITIVE' END, CASE WHEN f2 THEN 'PRICE_OUT_OF_RANGE' END,
           CASE WHEN f3 THEN 'QUANTITY_NOT_POSITIVE' END, CASE WHEN f5 THEN 'EVENT_TS_INVALID' END,
           CASE WHEN f6 THEN 'TRADE_ID_MISSING' END, CASE WHEN f7 THEN 'LATE_ARRIVAL' END) AS recheck
  FROM quarantine)"""


def quarantine(as_of: str = AS_OF, hours: int = 24 * 3650) -> str:
    return QUARANTINE.format(as_of=as_of, hours=hours)


RAW_BARS = """
k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n FROM events),
raw AS (
  SELECT event_id AS seq,
    CASE event_type WHEN 'click' THEN 'AAPL' WHEN 'view' THEN 'MSFT'
      WHEN 'purchase' THEN 'SPY' WHEN 'signup' THEN 'QQQ' END AS symbol,
    date_trunc('hour', ts) AS bar_open_ts,
    CASE user_id % 4 WHEN 0 THEN '1m' WHEN 1 THEN '1Min' WHEN 2 THEN '5m' ELSE '2m' END AS timeframe,
    value AS open, value + n % 10 - 1 AS high, value - event_id % 10 + 1 AS low,
    value + n % 3 - 1 AS close, n - 3 AS volume, value AS vwap, n AS trade_count,
    ts + (event_id % 400) * INTERVAL 1 SECOND AS ingest_ts
  FROM k),
raw_flags AS (
  SELECT *, bar_open_ts IS NULL AS g1, symbol IS NULL AS g2,
    NOT coalesce(timeframe IN ('1Min','5Min','15Min','1Hour','1Day','1m','5m','1h','1d'), false) AS g3,
    NOT coalesce(high >= low, false) AS g4, NOT coalesce(low <= open AND open <= high, false) AS g5,
    NOT coalesce(low <= close AND close <= high, false) AS g6, NOT coalesce(volume >= 0, false) AS g7
  FROM raw),
raw_judged AS (
  SELECT *, g1 OR g2 OR g3 OR g4 OR g5 OR g6 OR g7 AS bad,
    concat_ws(',', CASE WHEN g1 THEN 'BAR_TIMESTAMP_NULL' END, CASE WHEN g2 THEN 'BAR_SYMBOL_NULL' END,
      CASE WHEN g3 THEN 'BAR_TIMEFRAME_INVALID' END, CASE WHEN g4 THEN 'BAR_HIGH_LOW_INVERTED' END,
      CASE WHEN g5 THEN 'BAR_OPEN_OUT_OF_RANGE' END, CASE WHEN g6 THEN 'BAR_CLOSE_OUT_OF_RANGE' END,
      CASE WHEN g7 THEN 'BAR_VOLUME_NEGATIVE' END) AS codes
  FROM raw_flags)"""

RAW_BAR_COLS = """bar_open_ts, ingest_ts, CAST(bar_open_ts AS DATE) AS event_date, 'alpaca' AS source,
  'stock' AS asset_class, symbol, timeframe, open, high, low, close, CAST(volume AS DOUBLE) AS volume,
  vwap, trade_count"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"
