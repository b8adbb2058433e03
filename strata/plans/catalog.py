"""Every query the engine registers, next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.market import bucket_start
from strata.operators import health, layout, market_queries, rules, wire
from strata.operators.bars import bars_unchecked, gold_bars, gold_bars_together, one_minute_bars
from strata.operators.profiles import (
    daily_volume,
    market_quality,
    market_quality_with_quarantine,
    with_metric_date,
)
from strata.operators.quality import FAILURES_COL, failures_by_code
from strata.operators.quarantine import Replay, with_metadata
from strata.operators.typed import silver_bars
from strata.plans import inputs, jobs, oracle
from strata.plans.inputs import AS_OF, comparable
from strata.schemas import TRADE_WIRE, conform, table, table_path
from strata.session import configure, scratch_path
from strata.sources import feeds, inference, landing, tables
from strata.streaming import ingest, refine

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; its result is brought into comparable types."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(configure(spark), sf_dir))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# --------------------------------------------------------------------------- feeds and landing

@query("scan_jsonl", oracle.with_(oracle.TRADES, """
SELECT 'trade' AS event_type, date_trunc('millisecond', event_ts) AS event_time, symbol, event_id AS trade_id,
  CAST(price AS VARCHAR) AS price, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity,
  date_trunc('millisecond', event_ts) AS trade_time, buyer_is_maker FROM t"""))
def scan_jsonl(spark, sf_dir):
    """Landing files written as JSON lines and scanned back with the declared schema."""
    path = scratch_path(spark, "landing")
    inputs.history(spark, sf_dir).write.json(path)
    return feeds.scan_jsonl(spark, path, TRADE_WIRE)


def _evolving_lines(spark, sf_dir) -> DataFrame:
    """Lines of two writer versions, the second with one more field, and truncated lines."""
    record = F.struct("event_type", "symbol", "trade_id", "price", "quantity")
    newer = F.struct(
        "event_type", "symbol", "trade_id", "price", "quantity",
        F.col("buyer_is_maker").alias("is_self_match"),
    )
    late = F.col("trade_time") >= F.lit("2024-01-15").cast("timestamp")
    whole = F.when(late, F.to_json(newer)).otherwise(F.to_json(record))
    cut = F.col("symbol") == "AAPL"
    line = F.when(cut, F.concat(F.lit("{\"event_type\": "), F.col("trade_id").cast("string")))
    return inputs.bronze_trades(spark, sf_dir).select(line.otherwise(whole).alias("value"))


@query("scan_evolving", oracle.with_(oracle.TRADES, """
SELECT CASE WHEN symbol <> 'AAPL' THEN event_id END AS trade_id,
  CASE WHEN symbol <> 'AAPL' THEN symbol END AS symbol, symbol = 'AAPL' AS is_corrupt,
  CASE WHEN symbol <> 'AAPL' AND event_ts >= TIMESTAMP '2024-01-15' THEN buyer_is_maker END AS rescued,
  CASE WHEN symbol <> 'AAPL' AND event_ts >= TIMESTAMP '2024-01-15' THEN buyer_is_maker END AS from_raw
FROM t"""))
def scan_evolving(spark, sf_dir):
    """Text scan that keeps unknown fields and malformed lines; the new field read back both ways."""
    path = scratch_path(spark, "evolving")
    _evolving_lines(spark, sf_dir).write.text(path)
    rows = feeds.scan_evolving(spark, path, TRADE_WIRE)
    return rows.select(
        "trade_id", "symbol", F.col("_corrupt").alias("is_corrupt"),
        F.try_element_at("_rescued", F.lit("is_self_match")).cast("boolean").alias("rescued"),
        feeds.raw_field("is_self_match", "boolean").alias("from_raw"),
    )


@query("rescued_fields", oracle.with_(oracle.TRADES, """
SELECT 'is_self_match' AS field, count(*) AS n_rows FROM t
WHERE symbol <> 'AAPL' AND event_ts >= TIMESTAMP '2024-01-15'"""))
def rescued_fields(spark, sf_dir):
    path = scratch_path(spark, "evolving")
    _evolving_lines(spark, sf_dir).write.text(path)
    return feeds.rescued_fields(feeds.scan_evolving(spark, path, TRADE_WIRE))


@query("bronze_annotate", oracle.with_(oracle.TRADES, """
SELECT event_id AS trade_id,
  '{"event_type":"trade","event_time":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '","symbol":"' || symbol
  || '","trade_id":' || event_id || ',"price":"' || CAST(price AS VARCHAR) || '","quantity":"'
  || CAST(CAST(quantity AS BIGINT) AS VARCHAR) || '","trade_time":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ')
  || '","buyer_is_maker":' || CASE WHEN buyer_is_maker THEN 'true' ELSE 'false' END || '}' AS _raw_json,
  ingest_ts AS _ingest_ts, 'binance' AS _source, CAST(ingest_ts AS DATE) AS ingestion_date FROM t"""))
def bronze_annotate(spark, sf_dir):
    rows = inputs.bronze_trades(spark, sf_dir)
    clock = F.col("trade_time") + F.make_dt_interval(secs=F.col("trade_id") % 400)
    annotated = feeds.annotate(
        rows.select(*inputs.wire_columns()), "binance", clock, F.lit("events")
    )
    return annotated.select("trade_id", "_raw_json", "_ingest_ts", "_source", "ingestion_date")


@query("replay_history", oracle.with_(oracle.TRADES, """
SELECT date_trunc('millisecond', event_ts) AS event_time, symbol, event_id AS trade_id,
  CAST(price AS VARCHAR) AS price, buyer_is_maker FROM t"""))
def replay_history(spark, sf_dir):
    """Stored history written as time-ordered landing files and scanned back."""
    path = scratch_path(spark, "replay")
    landing.write_landing(inputs.history(spark, sf_dir), path, datetime(2024, 2, 1))
    rows = feeds.scan_jsonl(spark, path, TRADE_WIRE)
    return rows.select("event_time", "symbol", "trade_id", "price", "buyer_is_maker")


_ROTATION_SQL = """
WITH RECURSIVE moments AS (
  SELECT epoch_ms(TIMESTAMP '2024-01-01') + (epoch_us(ts) // 1000 - epoch_ms(TIMESTAMP '2024-01-01')) // 1000 AS ms FROM events),
numbered AS (SELECT ms, ms // 60000 AS m, row_number() OVER (PARTITION BY ms // 60000 ORDER BY ms) AS i FROM moments),
fold AS (
  SELECT m, ms, i, CAST(0 AS BIGINT) AS file, CAST(1 AS BIGINT) AS held, ms AS opened FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.m, n.ms, n.i, CASE WHEN f.held >= 12 OR n.ms - f.opened >= 10000 THEN f.file + 1 ELSE f.file END,
    CASE WHEN f.held >= 12 OR n.ms - f.opened >= 10000 THEN 1 ELSE f.held + 1 END,
    CASE WHEN f.held >= 12 OR n.ms - f.opened >= 10000 THEN n.ms ELSE f.opened END
  FROM fold f JOIN numbered n ON n.m = f.m AND n.i = f.i + 1)
SELECT epoch_ms(m * 60000) AS landing_minute, file AS landing_file, count(*) AS n_records, epoch_ms(min(ms)) AS first_ts,
  epoch_ms(max(ms)) AS last_ts FROM fold GROUP BY m, file"""


@query("replay_rotation", _ROTATION_SQL)
def replay_rotation(spark, sf_dir):
    """The landing files of a history replayed a thousand times faster: closed after twelve records or ten seconds."""
    ms = F.unix_millis("event_time") - F.unix_millis(F.lit("2024-01-01").cast("timestamp"))
    fast = F.timestamp_millis(F.unix_millis(F.lit("2024-01-01").cast("timestamp")) + F.floor(ms / 1000))
    history = inputs.history(spark, sf_dir).withColumn("event_time", fast)
    files = landing.rotated(history, records_per_file=12)
    return files.groupBy("landing_minute", "landing_file").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("event_time").alias("first_ts"), F.max("event_time").alias("last_ts")
    )


@query("replay_schedule", oracle.with_(oracle.TRADES, """
SELECT event_id AS trade_id,
  CAST(epoch_us(event_ts) - (SELECT min(epoch_us(event_ts)) FROM t) AS DOUBLE) / 60000000.0 AS emit_after_sec
FROM t"""))
def replay_schedule(spark, sf_dir):
    """When a replay at sixty-fold speed emits each row."""
    history = inputs.history(spark, sf_dir)
    return landing.replay_schedule(history, speedup=60.0).select("trade_id", "emit_after_sec")


# --------------------------------------------------------------------------- wire messages


def _trade_messages(spark, sf_dir) -> DataFrame:
    """Wire text: half of the messages in an envelope, views as another message type."""
    body = (
        "named_struct('e', if(symbol = 'ETHUSDT', 'aggTrade', 'trade'), 'E', unix_millis(event_time), "
        "'s', symbol, 't', trade_id, 'p', price, 'q', quantity, 'T', unix_millis(trade_time), "
        "'m', buyer_is_maker, 'X', 'new')"
    )
    return inputs.bronze_trades(spark, sf_dir).selectExpr(
        f"CASE WHEN buyer_is_maker THEN to_json(named_struct('stream', 'trade', 'data', {body})) "
        f"ELSE to_json({body}) END AS value"
    )


@query("unwrap_trades", oracle.with_(oracle.TRADES, """
SELECT event_id AS t, symbol AS s FROM t WHERE symbol <> 'ETHUSDT'"""))
def unwrap_trades(spark, sf_dir):
    messages = wire.unwrap_trades(_trade_messages(spark, sf_dir))
    return messages.selectExpr("cast(message['t'] AS bigint) AS t", "message['s'] AS s")


@query("normalize_wire_trades", oracle.with_(oracle.TRADES, """
SELECT 'trade' AS event_type, date_trunc('millisecond', event_ts) AS event_time, symbol, event_id AS trade_id,
  CAST(price AS VARCHAR) AS price, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity,
  date_trunc('millisecond', event_ts) AS trade_time, buyer_is_maker, 'new' AS x
FROM t WHERE symbol <> 'ETHUSDT'"""))
def normalize_wire_trades(spark, sf_dir):
    rows = wire.landing_trades(wire.unwrap_trades(_trade_messages(spark, sf_dir)))
    return rows.withColumn("x", F.col("_extra")["X"]).drop("_extra")


def _bar_replies(spark, sf_dir) -> DataFrame:
    """One poll reply per raw bar, holding it and its successor under one symbol."""
    bar = (
        "named_struct('t', date_format(bar_open_ts + make_dt_interval(0, {0}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), "
        "'o', open, 'h', high, 'l', low, 'c', close, 'v', volume + {0}, 'vw', vwap, 'n', trade_count, 'x', seq)"
    )
    return inputs.bronze_bars(spark, sf_dir).selectExpr(
        "to_json(named_struct('bars', map(coalesce(symbol, 'NONE'), "
        f"array({bar.format(0)}, {bar.format(1)})))) AS value"
    )


@query("flatten_bars", oracle.with_(oracle.RAW_BARS, """
SELECT coalesce(symbol, 'NONE') AS symbol, seq, CAST(volume + d AS BIGINT) AS v
FROM raw, (VALUES (0), (1)) AS g(d)"""))
def flatten_bars(spark, sf_dir):
    rows = wire.flatten_bars(_bar_replies(spark, sf_dir))
    return rows.selectExpr(
        "symbol", "cast(message['x'] AS bigint) AS seq",
        "cast(message['v'] AS bigint) AS v",
    )


@query("normalize_wire_bars", oracle.with_(oracle.RAW_BARS, """
SELECT coalesce(symbol, 'NONE') AS symbol, bar_open_ts + d * INTERVAL 1 HOUR AS bar_open_ts, '1Min' AS timeframe,
  open, high, low, close, CAST(volume + d AS BIGINT) AS volume, vwap, trade_count, CAST(seq AS VARCHAR) AS x
FROM raw, (VALUES (0), (1)) AS g(d)"""))
def normalize_wire_bars(spark, sf_dir):
    rows = wire.landing_bars(wire.flatten_bars(_bar_replies(spark, sf_dir)))
    return rows.withColumn("x", F.col("_extra")["x"]).drop("_extra")


@query("dedup_bars", oracle.with_(oracle.RAW_BARS, """
SELECT symbol, bar_open_ts, seq, timeframe, open, CAST(volume AS BIGINT) AS volume
FROM raw QUALIFY row_number() OVER (PARTITION BY symbol, bar_open_ts ORDER BY seq) = 1"""))
def dedup_bars(spark, sf_dir):
    bars = wire.first_per_key(
        inputs.bronze_bars(spark, sf_dir), ("symbol", "bar_open_ts"), ("seq",)
    )
    return bars.select("symbol", "bar_open_ts", "seq", "timeframe", "open", "volume")


@query("poll_window", oracle.with_(oracle.MINUTE, """
SELECT symbol, bar_open_ts, CAST(trade_count AS BIGINT) AS trade_count FROM minute
WHERE bar_open_ts BETWEEN (SELECT max(bar_open_ts) FROM minute) - INTERVAL 2 MINUTE
                      AND (SELECT max(bar_open_ts) FROM minute)"""))
def poll_window(spark, sf_dir):
    bars = inputs.minute_bars(spark, sf_dir)
    newest = inputs.clean_trades(spark, sf_dir).agg(F.max(bucket_start("event_ts", "1m"))).scalar()
    return wire.poll_window(bars, newest).select("symbol", "bar_open_ts", "trade_count")


# --------------------------------------------------------------------------- Silver and quality


@query("silver_trades_normalize", oracle.with_(oracle.TRADES, f"SELECT {oracle.TRADE_COLS} FROM trades"))
def silver_trades_normalize(spark, sf_dir):
    return inputs.trades(spark, sf_dir).drop("_raw_json")


@query("silver_bars_normalize", oracle.with_(oracle.RAW_BARS, f"SELECT {oracle.RAW_BAR_COLS} FROM raw"))
def silver_bars_normalize(spark, sf_dir):
    return silver_bars(inputs.bronze_bars(spark, sf_dir)).drop("_raw_json")


@query("silver_history_bars", oracle.with_(oracle.RAW_BARS, """
SELECT bar_open_ts, symbol, '1d' AS timeframe, open, close, CAST(volume AS DOUBLE) AS volume,
  CAST(NULL AS DOUBLE) AS vwap, CAST(NULL AS BIGINT) AS trade_count, 'yfinance' AS source FROM raw"""))
def silver_history_bars(spark, sf_dir):
    """Historic daily bars, which carry neither vwap nor trade count."""
    raw = inputs.bronze_bars(spark, sf_dir).drop("vwap", "trade_count")
    daily = raw.withColumns({"timeframe": F.lit("1d"), "adj_close": F.col("close")})
    return silver_bars(daily, "yfinance").select(
        "bar_open_ts", "symbol", "timeframe", "open", "close", "volume", "vwap", "trade_count",
        "source",
    )


@query("quality_evaluate", oracle.with_(
    f"{oracle.TRADES},{oracle.FLAGS}", "SELECT trade_id, codes AS _quality_failures FROM judged"))
def quality_evaluate(spark, sf_dir):
    evaluated = rules.trade_gate(AS_OF).evaluate(inputs.trades(spark, sf_dir))
    return evaluated.select("trade_id", FAILURES_COL)


@query("quality_split_pass", oracle.with_(oracle.CLEAN, """
SELECT trade_id, symbol, CASE WHEN f7 THEN 'LATE_ARRIVAL' ELSE '' END AS _quality_failures FROM clean"""))
def quality_split_pass(spark, sf_dir):
    """The passing half with its warnings kept."""
    gate = rules.trade_gate(AS_OF)
    kept = gate.passing(inputs.trades(spark, sf_dir), keep_warnings=True)
    return kept.select("trade_id", "symbol", FAILURES_COL)


@query("quality_split_quarantine", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT trade_id, symbol, codes AS _quality_failures FROM judged WHERE bad"""))
def quality_split_quarantine(spark, sf_dir):
    failed = rules.trade_gate(AS_OF).quarantined(inputs.trades(spark, sf_dir))
    return failed.select("trade_id", "symbol", FAILURES_COL)


@query("rules_trades", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT 'PRICE_NOT_POSITIVE' AS error_code, 'error' AS severity, count(*) FILTER (f1) AS failed_rows FROM flags
UNION ALL SELECT 'PRICE_OUT_OF_RANGE', 'error', count(*) FILTER (f2) FROM flags
UNION ALL SELECT 'QUANTITY_NOT_POSITIVE', 'error', count(*) FILTER (f3) FROM flags
UNION ALL SELECT 'SYMBOL_UNKNOWN', 'error', count(*) FILTER (f4) FROM flags
UNION ALL SELECT 'EVENT_TS_INVALID', 'error', count(*) FILTER (f5) FROM flags
UNION ALL SELECT 'TRADE_ID_MISSING', 'error', count(*) FILTER (f6) FROM flags
UNION ALL SELECT 'LATE_ARRIVAL', 'warning', count(*) FILTER (f7) FROM flags"""))
def rules_trades(spark, sf_dir):
    return rules.trade_gate(AS_OF).tally(inputs.trades(spark, sf_dir))


@query("rules_bars", oracle.with_(oracle.RAW_BARS, """
SELECT 'BAR_TIMESTAMP_NULL' AS error_code, 'error' AS severity, count(*) FILTER (g1) AS failed_rows FROM raw_flags
UNION ALL SELECT 'BAR_SYMBOL_NULL', 'error', count(*) FILTER (g2) FROM raw_flags
UNION ALL SELECT 'BAR_TIMEFRAME_INVALID', 'error', count(*) FILTER (g3) FROM raw_flags
UNION ALL SELECT 'BAR_HIGH_LOW_INVERTED', 'error', count(*) FILTER (g4) FROM raw_flags
UNION ALL SELECT 'BAR_OPEN_OUT_OF_RANGE', 'error', count(*) FILTER (g5) FROM raw_flags
UNION ALL SELECT 'BAR_CLOSE_OUT_OF_RANGE', 'error', count(*) FILTER (g6) FROM raw_flags
UNION ALL SELECT 'BAR_VOLUME_NEGATIVE', 'error', count(*) FILTER (g7) FROM raw_flags"""))
def rules_bars(spark, sf_dir):
    return rules.bar_gate().tally(silver_bars(inputs.bronze_bars(spark, sf_dir)))


@query("rules_gold_bars", oracle.with_(oracle.RAW_BARS, """
SELECT 'BAR_INCONSISTENT' AS error_code, 'error' AS severity, count(*) FILTER (g4 OR g5 OR g6) AS failed_rows
FROM raw_flags UNION ALL SELECT 'VOLUME_NEGATIVE', 'error', count(*) FILTER (g7) FROM raw_flags"""))
def rules_gold_bars(spark, sf_dir):
    return rules.gold_bar_gate().tally(silver_bars(inputs.bronze_bars(spark, sf_dir)))


@query("silver_trades", oracle.with_(oracle.CLEAN, f"SELECT {oracle.TRADE_COLS} FROM clean"))
def silver_trades(spark, sf_dir):
    return inputs.clean_trades(spark, sf_dir).drop("_raw_json")


@query("silver_quarantine_trades", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", f"""
SELECT {oracle.TRADE_COLS}, codes AS _quality_failures,
  CASE WHEN f1 THEN 'PRICE_NOT_POSITIVE' WHEN f2 THEN 'PRICE_OUT_OF_RANGE' WHEN f3 THEN 'QUANTITY_NOT_POSITIVE'
       WHEN f4 THEN 'SYMBOL_UNKNOWN' WHEN f5 THEN 'EVENT_TS_INVALID' WHEN f6 THEN 'TRADE_ID_MISSING' END AS _error_code,
  TIMESTAMP '{AS_OF}' AS _quarantined_ts, CAST(TIMESTAMP '{AS_OF}' AS DATE) AS quarantined_date,
  CAST(0 AS INTEGER) AS _replay_attempts FROM judged WHERE bad"""))
def silver_quarantine_trades(spark, sf_dir):
    failed = rules.trade_gate(AS_OF).quarantined(inputs.trades(spark, sf_dir))
    return with_metadata(failed, AS_OF).drop("_raw_json", "_error_msg")


@query("silver_bars", oracle.with_(
    oracle.RAW_BARS, f"SELECT {oracle.RAW_BAR_COLS} FROM raw_judged WHERE NOT bad"))
def silver_bars_clean(spark, sf_dir):
    typed = silver_bars(inputs.bronze_bars(spark, sf_dir))
    return rules.bar_gate().passing(typed).drop("_raw_json")


@query("silver_quarantine_bars", oracle.with_(
    oracle.RAW_BARS,
    f"SELECT {oracle.RAW_BAR_COLS}, codes AS _quality_failures FROM raw_judged WHERE bad"))
def silver_quarantine_bars(spark, sf_dir):
    typed = silver_bars(inputs.bronze_bars(spark, sf_dir))
    return rules.bar_gate().quarantined(typed).drop("_raw_json")


@query("rule_unique_bar_key", oracle.with_(oracle.RAW_BARS, """
SELECT symbol, bar_open_ts, timeframe, count(*) AS n_rows FROM raw GROUP BY ALL HAVING count(*) > 1"""))
def rule_unique_bar_key(spark, sf_dir):
    return rules.repeated_keys(inputs.bronze_bars(spark, sf_dir))


@query("unique_bars", oracle.with_(oracle.RAW_BARS, """
SELECT seq, symbol, bar_open_ts, timeframe FROM raw
QUALIFY count(*) OVER (PARTITION BY symbol, bar_open_ts, timeframe) = 1"""))
def unique_bars(spark, sf_dir):
    unique, _ = rules.split_on_unique_key(inputs.bronze_bars(spark, sf_dir))
    return unique.select("seq", "symbol", "bar_open_ts", "timeframe")


@query("repeated_bars", oracle.with_(oracle.RAW_BARS, """
SELECT seq, symbol, bar_open_ts, timeframe FROM raw
QUALIFY count(*) OVER (PARTITION BY symbol, bar_open_ts, timeframe) > 1"""))
def repeated_bars(spark, sf_dir):
    _, repeated = rules.split_on_unique_key(inputs.bronze_bars(spark, sf_dir))
    return repeated.select("seq", "symbol", "bar_open_ts", "timeframe")


# --------------------------------------------------------------------------- quarantine

# The replay with a window: entries of the ten days before this moment.
WINDOW_END, WINDOW_HOURS = "2024-01-20 00:00:00", 240


def _replay(spark, sf_dir, **window) -> Replay:
    gate = rules.trade_gate(AS_OF).without("SYMBOL_UNKNOWN")
    return Replay(inputs.quarantined_trades(spark, sf_dir), gate, **window)


def _windowed(spark, sf_dir) -> Replay:
    return _replay(spark, sf_dir, as_of=WINDOW_END, window_hours=WINDOW_HOURS)


_WINDOWED_SQL = oracle.quarantine(WINDOW_END, WINDOW_HOURS)


@query("quarantine_by_code", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT error_code, count(*) AS n_rows, count(*) FILTER (error_code = split_part(codes, ',', 1)) AS n_first
FROM (SELECT codes, unnest(string_split(codes, ',')) AS error_code FROM judged WHERE bad) GROUP BY 1"""))
def quarantine_by_code(spark, sf_dir):
    return failures_by_code(inputs.quarantined_trades(spark, sf_dir))


@query("quarantine_replay_pass", oracle.with_(
    oracle.quarantine(), f"SELECT {oracle.TRADE_COLS} FROM outcomes WHERE outcome = 'promoted'"))
def quarantine_replay_pass(spark, sf_dir):
    return _replay(spark, sf_dir).promoted().drop("_raw_json")


@query("quarantine_replay_fail", oracle.with_(oracle.quarantine(), """
SELECT trade_id, recheck AS _quality_failures, CAST(attempts + 1 AS INTEGER) AS _replay_attempts
FROM outcomes WHERE outcome IN ('retry', 'archived')"""))
def quarantine_replay_fail(spark, sf_dir):
    failing = _replay(spark, sf_dir).still_failing()
    return failing.select("trade_id", FAILURES_COL, "_replay_attempts")


@query("quarantine_rewrite", oracle.with_(_WINDOWED_SQL, """
SELECT trade_id, CASE outcome WHEN 'retry' THEN recheck ELSE codes END AS _quality_failures,
  CAST(CASE outcome WHEN 'retry' THEN attempts + 1 ELSE attempts END AS INTEGER) AS _replay_attempts
FROM outcomes WHERE outcome IN ('retry', 'waiting')"""))
def quarantine_rewrite(spark, sf_dir):
    return _windowed(spark, sf_dir).remaining().select("trade_id", FAILURES_COL, "_replay_attempts")


@query("quarantine_archive", oracle.with_(_WINDOWED_SQL, """
SELECT trade_id, CAST(CASE outcome WHEN 'archived' THEN attempts + 1 ELSE attempts END AS INTEGER) AS _replay_attempts
FROM outcomes WHERE outcome IN ('archived', 'exhausted')"""))
def quarantine_archive(spark, sf_dir):
    return _windowed(spark, sf_dir).archive().select("trade_id", "_replay_attempts")


@query("replay_metrics", oracle.with_(_WINDOWED_SQL, """
SELECT count(*) FILTER (outcome IN ('promoted', 'retry', 'archived')) AS eligible,
  count(*) FILTER (outcome = 'promoted') AS promoted,
  count(*) FILTER (outcome IN ('retry', 'archived')) AS still_failing,
  count(*) FILTER (outcome IN ('archived', 'exhausted')) AS archived,
  count(*) FILTER (outcome = 'waiting') AS waiting FROM outcomes"""))
def replay_metrics(spark, sf_dir):
    """The counters of a replay, observed by the job that stores its outcomes."""
    run = _windowed(spark, sf_dir)
    counted = run.observed()
    tables.stage(spark, run.rows, "replay-outcomes")
    return spark.createDataFrame([counted.get], ", ".join(f"{name} bigint" for name in counted.get))


# --------------------------------------------------------------------------- bars and profiles


@query("bars_1m", oracle.with_(oracle.MINUTE, f"""
SELECT bar_open_ts, symbol, 'crypto' AS asset_class, {oracle.BAR_COLS}, CAST(bar_open_ts AS DATE) AS event_date,
  'trade_rollup' AS source, '1m' AS timeframe FROM minute"""))
def bars_1m(spark, sf_dir):
    return inputs.minute_bars(spark, sf_dir)


def _wide(timeframe: str) -> None:
    @query(f"bars_{timeframe}", oracle.with_(oracle.MINUTE, oracle.wide_select(timeframe)))
    def build(spark, sf_dir):
        return gold_bars(inputs.minute_bars(spark, sf_dir), timeframe)[0]


for _timeframe in ("5m", "1h", "1d"):
    _wide(_timeframe)


@query("bars_all_widths", oracle.with_(
    oracle.MINUTE, "\nUNION ALL BY NAME\n".join(oracle.wide_select(tf) for tf in ("5m", "1h", "1d"))))
def bars_all_widths(spark, sf_dir):
    """Three widths from one scan and one shuffle."""
    return gold_bars_together(inputs.minute_bars(spark, sf_dir))


_GOLD_RAW = f"""{oracle.RAW_BARS},
one AS (SELECT * FROM raw WHERE timeframe IN ('1m', '1Min')),
hourly AS (
  SELECT CAST(date_trunc('hour', bar_open_ts) AS TIMESTAMP) AS bar_open_ts, symbol, max(high) AS high, min(low) AS low,
    sum(volume) AS volume, sum(trade_count) AS trade_count FROM one GROUP BY 1, 2)"""


@query("gold_bars_1m", oracle.with_(oracle.MINUTE, f"""
SELECT bar_open_ts, symbol, 'crypto' AS asset_class, {oracle.BAR_COLS}, '1m' AS timeframe,
  CAST(bar_open_ts AS DATE) AS bar_date FROM minute"""))
def gold_bars_1m(spark, sf_dir):
    """One-minute Gold bars: the bars of Silver pass through the Gold rules."""
    passing, _ = gold_bars(inputs.minute_bars(spark, sf_dir), "1m")
    return conform(passing, table("gold", "bars_1m"))


@query("gold_bars_quarantine", oracle.with_(_GOLD_RAW, """
SELECT bar_open_ts, symbol, high, low, CAST(volume AS DOUBLE) AS volume, CAST(trade_count AS BIGINT) AS trade_count
FROM hourly WHERE NOT coalesce(high >= low, false) OR NOT coalesce(volume >= 0, false)"""))
def gold_bars_quarantine(spark, sf_dir):
    """Wide bars that fail the Gold rules. Open and close of the input tie, so they are made equal
    to the low, which leaves the range and the volume to fail."""
    raw = silver_bars(inputs.bronze_bars(spark, sf_dir))
    wide = bars_unchecked(raw, "1h").withColumns({"open": F.col("low"), "close": F.col("low")})
    failed = rules.gold_bar_gate().quarantined(wide)
    return failed.select("bar_open_ts", "symbol", "high", "low", "volume", "trade_count")


_DAILY_SQL = f"""
SELECT event_date AS bar_date, symbol, 'crypto' AS asset_class,
  CAST(sum(q4) AS DOUBLE) / 10000.0 AS total_volume, CAST(sum(p4 * q4) AS DOUBLE) / 100000000.0 AS total_notional,
  count(*) AS trade_count, CAST(max(price) AS DOUBLE) AS price_high, CAST(min(price) AS DOUBLE) AS price_low,
  CAST({oracle.half_up("sum(p4 * q4) * 100", "sum(q4)")} AS DOUBLE) / 1000000.0 AS vwap
FROM clean GROUP BY 1, 2"""


@query("daily_volume", oracle.with_(oracle.CLEAN, _DAILY_SQL))
def daily_volume_of_trades(spark, sf_dir):
    return daily_volume(inputs.clean_trades(spark, sf_dir))


@query("daily_volume_bulk", f"""
WITH b AS (
  SELECT CAST(l_shipdate AS DATE) AS bar_date, l_returnflag || l_linestatus AS symbol,
    CAST(CAST(l_quantity AS DECIMAL(18,4)) * 10000 AS BIGINT) AS q4,
    CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * 10000 AS BIGINT) AS n4, l_extendedprice AS price
  FROM lineitem)
SELECT bar_date, symbol, 'bulk' AS asset_class, CAST(sum(q4) AS DOUBLE) / 10000.0 AS total_volume,
  CAST(sum(n4) AS DOUBLE) / 10000.0 AS total_notional, count(*) AS trade_count, max(price) AS price_high,
  min(price) AS price_low,
  CAST({oracle.half_up("sum(n4) * 1000000", "sum(q4)")} AS DOUBLE) / 1000000.0 AS vwap
FROM b GROUP BY 1, 2""")
def daily_volume_bulk(spark, sf_dir):
    """Daily volume over the largest table."""
    return daily_volume(inputs.bulk_volume(spark, sf_dir))


_QUALITY_COLS = """count(*) AS trade_count, avg(CASE WHEN late_arrival_sec > 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS late_arrival_pct,
  round(stddev_samp(CAST(price AS DOUBLE)), 6) AS price_volatility, CAST(max(price) AS DOUBLE) AS price_max,
  CAST(min(price) AS DOUBLE) AS price_min"""


def _rounded_volatility(df: DataFrame) -> DataFrame:
    return df.withColumn("price_volatility", F.round("price_volatility", 6))


@query("market_quality", oracle.with_(oracle.CLEAN, f"""
SELECT date_trunc('hour', event_ts) AS metric_hour, symbol, 'crypto' AS asset_class, {_QUALITY_COLS},
  CAST(0.0 AS DOUBLE) AS quarantine_pct FROM clean GROUP BY 1, 2"""))
def market_quality_of_trades(spark, sf_dir):
    return _rounded_volatility(market_quality(inputs.clean_trades(spark, sf_dir)))


# AAPL and the others have no unknown-symbol rows, so zero quantities alone give their ratio.
_QUALITY_FULL_SQL = oracle.with_(oracle.CLEAN, f"""
SELECT c.*, CAST(coalesce(b.n, 0) AS DOUBLE) / (c.trade_count + coalesce(b.n, 0)) AS quarantine_pct
FROM (SELECT date_trunc('hour', event_ts) AS metric_hour, symbol, 'crypto' AS asset_class, {_QUALITY_COLS}
      FROM clean GROUP BY 1, 2) c
LEFT JOIN (SELECT date_trunc('hour', event_ts) AS metric_hour, symbol, count(*) AS n
           FROM judged WHERE bad GROUP BY 1, 2) b USING (metric_hour, symbol)""")


@query("market_quality_full", _QUALITY_FULL_SQL)
def market_quality_full(spark, sf_dir):
    return _rounded_volatility(market_quality_with_quarantine(
        inputs.clean_trades(spark, sf_dir), inputs.quarantined_trades(spark, sf_dir)
    ))


# --------------------------------------------------------------------------- analytic queries


def _stored_silver(spark, sf_dir):
    """Clean trades as a stored table, and its newest time: a literal, so that days are pruned and filters pushed."""
    path = _stored_trades(spark, sf_dir, "silver")
    shape = inputs.clean_trades(spark, sf_dir).drop("_raw_json").schema
    trades = tables.read_table(spark, path, schema=shape)
    return trades, trades.agg(F.max("event_ts").cast("string")).first()[0]


@query("q1_single_symbol", oracle.with_(oracle.CLEAN, f"""
SELECT {oracle.TRADE_COLS} FROM clean WHERE symbol = 'BTCUSDT'
AND event_date >= (SELECT max(event_date) FROM clean) - INTERVAL 1 DAY"""))
def q1_single_symbol(spark, sf_dir):
    trades, newest = _stored_silver(spark, sf_dir)
    return market_queries.single_symbol(trades, as_of=newest)


@query("q1_summary", oracle.with_(oracle.CLEAN, """
SELECT count(*) AS trade_count, round(CAST(sum(p4) AS DOUBLE) / 10000.0 / count(*), 6) AS avg_price
FROM clean WHERE symbol = 'BTCUSDT' AND event_date >= (SELECT max(event_date) FROM clean) - INTERVAL 1 DAY"""))
def q1_summary(spark, sf_dir):
    trades, newest = _stored_silver(spark, sf_dir)
    found = market_queries.single_symbol_summary(trades, as_of=newest)
    return found.withColumn("avg_price", F.round(F.col("avg_price").cast("double"), 6))


@query("q2_hourly_vwap", oracle.with_(oracle.CLEAN, f"""
SELECT date_trunc('hour', event_ts) AS hour,
  CAST({oracle.half_up("sum(p4 * q4) * 100", "sum(q4)")} AS DOUBLE) / 1000000.0 AS vwap,
  CAST(sum(q4) AS DOUBLE) / 10000.0 AS volume FROM clean WHERE symbol = 'BTCUSDT'
AND event_date >= (SELECT max(event_date) FROM clean) - INTERVAL 7 DAY GROUP BY 1"""))
def q2_hourly_vwap(spark, sf_dir):
    trades, newest = _stored_silver(spark, sf_dir)
    return market_queries.hourly_vwap(trades, as_of=newest)


@query("q3_cross_section", oracle.with_(oracle.CLEAN, """
SELECT symbol, CAST(sum(q4) AS DOUBLE) / 10000.0 AS volume, count(*) AS trade_count,
  round(CAST(sum(p4) AS DOUBLE) / 10000.0 / count(*), 6) AS avg_price FROM clean
WHERE symbol IN ('BTCUSDT', 'ETHUSDT', 'SOLUSDT', 'AAPL', 'MSFT')
AND event_ts >= (SELECT max(event_ts) FROM clean) - INTERVAL 1 HOUR GROUP BY 1"""))
def q3_cross_section(spark, sf_dir):
    trades, newest = _stored_silver(spark, sf_dir)
    found = market_queries.cross_section(trades, as_of=newest)
    return found.withColumn("avg_price", F.round(F.col("avg_price").cast("double"), 6))


@query("q4_count_by_symbol", oracle.with_(
    oracle.CLEAN, "SELECT symbol, count(*) AS trade_count FROM clean GROUP BY 1"))
def q4_count_by_symbol(spark, sf_dir):
    return market_queries.count_by_symbol(_stored_silver(spark, sf_dir)[0])


# --------------------------------------------------------------------------- stored tables


@query("incremental_read", oracle.with_(oracle.TRADES, """
SELECT event_id AS trade_id, ingest_ts AS _ingest_ts FROM t WHERE ingest_ts > TIMESTAMP '2024-01-15 12:00:00'"""))
def incremental_read(spark, sf_dir):
    fresh = tables.since(inputs.bronze_trades(spark, sf_dir), "2024-01-15 12:00:00")
    return fresh.select("trade_id", "_ingest_ts")


@query("high_watermark", oracle.with_(oracle.TRADES, "SELECT max(ingest_ts) AS high_watermark FROM t"))
def high_watermark(spark, sf_dir):
    return tables.high_watermark(inputs.bronze_trades(spark, sf_dir))


_ITEM_KEY = ("l_orderkey", "l_linenumber")
_ITEM_LATEST = """
incoming AS (
  SELECT * FROM lineitem WHERE l_linestatus = 'O'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC) = 1),
stored AS (SELECT * FROM lineitem WHERE l_linestatus = 'F')"""


def _item_feed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Line items as a stored table (finished lines) and a feed of newer rows (open lines)."""
    items = inputs.load(spark, sf_dir, "lineitem")
    feed = items.filter("l_linestatus = 'O'")
    latest = tables.stage(spark, wire.last_per_key(feed, _ITEM_KEY, ("l_shipdate",)), "feed")
    return items.filter("l_linestatus = 'F'"), latest


@query("upsert_insert", oracle.with_(_ITEM_LATEST, """
SELECT * FROM incoming i WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber)
UNION ALL SELECT * FROM stored"""))
def upsert_insert(spark, sf_dir):
    """The stored table after insert-if-absent."""
    stored, latest = _item_feed(spark, sf_dir)
    return stored.unionByName(tables.new_rows(stored, latest, _ITEM_KEY))


@query("upsert_update", oracle.with_(_ITEM_LATEST, """
SELECT * FROM stored s WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber)
UNION ALL SELECT * FROM incoming"""))
def upsert_update(spark, sf_dir):
    """The stored table after update-or-insert."""
    stored, latest = _item_feed(spark, sf_dir)
    return tables.merged_rows(stored, latest, _ITEM_KEY)


def _stored_items(spark, sf_dir) -> tuple[str, DataFrame]:
    """Finished line items as a table by shipping year, and the feed of open ones."""
    items = inputs.load(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    path = scratch_path(spark, "items")
    tables.append(tables.binned(items.filter("l_linestatus = 'F'"), "ship_year"), path, "ship_year")
    return path, items.filter("l_linestatus = 'O'")


@query("insert_stored", ORACLES["upsert_insert"])
def insert_stored(spark, sf_dir):
    """Insert-if-absent into a stored table whose key does not fix the partition."""
    path, feed = _stored_items(spark, sf_dir)
    tables.insert_new(spark, feed, path, "ship_year", _ITEM_KEY, ("l_shipdate",), everywhere=True)
    return tables.read_table(spark, path, schema=feed.schema).drop("ship_year")


@query("upsert_stored", ORACLES["upsert_update"])
def upsert_stored(spark, sf_dir):
    """Update-or-insert into a stored table whose rows may change their partition."""
    path, feed = _stored_items(spark, sf_dir)
    tables.upsert(spark, feed, path, "ship_year", _ITEM_KEY, ("l_shipdate",), moves=True, schema=feed.schema)
    return tables.read_table(spark, path, schema=feed.schema).drop("ship_year")


@query("registered_table", oracle.with_(oracle.CLEAN, """
SELECT symbol, count(*) AS by_name, count(*) AS by_path FROM clean GROUP BY 1"""))
def registered_table(spark, sf_dir):
    """A stored table registered under a name and counted in SQL, by that name and by its path."""
    path = _stored_trades(spark, sf_dir, "registered")
    name = f"trades_{path.rsplit('-', 1)[-1]}"
    tables.register(spark, name, path)
    return spark.sql(f"""
        SELECT symbol, count(own) AS by_name, count(other) AS by_path FROM (
          SELECT symbol, 1 AS own, NULL AS other FROM {name} UNION ALL SELECT symbol, NULL, 1 FROM {tables.table_name(path)})
        GROUP BY symbol""")


@query("sample_rows", oracle.with_(oracle.CLEAN, """
SELECT trade_id, symbol, CAST(price AS DOUBLE) AS price FROM clean ORDER BY event_ts DESC, trade_id LIMIT 7"""))
def sample_rows(spark, sf_dir):
    """A look at the newest rows of a stored table; the limit is the feature."""
    trades, _ = _stored_silver(spark, sf_dir)
    return tables.sample_rows(trades.orderBy(F.desc("event_ts"), "trade_id"), ("trade_id", "symbol", "price"), 7)


@query("run_log", oracle.with_(oracle.CLEAN, """
SELECT 'expire' AS operation, 'silver' AS layer, 'trades' AS "table", 'partitions_dropped' AS metric,
  count(DISTINCT event_date) AS value, TIMESTAMP '2025-01-16 12:00:00' AS run_ts
FROM clean WHERE event_date < DATE '2025-01-16' - 365"""))
def run_log(spark, sf_dir):
    """What a retention job notes of its run: the days it has dropped."""
    root, spec = scratch_path(spark, "run-log"), table("silver", "trades")
    rows = conform(inputs.clean_trades(spark, sf_dir), spec)
    tables.append(tables.binned(rows, spec.partition_by), table_path(root, spec.layer, spec.name), spec.partition_by)
    jobs.enforce_retention(spark, root, "2025-01-16", run_ts="2025-01-16 12:00:00")
    log = table("gold", "maintenance_metrics")
    noted = tables.read_table(spark, table_path(root, log.layer, log.name), schema=log.schema)
    return noted.select("operation", "layer", "table", "metric", "value", "run_ts")


def _stored_trades(spark, sf_dir, label: str) -> str:
    """Clean trades written as a day-partitioned table in scratch."""
    path = scratch_path(spark, label)
    rows = inputs.clean_trades(spark, sf_dir).drop("_raw_json")
    tables.append(tables.binned(rows, "event_date"), path, "event_date")
    return path


_ROUNDTRIP_SQL = oracle.with_(oracle.CLEAN, f"SELECT {oracle.TRADE_COLS} FROM clean")


@query("compact_roundtrip", _ROUNDTRIP_SQL)
def compact_roundtrip(spark, sf_dir):
    """A stored table after compaction: the same rows."""
    path = _stored_trades(spark, sf_dir, "compact")
    layout.compact(spark, path, "event_date")
    return tables.read_table(spark, path)


@query("cluster_roundtrip", _ROUNDTRIP_SQL)
def cluster_roundtrip(spark, sf_dir):
    """A stored table after clustering by symbol: the same rows."""
    path = _stored_trades(spark, sf_dir, "cluster")
    layout.cluster(spark, path, "event_date", ("symbol",))
    return tables.read_table(spark, path)


@query("cluster_morton_roundtrip", _ROUNDTRIP_SQL)
def cluster_morton_roundtrip(spark, sf_dir):
    """A stored table after clustering along a curve of symbol, price and time: the same rows."""
    path = _stored_trades(spark, sf_dir, "morton")
    layout.cluster(spark, path, "event_date", ("symbol", "price", "event_ts"), target_bytes=200_000)
    return tables.read_table(spark, path)


@query("retention_keep", oracle.with_(oracle.CLEAN, f"""
SELECT {oracle.TRADE_COLS} FROM clean WHERE event_date >= DATE '2024-01-17'"""))
def retention_keep(spark, sf_dir):
    trades = inputs.clean_trades(spark, sf_dir).drop("_raw_json")
    return layout.unexpired(trades, "event_date", AS_OF, 15)


@query("retention_archive", oracle.with_(oracle.CLEAN, """
SELECT trade_id, event_date, DATE '2024-02-01' AS archive_run FROM clean WHERE event_date < DATE '2024-01-17'"""))
def retention_archive(spark, sf_dir):
    """What retention moves out of a stored table into its archive."""
    path = _stored_trades(spark, sf_dir, "expire")
    layout.expire(spark, path, "event_date", AS_OF, 15, f"{path}-archive")
    archived = tables.read_table(spark, f"{path}-archive")
    return archived.select("trade_id", "event_date", "archive_run")


# --------------------------------------------------------------------------- streams
# Each runs the stream over everything available, stops, and returns the table it has written.


def _finish(stream) -> None:
    stream.awaitTermination()


@query("stream_ingest", oracle.with_(oracle.TRADES, """
SELECT 'trade' AS event_type, date_trunc('millisecond', event_ts) AS event_time, symbol, event_id AS trade_id,
  CAST(price AS VARCHAR) AS price, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity,
  date_trunc('millisecond', event_ts) AS trade_time, buyer_is_maker, 'binance' AS _source FROM t"""))
def stream_ingest(spark, sf_dir):
    """Landing files into the Bronze table; the second start finds nothing new."""
    base = scratch_path(spark, "stream-ingest")
    landing.write_landing(
        inputs.history(spark, sf_dir), f"{base}/landing/binance", datetime(2024, 2, 1)
    )
    for _ in range(2):
        _finish(ingest.ingest(spark, "binance", f"{base}/landing", f"{base}/tables",
                              f"{base}/checkpoints", available_now=True))
    bronze = tables.read_table(spark, table_path(f"{base}/tables", "bronze", "binance_trades"))
    return bronze.select(*inputs.wire_columns(), "_source")


@query("stream_ingest_evolving", oracle.with_(oracle.TRADES, """
SELECT CASE WHEN symbol <> 'AAPL' THEN event_id END AS trade_id, symbol = 'AAPL' AS is_corrupt,
  CASE WHEN symbol <> 'AAPL' AND event_ts >= TIMESTAMP '2024-01-15' THEN buyer_is_maker END AS is_self_match
FROM t"""))
def stream_ingest_evolving(spark, sf_dir):
    """Lossless ingest over two starts, the second with the new field as a column: malformed lines and
    rescued fields are all there."""
    base = scratch_path(spark, "stream-evolving")
    lines = _evolving_lines(spark, sf_dir)
    for start, fields in enumerate(({}, {"is_self_match": "BOOLEAN"})):
        half = lines.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == start)
        half.write.text(f"{base}/landing/binance/{start}")
        _finish(ingest.ingest(spark, "binance", f"{base}/landing", f"{base}/tables", f"{base}/checkpoints",
                              available_now=True, evolving=True, promoted_fields=fields))
    bronze = tables.read_table(spark, table_path(f"{base}/tables", "bronze", "binance_trades"))
    rescued = F.get_json_object("_rescued", "$.is_self_match").cast("boolean")
    return bronze.select(
        "trade_id", F.col("_corrupt").alias("is_corrupt"), F.coalesce("is_self_match", rescued).alias("is_self_match")
    )


@query("stream_ingest_inferred", oracle.with_(oracle.TRADES, """
SELECT CASE WHEN symbol <> 'AAPL' THEN event_id END AS trade_id, symbol = 'AAPL' AS is_corrupt,
  CASE WHEN symbol <> 'AAPL' THEN buyer_is_maker END AS is_self_match,
  CASE WHEN symbol = 'AAPL' THEN NULL WHEN event_id % 3 = 0 THEN CAST(event_id % 5 AS VARCHAR)
       WHEN event_id % 3 = 1 THEN (event_id % 5) || '.5' ELSE 'x' || (event_id % 5) END AS lot
FROM t"""))
def stream_ingest_inferred(spark, sf_dir):
    """Lossless ingest of a feed with two undeclared fields, one of which is whole numbers first, then fractions,
    then text: every start learns the columns from what is stored, and the last finds nothing new to ingest."""
    base = scratch_path(spark, "stream-inferred")
    rows = inputs.bronze_trades(spark, sf_dir)
    number = F.col("trade_id") % 5
    lots = (number, number + F.lit(0.5), F.concat(F.lit("x"), number.cast("string")))
    for start in range(4):
        if start < 3:
            record = F.struct(
                "event_type", "symbol", "trade_id", "price", F.col("buyer_is_maker").alias("is_self_match"), lots[start].alias("lot")
            )
            cut = F.concat(F.lit("{\"event_type\": "), F.col("trade_id").cast("string"))
            line = F.when(F.col("symbol") == "AAPL", cut).otherwise(F.to_json(record))
            rows.filter(F.col("trade_id") % 3 == start).select(line.alias("value")).write.text(f"{base}/landing/binance/{start}")
        _finish(ingest.ingest(spark, "binance", f"{base}/landing", f"{base}/tables", f"{base}/checkpoints",
                              available_now=True, inferred=True))
    bronze = inference.read_inferred(spark, f"{base}/tables", feeds.FEEDS["binance"])
    return bronze.select("trade_id", F.col("_corrupt").alias("is_corrupt"), "is_self_match", "lot")


def _stream_refined(spark, sf_dir, name: str, copies: int = 1) -> DataFrame:
    base = scratch_path(spark, "stream-refine")
    bronze = reduce(DataFrame.unionByName, [inputs.bronze_trades(spark, sf_dir)] * copies)
    tables.append(tables.binned(bronze, "ingestion_date"), f"{base}/bronze", "ingestion_date")
    source = refine.stream_bronze(spark, f"{base}/bronze", bronze.schema)
    _finish(refine.refine(source, "trades", base, f"{base}/checkpoints", AS_OF, available_now=True))
    return tables.read_table(spark, table_path(base, "silver", name))


@query("stream_refine_clean", oracle.with_(oracle.CLEAN, f"SELECT {oracle.TRADE_COLS} FROM clean"))
def stream_refine_clean(spark, sf_dir):
    """The Silver half of the Bronze-to-Silver stream."""
    return _stream_refined(spark, sf_dir, "trades").drop("_raw_json")


@query("stream_refine_quarantine", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", f"""
SELECT trade_id, codes AS _quality_failures, CAST(0 AS INTEGER) AS _replay_attempts,
  CAST(TIMESTAMP '{AS_OF}' AS DATE) AS quarantined_date FROM judged WHERE bad"""))
def stream_refine_quarantine(spark, sf_dir):
    """The quarantine half of the same stream."""
    failed = _stream_refined(spark, sf_dir, "quarantine_trades")
    return failed.select("trade_id", FAILURES_COL, "_replay_attempts", "quarantined_date")


def _run_to_parquet(spark, stream: DataFrame, base: str) -> DataFrame:
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoints")
    _finish(writer.trigger(availableNow=True).start(f"{base}/out"))
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query("stream_dedup_bars", oracle.with_(oracle.RAW_BARS, "SELECT DISTINCT symbol, bar_open_ts FROM raw"))
def stream_dedup_bars(spark, sf_dir):
    """One row per polled bar key, read in several batches without order; which copy comes first is up to
    the stream."""
    base = scratch_path(spark, "stream-dedup")
    bars = inputs.bronze_bars(spark, sf_dir)
    bars.repartition(3, "seq").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    _finish(refine.keep_first_bars(stream, f"{base}/out", f"{base}/checkpoints", available_now=True))
    return tables.read_table(spark, f"{base}/out").select("symbol", "bar_open_ts")


@query("stream_rolling_bars", oracle.with_(oracle.MINUTE, f"""
SELECT bar_open_ts, symbol, 'crypto' AS asset_class, {oracle.BAR_COLS}, CAST(bar_open_ts AS DATE) AS event_date,
  'trade_rollup' AS source, '1m' AS timeframe FROM minute"""))
def stream_rolling_bars(spark, sf_dir):
    """One-minute bars as a stream of three batches without order: all bars, late trades included."""
    base = scratch_path(spark, "stream-bars")
    trades = inputs.clean_trades(spark, sf_dir).drop("_raw_json")
    trades.repartition(3, "trade_id").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    _finish(refine.merge_bars(stream, f"{base}/out", f"{base}/checkpoints", available_now=True))
    return refine.merged_bars(spark, f"{base}/out")


@query("stream_bars_two_starts", oracle.with_(oracle.MINUTE, f"""
SELECT bar_open_ts, symbol, 'crypto' AS asset_class, {oracle.BAR_COLS}, CAST(bar_open_ts AS DATE) AS event_date,
  'trade_rollup' AS source, '1m' AS timeframe FROM minute"""))
def stream_bars_two_starts(spark, sf_dir):
    """Two streams with checkpoints of their own feed one table of bars, and the first starts again under a new
    checkpoint: every trade counts once."""
    base = scratch_path(spark, "stream-two")
    trades = inputs.clean_trades(spark, sf_dir).drop("_raw_json")
    half = F.pmod(F.xxhash64("trade_id"), F.lit(2))
    for n in range(2):
        trades.filter(half == n).write.parquet(f"{base}/in/{n}")
    for start, n in enumerate((0, 1, 0)):
        stream = spark.readStream.schema(trades.schema).parquet(f"{base}/in/{n}")
        _finish(refine.merge_bars(stream, f"{base}/out", f"{base}/checkpoints-{start}", available_now=True))
    return refine.merged_bars(spark, f"{base}/out")


@query("stream_market_quality", _QUALITY_FULL_SQL)
def stream_market_quality(spark, sf_dir):
    """Hourly market quality from mergeable state: clean trades in three batches without order and quarantined ones in
    two, all into one table."""
    base = scratch_path(spark, "stream-quality")
    columns = ("event_ts", "symbol", "asset_class", "price", "late_arrival_sec", "trade_id")
    for name, rows, files in (
        ("clean", inputs.clean_trades(spark, sf_dir), 3), ("bad", inputs.quarantined_trades(spark, sf_dir), 2),
    ):
        rows = rows.select(*columns)
        rows.repartition(files, "trade_id").write.parquet(f"{base}/{name}")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")
        _finish(refine.merge_quality(
            stream, f"{base}/out", f"{base}/checkpoints-{name}", clean=name == "clean", available_now=True
        ))
    return _rounded_volatility(refine.merged_quality(spark, f"{base}/out"))


@query("stream_refine_unique", oracle.with_(oracle.CLEAN, f"SELECT {oracle.TRADE_COLS} FROM clean"))
def stream_refine_unique(spark, sf_dir):
    """The Silver half of a feed that delivers everything twice."""
    return _stream_refined(spark, sf_dir, "trades", copies=2).drop("_raw_json")


# --------------------------------------------------------------------------- jobs
# The stored-table jobs, run more than once over tables written from the events.


def _silver_tables(spark, sf_dir, *clocks: str) -> str:
    """A root whose Bronze trades went through the Silver job once at each clock."""
    root = scratch_path(spark, "jobs")
    bronze = table("bronze", "binance_trades")
    rows = conform(inputs.bronze_trades(spark, sf_dir), bronze)
    tables.append(tables.binned(rows, bronze.partition_by), table_path(root, "bronze", bronze.name), bronze.partition_by)
    for clock in clocks:
        jobs.bronze_to_silver(spark, root, "trades", as_of=clock)
    return root


def _places(spark, root: str, **paths: str) -> DataFrame:
    """Where each trade ended up."""
    parts = [
        tables.read_table(spark, f"{root}/silver/{path}", schema="trade_id string").select("trade_id", F.lit(place).alias("place"))
        for place, path in paths.items()
        if tables.holds_files(spark, f"{root}/silver/{path}")
    ]
    return reduce(DataFrame.unionByName, parts)


@query("job_silver_rerun", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT trade_id, CASE WHEN bad THEN 'quarantine' ELSE 'silver' END AS place FROM judged"""))
def job_silver_rerun(spark, sf_dir):
    """The Silver job run twice, a day apart: every trade is in one place, once."""
    root = _silver_tables(spark, sf_dir, AS_OF, "2024-02-02 00:00:00")
    return _places(spark, root, silver="trades", quarantine="quarantine_trades")


@query("job_silver_resume", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT trade_id, CASE WHEN bad THEN 'quarantine' ELSE 'silver' END AS place FROM judged"""))
def job_silver_resume(spark, sf_dir):
    """Bronze arrives in three uneven parts, one without ingest times and one older than what has been read; the
    Silver job resumes after each, and every trade is in one place, once."""
    root = scratch_path(spark, "resume")
    bronze = table("bronze", "binance_trades")
    rows = inputs.bronze_trades(spark, sf_dir)
    timeless = {"_ingest_ts": F.lit(None).cast("timestamp"), "ingestion_date": F.lit(None).cast("date")}
    part = F.pmod(F.xxhash64("trade_id"), F.lit(10))
    parts = [
        rows.filter((F.col("trade_time") >= "2024-01-10") & (part < 7)),
        rows.filter(part >= 7).withColumns(timeless),
        rows.filter((F.col("trade_time") < "2024-01-10") & (part < 7)),
    ]
    for new in parts:
        tables.append(
            tables.binned(conform(new, bronze), bronze.partition_by), table_path(root, "bronze", bronze.name),
            bronze.partition_by,
        )
        jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF, resume=True)
    return _places(spark, root, silver="trades", quarantine="quarantine_trades")


@query("job_replay_conserves", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT trade_id, CASE WHEN f1 OR f2 OR f3 OR f5 OR f6 THEN 'exhausted' ELSE 'silver' END AS place FROM judged"""))
def job_replay_conserves(spark, sf_dir):
    """Three replays without the symbol rule, then Silver again: promoted or exhausted, nothing lost or doubled."""
    root = _silver_tables(spark, sf_dir, AS_OF)
    for _ in range(3):
        jobs.replay_quarantine(spark, root, gate=rules.trade_gate(AS_OF).without("SYMBOL_UNKNOWN"), as_of=AS_OF)
    jobs.bronze_to_silver(spark, root, "trades", as_of="2024-02-02 00:00:00")
    return _places(
        spark, root, silver="trades", quarantine="quarantine_trades", exhausted="quarantine_trades_exhausted"
    )


@query("job_gold_rerun", oracle.with_(
    oracle.MINUTE, "\nUNION ALL BY NAME\n".join(oracle.wide_select(tf) for tf in ("5m", "1h", "1d"))))
def job_gold_rerun(spark, sf_dir):
    """Silver bars and three Gold widths from one scan, built twice."""
    root = _silver_tables(spark, sf_dir, AS_OF)
    for _ in range(2):
        jobs.trades_to_silver_bars(spark, root)
        jobs.silver_to_gold_bars(spark, root, ("5m", "1h", "1d"), as_of=AS_OF)
    gold = [table("gold", f"bars_{width}") for width in ("5m", "1h", "1d")]
    return reduce(DataFrame.unionByName, (
        tables.read_table(spark, table_path(root, "gold", spec.name), schema=spec.schema) for spec in gold
    ))


@query("job_gold_replay_routes", oracle.with_(f"""{oracle.RAW_BARS},
valid AS (
  SELECT symbol, bar_open_ts FROM raw_judged WHERE NOT bad AND timeframe IN ('1m', '1Min') GROUP BY 1, 2)""", """
SELECT 'bars_1m' AS "table", symbol, bar_open_ts FROM valid
UNION ALL SELECT DISTINCT 'bars_1d', symbol, CAST(date_trunc('day', bar_open_ts) AS TIMESTAMP) FROM valid"""))
def job_gold_replay_routes(spark, sf_dir):
    """Gold bars of two widths that all fail a rule for a while: the replay without it takes each back to the table of
    its width."""
    root = scratch_path(spark, "routes")
    spec = table("silver", "bars")
    bars = silver_bars(inputs.bronze_bars(spark, sf_dir)).withColumn("timeframe", rules.short_timeframe())
    one_minute = rules.bar_gate().passing(bars).filter("timeframe = '1m'")
    tables.insert_new(
        spark, conform(one_minute, spec), table_path(root, spec.layer, spec.name), spec.partition_by, spec.key, ("ingest_ts",)
    )
    quarantine = table("gold", "quarantine_bars")
    stored = tables.read_table(spark, table_path(root, spec.layer, spec.name), schema=spec.schema)
    for width in ("1m", "1d"):
        failed = with_metadata(rules.gold_bar_gate().passing(bars_unchecked(stored, width)).withColumn(
            FAILURES_COL, F.array(rules.gold_bar_gate().rules[0].failure())
        ), AS_OF)
        tables.append(conform(failed, quarantine), table_path(root, "gold", quarantine.name), quarantine.partition_by)
    jobs.replay_quarantine(spark, root, "gold", "bars", as_of=AS_OF)
    return reduce(DataFrame.unionByName, (
        tables.read_table(spark, table_path(root, "gold", f"bars_{width}"), schema=table("gold", f"bars_{width}").schema)
        .select(F.lit(f"bars_{width}").alias("table"), "symbol", "bar_open_ts")
        for width in ("1m", "1d")
    ))


@query("job_gold_incremental", oracle.with_(
    oracle.MINUTE, "\nUNION ALL BY NAME\n".join(oracle.wide_select(tf) for tf in ("5m", "1h", "1d"))))
def job_gold_incremental(spark, sf_dir):
    """Gold bars of three widths, brought up to date after each of two deliveries; the second holds new days and late
    trades of old ones. Only changed days are built again, and the bars are those of a full rebuild."""
    root = scratch_path(spark, "incremental")
    bronze = table("bronze", "binance_trades")
    rows = inputs.bronze_trades(spark, sf_dir)
    first = (F.col("trade_time") < "2024-01-20") & ((F.dayofmonth("trade_time") != 5) | (F.col("trade_id") % 2 == 0))
    for part in (rows.filter(first), rows.filter(~first)):
        tables.append(
            tables.binned(conform(part, bronze), bronze.partition_by), table_path(root, "bronze", bronze.name), bronze.partition_by
        )
        jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF, resume=True)
        jobs.refresh_gold(spark, root, AS_OF, ("5m", "1h", "1d"))
    gold = [table("gold", f"bars_{width}") for width in ("5m", "1h", "1d")]
    return reduce(DataFrame.unionByName, (
        tables.read_table(spark, table_path(root, "gold", spec.name), schema=spec.schema) for spec in gold
    ))


@query("retention_left", oracle.with_(oracle.CLEAN, """
SELECT trade_id, event_date FROM clean WHERE event_date >= DATE '2024-01-17'"""))
def retention_left(spark, sf_dir):
    """What retention leaves in a stored table."""
    path = _stored_trades(spark, sf_dir, "expire")
    layout.expire(spark, path, "event_date", AS_OF, 15, f"{path}-archive")
    return tables.read_table(spark, path).select("trade_id", "event_date")


@query("job_vacuum", oracle.with_(oracle.CLEAN, """
SELECT trade_id, 3 AS orphans_removed FROM clean"""))
def job_vacuum(spark, sf_dir):
    """Vacuum of a table with leftovers of writers that died: two old staging folders inside, one old and one fresh beside
    it. The old ones go, and every trade stays."""
    root = scratch_path(spark, "vacuum")
    spec = table("silver", "trades")
    path = table_path(root, spec.layer, spec.name)
    rows = conform(inputs.clean_trades(spark, sf_dir), spec)
    tables.append(tables.binned(rows, spec.partition_by), path, spec.partition_by)
    left = [f"{path}/.spark-staging-0", f"{path}/_temporary", f"{tables.staged_beside(path)}/old"]
    for folder in [*left, f"{tables.staged_beside(path)}/fresh"]:
        tables.append(rows.limit(10), folder)
    for folder in left:
        tables.set_modified(spark, folder, datetime(2024, 1, 1))
    removed = jobs.vacuum(spark, root)
    kept = tables.read_table(spark, path, schema=spec.schema)
    return kept.select("trade_id", F.lit(removed).cast("int").alias("orphans_removed"))


# --------------------------------------------------------------------------- health


def stored_layers(spark, sf_dir) -> str:
    """A root with the published tables stored, each layer made from the stored one below; their counts come from the
    files."""
    root = scratch_path(spark, "layers")

    def put(layer: str, name: str, rows: DataFrame) -> DataFrame:
        spec = table(layer, name)
        path = table_path(root, layer, name)
        tables.append(tables.binned(conform(rows, spec), spec.partition_by), path, spec.partition_by)
        return tables.read_table(spark, path, schema=spec.schema)

    put("bronze", "binance_trades", inputs.bronze_trades(spark, sf_dir))
    put("bronze", "alpaca_bars", inputs.bronze_bars(spark, sf_dir))
    clean = put("silver", "trades", inputs.clean_trades(spark, sf_dir))
    put("silver", "quarantine_trades", inputs.quarantined_trades(spark, sf_dir))
    raw_bars = silver_bars(inputs.bronze_bars(spark, sf_dir))
    put("silver", "bars", rules.bar_gate().passing(raw_bars))
    put("silver", "quarantine_bars", with_metadata(rules.bar_gate().quarantined(raw_bars), AS_OF))
    put("gold", "daily_volume_profile", daily_volume(clean))
    put("gold", "market_quality", with_metric_date(market_quality(clean)))
    put("gold", "bars_5m", gold_bars(one_minute_bars(clean), "5m")[0])
    return root


_COUNTS_CTES = f"{oracle.MINUTE},{oracle.RAW_BARS}"
_COUNTS_SQL = """
SELECT 'strata_bronze_binance_records_total' AS metric_name, 'bronze' AS layer, 'binance_trades' AS "table", count(*) AS value FROM t
UNION ALL SELECT 'strata_bronze_alpaca_bars_records_total', 'bronze', 'alpaca_bars', count(*) FROM raw
UNION ALL SELECT 'strata_silver_trades_records_total', 'silver', 'trades', count(*) FROM clean
UNION ALL SELECT 'strata_silver_quarantine_records_total', 'silver', 'quarantine_trades', count(*) FROM judged WHERE bad
UNION ALL SELECT 'strata_silver_bars_records_total', 'silver', 'bars', count(*) FROM raw_judged WHERE NOT bad
UNION ALL SELECT 'strata_silver_bar_quarantine_records_total', 'silver', 'quarantine_bars', count(*) FROM raw_judged WHERE bad
UNION ALL SELECT 'strata_gold_daily_volume_records_total', 'gold', 'daily_volume_profile', count(*) FROM (SELECT DISTINCT event_date, symbol FROM clean)
UNION ALL SELECT 'strata_gold_market_quality_records_total', 'gold', 'market_quality', count(*) FROM (SELECT DISTINCT date_trunc('hour', event_ts), symbol FROM clean)
UNION ALL SELECT 'strata_gold_bars_5m_records_total', 'gold', 'bars_5m', count(*) FROM (SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, event_ts), symbol FROM clean)"""


@query("table_metrics", oracle.with_(_COUNTS_CTES, _COUNTS_SQL))
def table_metrics(spark, sf_dir):
    return health.stored_table_metrics(spark, stored_layers(spark, sf_dir))


@query("quarantine_alert", oracle.with_(_COUNTS_CTES, f"""
SELECT *, value > 0 AS firing FROM ({_COUNTS_SQL}) WHERE "table" LIKE 'quarantine%'"""))
def quarantine_alert(spark, sf_dir):
    return health.quarantine_alert(health.stored_table_metrics(spark, stored_layers(spark, sf_dir)))


_DRIVER_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
)


_SAMPLES_SQL = """
hours AS (SELECT DISTINCT date_trunc('hour', ingest_ts) AS hr FROM judged),
samples AS (
  SELECT s.symbol, h.hr, (SELECT count(*) FROM judged j WHERE j.bad AND j.symbol = s.symbol AND date_trunc('hour', j.ingest_ts) = h.hr) AS n
  FROM hours h, (VALUES ('BTCUSDT'), ('ETHUSDT'), ('SOLUSDT'), ('AAPL'), ('DEMOUSDT')) s(symbol)),
lagged AS (
  SELECT *, lag(n) OVER w AS n_before, lag(hr) OVER w AS hr_before, max(hr) OVER (PARTITION BY symbol) AS newest
  FROM samples WINDOW w AS (PARTITION BY symbol ORDER BY hr)),
islands AS (
  SELECT *, sum(CASE WHEN coalesce(n_before = 0 OR hr_before < hr - INTERVAL 150 MINUTE, true) THEN 1 ELSE 0 END)
    OVER (PARTITION BY symbol ORDER BY hr) AS island FROM lagged WHERE n > 0),
starts AS (SELECT *, min(hr) OVER (PARTITION BY symbol, island) AS active_since FROM islands),
stretches AS (
  SELECT symbol, active_since, max(hr) AS last_seen, min(CASE WHEN hr >= active_since + INTERVAL 120 MINUTE THEN hr END) AS fired_at,
    max(n) AS highest, max(newest) AS newest FROM starts GROUP BY 1, 2)"""


@query("alert_sustained", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS},{_SAMPLES_SQL}", """
SELECT 'silver' AS layer, symbol AS "table", 'hourly_quarantined' AS metric, active_since, last_seen, fired_at, highest,
  CASE WHEN last_seen = newest AND fired_at IS NOT NULL THEN 'firing' WHEN last_seen = newest THEN 'pending'
       WHEN fired_at IS NOT NULL THEN 'resolved' ELSE 'inactive' END AS state
FROM stretches"""))
def alert_sustained(spark, sf_dir):
    """Alerts on hourly counts of quarantined trades that lasted two hours, from samples in the run log: each
    symbol's count flaps, and hours without any trade are gaps in the samples."""
    hours = inputs.trades(spark, sf_dir).select(F.date_trunc("hour", "ingest_ts").alias("at")).distinct()
    symbols = F.array(*map(F.lit, ("BTCUSDT", "ETHUSDT", "SOLUSDT", "AAPL", "DEMOUSDT")))
    failed = inputs.quarantined_trades(spark, sf_dir).select("symbol", F.date_trunc("hour", "ingest_ts").alias("at"))
    every = hours.select("at", F.explode(symbols).alias("symbol"))
    counts = failed.groupBy("symbol", "at").agg(F.count(F.lit(1)).alias("n"))
    samples = every.join(counts, ["symbol", "at"], "left").select(
        F.lit("silver").alias("layer"), F.col("symbol").alias("table"), F.lit("hourly_quarantined").alias("metric_name"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("value"), "at",
    )
    path = scratch_path(spark, "samples")
    layout.log_samples(path, samples, F.col("at"))
    log = tables.read_table(spark, path, schema=table("gold", "maintenance_metrics").schema)
    return health.lasting_alerts(log, for_minutes=120, stale_minutes=150)


@query("table_counts", "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS n_rows FROM {name}" for name in _DRIVER_TABLES))
def table_counts(spark, sf_dir):
    counts = [
        inputs.load(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table"), "n_rows")
        for name in _DRIVER_TABLES
    ]
    merged = counts[0]
    for one in counts[1:]:
        merged = merged.unionAll(one)
    return merged


@query("health_rates", oracle.with_(f"{oracle.TRADES},{oracle.FLAGS}", """
SELECT CAST(b.n AS DOUBLE) / (g.n + b.n) AS quarantine_ratio, CAST(g.late AS DOUBLE) / g.n AS late_arrival_ratio,
  l.lag AS max_ingest_lag_sec
FROM (SELECT count(*) AS n, count(*) FILTER (late_arrival_sec > 60) AS late FROM judged
      WHERE NOT bad AND event_date >= DATE '2024-01-28') g,
     (SELECT count(*) AS n FROM judged WHERE bad AND CAST(ingest_ts AS DATE) >= DATE '2024-01-28') b,
     (SELECT CAST(max(late_arrival_sec) AS BIGINT) AS lag FROM judged WHERE CAST(ingest_ts AS DATE) >= DATE '2024-01-28') l"""))
def health_rates(spark, sf_dir):
    return health.health_rates(
        inputs.clean_trades(spark, sf_dir),
        inputs.quarantined_trades(spark, sf_dir),
        inputs.bronze_trades(spark, sf_dir),
        "2024-01-29",
    )


# --------------------------------------------------------------------------- function coverage


@query("fn_datetime", """
SELECT event_id, CAST(ts AS DATE) AS d, date_trunc('minute', ts) AS m, date_trunc('hour', ts) AS h,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS dd, epoch_us(ts) // 1000000 AS s,
  ts + INTERVAL 1 MINUTE AS plus_minute, CAST(CAST(ts AS DATE) - 7 AS DATE) AS week_ago,
  to_timestamp(epoch_us(ts) // 1000000)::TIMESTAMP AS from_seconds,
  time_bucket(INTERVAL 5 MINUTE, ts) AS five FROM events""")
def fn_datetime(spark, sf_dir):
    return inputs.events(spark, sf_dir).select(
        "event_id",
        F.to_date("ts").alias("d"),
        F.date_trunc("minute", "ts").alias("m"),
        F.date_trunc("hour", "ts").alias("h"),
        F.date_trunc("day", "ts").alias("dd"),
        F.unix_timestamp("ts").alias("s"),
        F.expr("timestampadd(MINUTE, 1, ts)").alias("plus_minute"),
        F.date_sub(F.to_date("ts"), 7).alias("week_ago"),
        F.from_unixtime(F.unix_timestamp("ts")).cast("timestamp").alias("from_seconds"),
        bucket_start("ts", "5m").alias("five"),
    )


@query("fn_array_struct", """
SELECT event_id, list_filter([event_type, CASE WHEN value > 100 THEN 'big' END], lambda x: x IS NOT NULL)[1] AS first_item,
  CAST(CASE WHEN value > 100 THEN 2 ELSE 1 END AS INTEGER) AS n, event_type = 'click' OR value > 100 AS has_hit,
  event_type AS field FROM events""")
def fn_array_struct(spark, sf_dir):
    tags = F.array_compact(F.array("event_type", F.expr("CASE WHEN value > 100 THEN 'big' END")))
    return inputs.events(spark, sf_dir).select(
        "event_id",
        F.get(tags, F.lit(0)).alias("first_item"),
        F.size(tags).alias("n"),
        F.exists(tags, lambda tag: tag.isin("click", "big")).alias("has_hit"),
        F.struct(F.col("event_type").alias("e"))["e"].alias("field"),
    )


@query("fn_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  '{"id":' || event_id || ',"t":"' || event_type || '"}' AS packed FROM events""")
def fn_json(spark, sf_dir):
    return inputs.events(spark, sf_dir).select(
        "event_id",
        F.from_json("props", "k BIGINT")["k"].alias("k"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("t"))).alias("packed"),
    )


@query("fn_scalar", """
SELECT event_id, event_type || ':' || event_id AS label, regexp_matches(event_type, 'e$') AS ends_in_e,
  CAST(floor(value / 7) AS BIGINT) AS sevens, ((event_id - 50) % 7 + 7) % 7 AS m,
  CASE WHEN value > 250 THEN 'high' WHEN value > 100 THEN 'mid' ELSE 'low' END AS band,
  event_type IN ('click', 'view') AND NOT (value < 5) AS chosen, props IS NULL AS missing FROM events""")
def fn_scalar(spark, sf_dir):
    value = F.col("value")
    return inputs.events(spark, sf_dir).select(
        "event_id",
        F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")).alias("label"),
        F.rlike("event_type", F.lit("e$")).alias("ends_in_e"),
        F.floor(value / 7).alias("sevens"),
        F.pmod(F.col("event_id") - 50, F.lit(7)).alias("m"),
        F.when(value > 250, "high").when(value > 100, "mid").otherwise("low").alias("band"),
        (F.col("event_type").isin("click", "view") & ~(value < 5)).alias("chosen"),
        F.col("props").isNull().alias("missing"),
    )


@query("fn_aggregate", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total, min(value) AS low,
  max(value) AS high, round(stddev_samp(value), 6) AS spread, arg_min(event_id, ts) AS first_id,
  arg_max(event_id, ts) AS last_id, round(avg(value), 6) AS mean FROM events GROUP BY 1""")
def fn_aggregate(spark, sf_dir):
    return inputs.events(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(18,4)")).alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.round(F.stddev("value"), 6).alias("spread"),
        F.min_by("event_id", "ts").alias("first_id"),
        F.max_by("event_id", "ts").alias("last_id"),
        F.round(F.avg("value"), 6).alias("mean"),
    )
