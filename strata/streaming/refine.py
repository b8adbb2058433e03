"""Streaming Bronze -> Silver and quarantine, and streaming roll-ups."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.market import bucket_start, trade_order, vwap
from strata.operators.profiles import QUALITY_STATE, finished_quality, merged_parts, quality_parts
from strata.operators.quarantine import with_metadata
from strata.operators.rules import bar_gate, short_timeframe, trade_gate
from strata.operators.typed import silver_bars, silver_trades
from strata.schemas import conform, table, table_path
from strata.sources.feeds import FEEDS, Feed
from strata.sources.tables import (
    append, insert_new, partition_values, read_if_exists, read_table, replace_partitions, stage,
)
from strata.streaming.ledger import BatchLedger, LedgerAppender, row_content
from strata.streaming.sinks import TRIGGER_SECONDS, start


def refine(
    bronze: DataFrame,
    kind: str,
    root: str,
    checkpoint: str,
    as_of: datetime | str | None = None,
    feed: Feed | str | None = None,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
    unique: bool = True,
) -> StreamingQuery:
    """Split each micro-batch of `trades` or `bars` into Silver and quarantine, exactly once.

    Clean rows are inserted if their key is absent, as the batch job does, so a feed that delivers twice is
    stored once; `unique=False` appends them without looking. A batch is typed once and persisted for its two writes. The clock of the rules and of the
    quarantine columns is the batch's newest ingest time unless `as_of` is given, so a repeated batch
    makes the same decisions. The feed gives source and asset class.
    """
    normalise, usual_feed = {
        "trades": (silver_trades, "binance"), "bars": (silver_bars, "alpaca"),
    }[kind]
    origin = feed if isinstance(feed, Feed) else FEEDS[feed or usual_feed]
    clean, bad = table("silver", kind), table("silver", f"quarantine_{kind}")
    clean_path = table_path(root, clean.layer, clean.name)
    clean_sink, bad_sink = (
        LedgerAppender(table_path(root, spec.layer, spec.name), spec.partition_by) for spec in (clean, bad)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        typed = normalise(batch, origin.source, origin.asset_class)
        if kind == "bars":
            typed = typed.withColumn("timeframe", short_timeframe())
        typed = typed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # A batch without any time is judged at a fixed moment, so that a repetition agrees.
            newest = F.coalesce(F.max("ingest_ts"), F.max("event_ts"), F.timestamp_seconds(F.lit(0)))
            clock = as_of or typed.agg(newest.cast("string")).first()[0]
            gate = trade_gate(clock) if kind == "trades" else bar_gate()
            if unique:
                insert_new(
                    batch.sparkSession, conform(gate.passing(typed), clean), clean_path, clean.partition_by,
                    clean.key, ("ingest_ts",),
                )
            else:
                clean_sink.write(batch, batch_id, conform(gate.passing(typed), clean))
            bad_sink.write(batch, batch_id, conform(with_metadata(gate.quarantined(typed), clock), bad))
        finally:
            typed.unpersist()

    return start(bronze, write, checkpoint, trigger_seconds, available_now)


def stream_bronze(spark: SparkSession, path: str, schema) -> DataFrame:
    """Follow a Bronze table. Do not compact a table while a stream follows it: the rewritten files
    would count as new ones."""
    return spark.readStream.schema(schema).parquet(path)


def dedup_bars(bars: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Drop bars polled again (same symbol and open time) within the lateness bound.

    State is keyed by bar and dropped by the watermark, so it is bounded by time, not by a count. Bars later
    than the bound are discarded, which Spark counts but does not keep: `keep_first_bars` keeps them.
    """
    return bars.withWatermark("bar_open_ts", lateness).dropDuplicatesWithinWatermark(
        ["symbol", "bar_open_ts"]
    )


def rolling_bars(trades: DataFrame, lateness: str = "5 minutes", width: str = "1 minute") -> DataFrame:
    """One-minute bars as a stream: a bar is emitted once the watermark has passed its end.

    For sinks that can only append. Trades later than the bound are discarded and the last bars stay open;
    `merge_bars` has neither limit.
    """
    return (
        trades.withWatermark("event_ts", lateness)
        .withColumn("_order", F.when(F.col("price").isNotNull(), trade_order()))
        .groupBy(F.window("event_ts", width).alias("_window"), "symbol", "asset_class")
        .agg(
            F.min_by("price", "_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_order").alias("close"),
            F.try_sum("quantity").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
            vwap(F.try_sum("notional"), F.try_sum("quantity")).alias("vwap"),
        )
        .select(
            F.col("_window.start").alias("bar_open_ts"),
            "symbol", "asset_class", "open", "high", "low", "close", "volume", "trade_count", "vwap",
            F.to_date("_window.start").alias("event_date"),
            F.lit("trade_rollup").alias("source"),
            F.lit("1m").alias("timeframe"),
        )
    )


def keep_first_bars(
    bars: DataFrame, path: str, checkpoint: str, trigger_seconds: int = TRIGGER_SECONDS, available_now: bool = False
) -> StreamingQuery:
    """Store polled bars once for each symbol and open time, however late they come.

    The stored table is the state: a key is looked up in its day, so nothing has to be forgotten, and a
    repeated batch adds nothing. Missing symbols and times are values of the key like others."""

    def write(batch: DataFrame, _: int) -> None:
        key = F.to_json(F.array("symbol", F.unix_micros("bar_open_ts").cast("string")))
        rows = batch.withColumns({"bar_key": key, "bar_date": F.to_date("bar_open_ts")})
        order = tuple(c for c in ("_ingest_ts", "seq") if c in rows.columns) or ("timeframe",)
        insert_new(batch.sparkSession, rows, path, "bar_date", ("bar_key",), order)

    return start(bars, write, checkpoint, trigger_seconds, available_now)


_BAR_STATE = (
    "bar_open_ts TIMESTAMP, symbol STRING, asset_class STRING, open DECIMAL(38,18), high DECIMAL(38,18), "
    "low DECIMAL(38,18), close DECIMAL(38,18), volume DECIMAL(38,18), notional DECIMAL(38,6), trade_count BIGINT, "
    "first_order DECIMAL(38,0), last_order DECIMAL(38,0), event_date DATE"
)


def _folded(parts: DataFrame, *more: Column) -> DataFrame:
    """Partial bars of one minute, symbol and asset class combined; the fold is associative."""
    return parts.groupBy("bar_open_ts", "symbol", "asset_class").agg(
        F.min_by("open", "first_order").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_order").alias("close"),
        F.try_sum("volume").alias("volume"),
        F.try_sum("notional").alias("notional"),
        F.sum("trade_count").alias("trade_count"),
        F.min("first_order").alias("first_order"),
        F.max("last_order").alias("last_order"),
        *more,
    ).withColumn("event_date", F.to_date("bar_open_ts"))


class DayMerger:
    """A table of mergeable state by day that streams keep up to date, late rows included, each batch once.

    A batch is folded to parts, and the days it touches are stored anew with them. The ledger of the table knows each batch of
    each stream, so several streams may feed one table, one after the other or together.
    """

    def __init__(self, path: str, schema: str, day: str, rows: str, fold: Callable[[DataFrame], DataFrame]):
        self.path, self.schema, self.day, self.rows, self.fold = path, schema, day, rows, fold
        # The staged rows stand for whole days, so putting them in again changes nothing.
        self.ledger = BatchLedger(path, lambda spark, staged: replace_partitions(
            spark, read_table(spark, staged, schema=schema), path, day
        ))

    def merge(self, batch: DataFrame, batch_id: int, parts: DataFrame) -> None:
        """Merge `parts` of a batch; they also carry `content`, the summed `row_content` of their rows."""
        self.ledger.commit(batch, batch_id, lambda staged: self._stage(parts, staged))

    def _stage(self, parts: DataFrame, staged: str) -> tuple[int, int | None]:
        spark = parts.sparkSession
        fresh = stage(spark, parts, "merge-batch")
        rows, content = fresh.agg(F.expr(f"coalesce(sum({self.rows}), 0)"), F.sum("content")).first()
        if rows:
            fresh = conform(fresh, self.schema)
            stored = read_if_exists(spark, self.path, schema=self.schema)
            if stored is not None:
                same_day = [F.col(self.day).eqNullSafe(F.lit(day)) for day in partition_values(fresh, self.day)]
                touched = stored.filter(reduce(lambda a, b: a | b, same_day))
                fresh = conform(self.fold(touched.unionByName(fresh)), self.schema)
            append(fresh, staged, self.day)
        return rows, content


def _bar_parts(batch: DataFrame) -> DataFrame:
    order = F.when(F.col("price").isNotNull(), trade_order())
    parts = batch.select(
        bucket_start("event_ts", "1m").alias("bar_open_ts"), "symbol", "asset_class",
        F.col("price").alias("open"), F.col("price").alias("high"), F.col("price").alias("low"),
        F.col("price").alias("close"), F.col("quantity").alias("volume"), "notional",
        F.lit(1).alias("trade_count"), order.alias("first_order"), order.alias("last_order"),
        row_content(batch).alias("content"),
    )
    return _folded(parts, F.sum("content").alias("content"))


def merge_bars(
    trades: DataFrame, path: str, checkpoint: str, trigger_seconds: int = TRIGGER_SECONDS, available_now: bool = False
) -> StreamingQuery:
    """One-minute bars kept up to date as trades arrive, late ones included; read them by `merged_bars`."""
    merger = DayMerger(path, _BAR_STATE, "event_date", "trade_count", _folded)
    return start(
        trades, lambda batch, batch_id: merger.merge(batch, batch_id, _bar_parts(batch)), checkpoint, trigger_seconds, available_now
    )


def merged_bars(spark: SparkSession, path: str) -> DataFrame:
    """The bars that `merge_bars` has stored, in the shape of the batch roll-up."""
    return read_table(spark, path, schema=_BAR_STATE).select(
        "bar_open_ts", "symbol", "asset_class", "open", "high", "low", "close", "volume", "trade_count",
        vwap(F.col("notional"), F.col("volume")).alias("vwap"), "event_date",
        F.lit("trade_rollup").alias("source"), F.lit("1m").alias("timeframe"),
    )


def merge_quality(
    trades: DataFrame, path: str, checkpoint: str, clean: bool = True, trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Hourly market quality kept up to date as clean trades, or with `clean` false as quarantined ones, arrive.

    Both streams may feed one table; late trades change their hour without its other trades being read again. Read
    the table by `merged_quality`.
    """
    merger = DayMerger(path, QUALITY_STATE, "metric_date", "clean + bad", merged_parts)

    def write(batch: DataFrame, batch_id: int) -> None:
        content = F.sum(row_content(batch)).alias("content")
        merger.merge(batch, batch_id, quality_parts(batch, clean, content))

    return start(trades, write, checkpoint, trigger_seconds, available_now)


def merged_quality(spark: SparkSession, path: str) -> DataFrame:
    """The market quality that `merge_quality` has stored, in the shape of the batch metric."""
    return finished_quality(read_table(spark, path, schema=QUALITY_STATE))
