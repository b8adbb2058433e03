"""Health metrics of the stored tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.market import seconds_between
from strata.operators.layout import recent
from strata.operators.profiles import LATE_AFTER_SECONDS
from strata.schemas import table, table_path
from strata.sources.tables import read_if_exists

# The tables whose row counts are published, with the short name in the metric.
COUNTED = (
    ("bronze", "binance_trades", "bronze_binance"),
    ("bronze", "alpaca_bars", "bronze_alpaca_bars"),
    ("silver", "trades", "silver_trades"),
    ("silver", "quarantine_trades", "silver_quarantine"),
    ("silver", "bars", "silver_bars"),
    ("silver", "quarantine_bars", "silver_bar_quarantine"),
    ("gold", "daily_volume_profile", "gold_daily_volume"),
    ("gold", "market_quality", "gold_market_quality"),
    ("gold", "bars_5m", "gold_bars_5m"),
)


def metric_name(short: str, prefix: str = "strata") -> str:
    return f"{prefix}_{short}_records_total"


def _as_row(counts: DataFrame, metric: str, layer: str, table: str) -> DataFrame:
    return counts.select(
        F.lit(metric).alias("metric_name"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table"),
        F.col("value").cast("bigint").alias("value"),
    )


def table_metrics(tables: Mapping[tuple[str, str], DataFrame], prefix: str = "strata") -> DataFrame:
    """One row per published table present in `tables`, from one job of row counts.

    A count needs no column, so a Parquet table answers from its row-group metadata.
    """
    rows = [
        _as_row(
            tables[(layer, name)].agg(F.count(F.lit(1)).alias("value")),
            metric_name(short, prefix), layer, name,
        )
        for layer, name, short in COUNTED
        if (layer, name) in tables
    ]
    return reduce(DataFrame.unionAll, rows)


def stored_table_metrics(spark: SparkSession, root: str, prefix: str = "strata") -> DataFrame:
    """`table_metrics` of a table root; tables not written yet count 0."""
    tables = {}
    for layer, name, _ in COUNTED:
        stored = read_if_exists(spark, table_path(root, layer, name), schema=table(layer, name).schema)
        tables[(layer, name)] = spark.range(0) if stored is None else stored
    return table_metrics(tables, prefix)


def quarantine_alert(metrics: DataFrame) -> DataFrame:
    """The quarantine metrics with a flag that is set while any row is quarantined."""
    return metrics.filter(F.col("table").startswith("quarantine")).withColumn(
        "firing", F.col("value") > 0
    )


def lasting_alerts(
    samples: DataFrame, for_minutes: int = 10, stale_minutes: int = 5, as_of: datetime | str | None = None
) -> DataFrame:
    """Stretches in which a sampled metric stayed above zero, and whether they lasted long enough to alert.

    `samples` are rows of the run log (run_ts, layer, table, metric, value). A stretch ends with a sample of zero
    or when none has come for `stale_minutes`; a metric that flaps starts anew each time. One row a stretch:
    active_since, last_seen, fired_at (the first sample `for_minutes` after the start, or NULL) and state: `firing`
    or `pending` while the metric's last sample is above zero and not stale at `as_of`, else `resolved` if it
    had fired and `inactive` if not. Repeated samples of one moment count by the highest; NULL values are no samples.

    A metric is one key of the window, a number per sample and no more; read the days of the log that matter.
    """
    key = ["layer", "table", "metric"]
    once = samples.filter("value IS NOT NULL AND run_ts IS NOT NULL").groupBy(*key, "run_ts").agg(F.max("value").alias("value"))
    in_time = Window.partitionBy(*key).orderBy("run_ts")
    gap = F.make_dt_interval(mins=F.lit(stale_minutes))
    before = once.withColumns({
        "above": F.col("value") > 0,
        "starts": F.coalesce(
            (F.lag("value").over(in_time) <= 0) | (F.lag("run_ts").over(in_time) < F.col("run_ts") - gap), F.lit(True)
        ),
        "newest": F.max("run_ts").over(Window.partitionBy(*key)),
    })
    numbered = before.filter("above").withColumn("stretch", F.sum(F.col("starts").cast("int")).over(in_time))
    firing_from = F.col("active_since") + F.make_dt_interval(mins=F.lit(for_minutes))
    since_start = numbered.withColumn("active_since", F.min("run_ts").over(Window.partitionBy(*key, "stretch")))
    stretches = since_start.groupBy(*key, "active_since").agg(
        F.max("run_ts").alias("last_seen"),
        F.min(F.when(F.col("run_ts") >= firing_from, F.col("run_ts"))).alias("fired_at"),
        F.max("value").alias("highest"), F.max("newest").alias("newest"),
    )
    now = F.col("newest") if as_of is None else F.lit(str(as_of)).cast("timestamp")
    lives = (F.col("last_seen") == F.col("newest")) & (now <= F.col("last_seen") + gap)
    fired = F.col("fired_at").isNotNull()
    state = F.when(lives & fired, "firing").when(lives, "pending").when(fired, "resolved").otherwise("inactive")
    return stretches.select(*key, "active_since", "last_seen", "fired_at", "highest", state.alias("state"))


def health_rates(
    clean: DataFrame,
    quarantined: DataFrame,
    bronze: DataFrame,
    as_of: date | datetime | str,
    days: int = 1,
) -> DataFrame:
    """One row: quarantine ratio, late ratio and longest ingest lag over the last days.

    Each part is a global aggregate over pruned day partitions; the parts meet as scalar subqueries.
    """
    good = clean.filter(recent("event_date", as_of, days)).agg(
        F.count(F.lit(1)).alias("_good"),
        F.try_divide(
            F.count_if(F.col("late_arrival_sec") > LATE_AFTER_SECONDS), F.count(F.lit(1))
        ).alias("late_arrival_ratio"),
    )
    bad = quarantined.filter(recent("quarantined_date", as_of, days)).agg(
        F.count(F.lit(1)).alias("_bad")
    )
    lag = bronze.filter(recent("ingestion_date", as_of, days)).agg(
        F.max(seconds_between(F.col("_ingest_ts"), F.col("event_time"))).alias("max_ingest_lag_sec")
    )
    n_bad: Column = bad.scalar()
    return good.select(
        F.try_divide(n_bad, F.col("_good") + n_bad).alias("quarantine_ratio"),
        "late_arrival_ratio",
        lag.scalar().alias("max_ingest_lag_sec"),
    )


def file_count(df: DataFrame) -> DataFrame:
    """Number of files a file-backed frame reads its rows from."""
    return df.select(F.col("_metadata.file_path").alias("f")).distinct().agg(
        F.count(F.lit(1)).alias("files")
    )
