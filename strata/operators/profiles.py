"""Gold profiles of trades: daily volume and hourly market quality. Plain two-phase aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.market import bucket_start, vwap

LATE_AFTER_SECONDS = 60


def daily_volume(trades: DataFrame) -> DataFrame:
    """Volume, notional, count, price range and vwap per day, symbol and asset class."""
    volume, notional = F.try_sum("quantity"), F.try_sum("notional")
    return trades.groupBy(F.col("event_date").alias("bar_date"), "symbol", "asset_class").agg(
        volume.alias("total_volume"),
        notional.alias("total_notional"),
        F.count(F.lit(1)).alias("trade_count"),
        F.max("price").alias("price_high"),
        F.min("price").alias("price_low"),
        vwap(notional, volume).alias("vwap"),
    )


def _late() -> Column:
    return (F.col("late_arrival_sec") > LATE_AFTER_SECONDS).cast("double")


_HOUR_KEYS = ("metric_hour", "symbol", "asset_class")


def market_quality(trades: DataFrame) -> DataFrame:
    """Hourly count, late ratio (0..1), volatility and price range of clean trades.

    Without the quarantine table its ratio is 0 where a late ratio exists, else NULL.
    """
    hourly = trades.groupBy(
        bucket_start("event_ts", "1h").alias("metric_hour"), "symbol", "asset_class"
    ).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.avg(_late()).alias("late_arrival_pct"),
        F.stddev_samp("price").cast("double").alias("price_volatility"),
        F.max("price").cast("double").alias("price_max"),
        F.min("price").cast("double").alias("price_min"),
    )
    return hourly.withColumn(
        "quarantine_pct", F.when(F.col("late_arrival_pct").isNotNull(), F.lit(0.0))
    )


def market_quality_with_quarantine(clean: DataFrame, quarantined: DataFrame) -> DataFrame:
    """`market_quality` with the real quarantine ratio for every hour that has clean trades.

    Equal to clean-hours LEFT JOIN quarantined-hours, but written as one aggregate over the tagged
    union: one shuffle of partial rows and no join.
    """
    columns = ["event_ts", "symbol", "asset_class", "price", "late_arrival_sec"]
    tagged = clean.select(*columns, F.lit(True).alias("_clean")).unionByName(
        quarantined.select(*columns, F.lit(False).alias("_clean"))
    )
    ok = F.col("_clean")
    price = F.when(ok, F.col("price"))
    hourly = tagged.groupBy(
        bucket_start("event_ts", "1h").alias("metric_hour"), "symbol", "asset_class"
    ).agg(
        F.count_if(ok).alias("trade_count"),
        F.count_if(~ok).alias("_bad"),
        F.avg(F.when(ok, _late())).alias("late_arrival_pct"),
        F.stddev_samp(price).cast("double").alias("price_volatility"),
        F.max(price).cast("double").alias("price_max"),
        F.min(price).cast("double").alias("price_min"),
    )
    return hourly.filter("trade_count > 0").select(
        *_HOUR_KEYS,
        "trade_count",
        "late_arrival_pct",
        (F.col("_bad") / (F.col("trade_count") + F.col("_bad"))).alias("quarantine_pct"),
        "price_volatility",
        "price_max",
        "price_min",
    )


# What is kept of an hour: counts, and the number, mean and squared distances of its prices.
QUALITY_STATE = (
    "metric_hour TIMESTAMP, symbol STRING, asset_class STRING, clean BIGINT, bad BIGINT, timed BIGINT, late BIGINT, "
    "n BIGINT, mean DOUBLE, m2 DOUBLE, price_max DOUBLE, price_min DOUBLE, metric_date DATE"
)


def quality_parts(rows: DataFrame, clean: bool = True, *more: Column) -> DataFrame:
    """The state of some clean or quarantined trades, one row an hour, symbol and asset class, for `merged_parts`."""
    ok = F.lit(clean)
    price = F.when(ok, F.col("price").cast("double"))
    late = F.when(ok, F.col("late_arrival_sec"))
    return rows.groupBy(bucket_start("event_ts", "1h").alias("metric_hour"), "symbol", "asset_class").agg(
        F.count_if(ok).alias("clean"), F.count_if(~ok).alias("bad"),
        F.count(late).alias("timed"), F.count_if(late > LATE_AFTER_SECONDS).alias("late"),
        F.count(price).alias("n"), F.avg(price).alias("mean"), (F.var_pop(price) * F.count(price)).alias("m2"),
        F.max(price).alias("price_max"), F.min(price).alias("price_min"),
        *more,
    ).withColumn("metric_date", F.to_date("metric_hour"))


def _joined(a: Column, b: Column) -> Column:
    """(n, mean, m2) of two sets of numbers together, m2 being the sum of squared distances from the mean."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    share = b["n"] / n
    return F.when(n > 0, F.struct(
        n.alias("n"), (a["mean"] + apart * share).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
    )).otherwise(a)


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same hour put together; associative, so they may come in any order and number.

    The variance is merged by the pairwise formula, which does not lose digits as sums of squares do. A group holds one
    part for each merged frame."""
    spread = F.struct("n", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    sums = [F.sum(c).alias(c) for c in ("clean", "bad", "timed", "late")]
    merged = parts.groupBy(*_HOUR_KEYS, "metric_date").agg(
        *sums, F.aggregate(F.collect_list(spread), nothing, _joined).alias("_spread"),
        F.max("price_max").alias("price_max"), F.min("price_min").alias("price_min"),
    )
    return merged.select("*", "_spread.*").drop("_spread")


def finished_quality(parts: DataFrame) -> DataFrame:
    """Merged parts in the shape of `market_quality_with_quarantine`: the hours that have clean trades."""
    return parts.filter("clean > 0").select(
        *_HOUR_KEYS,
        F.col("clean").alias("trade_count"),
        F.when(F.col("timed") > 0, F.col("late") / F.col("timed")).alias("late_arrival_pct"),
        (F.col("bad") / (F.col("clean") + F.col("bad"))).alias("quarantine_pct"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("price_volatility"),
        "price_max",
        "price_min",
    )


def with_metric_date(quality: DataFrame) -> DataFrame:
    """Add the day column by which the stored table is partitioned."""
    return quality.withColumn("metric_date", F.to_date("metric_hour"))
