"""Price bars: one-minute roll-up of trades, and wider bars from one-minute bars.

Open and close come from min_by / max_by over a numeric order, never from first / last, so results
do not depend on row order. All aggregates combine before the shuffle: a symbol holding a third of
all trades costs one partial row per bucket and task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.market import TIMEFRAME_SECONDS, bucket_start, trade_order, vwap
from strata.operators.quality import QualityGate
from strata.operators.rules import ONE_MINUTE, gold_bar_gate

GOLD_TIMEFRAMES = tuple(TIMEFRAME_SECONDS)


def one_minute_bars(trades: DataFrame) -> DataFrame:
    """One bar per minute, symbol and asset class."""
    keyed = trades.select(
        bucket_start("event_ts", "1m").alias("bar_open_ts"),
        "symbol",
        "asset_class",
        "price",
        "quantity",
        "notional",
        # A NULL order removes the row from min_by / max_by: trades without price set no open.
        F.when(F.col("price").isNotNull(), trade_order()).alias("_order"),
    )
    return (
        keyed.groupBy("bar_open_ts", "symbol", "asset_class")
        .agg(
            F.min_by("price", "_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_order").alias("close"),
            F.try_sum("quantity").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
            vwap(F.try_sum("notional"), F.try_sum("quantity")).alias("vwap"),
        )
        .withColumns({
            "event_date": F.to_date("bar_open_ts"),
            "source": F.lit("trade_rollup"),
            "timeframe": F.lit("1m"),
        })
    )


def _roll_up(bars: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Combine bars that share `_bucket`. A bar without vwap adds volume but no notional."""
    total = F.try_sum("volume")
    return (
        bars.groupBy(F.col("_bucket").alias("_start"), "symbol", "asset_class", *extra_keys)
        .agg(
            F.min_by("open", "bar_open_ts").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "bar_open_ts").alias("close"),
            total.alias("volume"),
            vwap(F.try_sum(F.try_multiply("vwap", "volume")), total).alias("vwap"),
            F.try_sum("trade_count").alias("trade_count"),
        )
        .withColumnRenamed("_start", "bar_open_ts")
    )


def one_minute_only(bars: DataFrame) -> DataFrame:
    """Bars of other widths would be counted twice; frames without the column are taken as 1m."""
    if "timeframe" not in bars.columns:
        return bars
    return bars.filter(F.col("timeframe").isin(*ONE_MINUTE))


def bars_unchecked(bars_1m: DataFrame, timeframe: str) -> DataFrame:
    """Bars of one width before the Gold rules; `1m` passes the input rows through."""
    bucket = bucket_start("bar_open_ts", timeframe)
    source = one_minute_only(bars_1m)
    if timeframe == "1m":
        return source.withColumn("bar_date", F.to_date("bar_open_ts"))
    return _roll_up(source.withColumn("_bucket", bucket)).withColumns({
        "timeframe": F.lit(timeframe),
        "bar_date": F.to_date("bar_open_ts"),
    })


def gold_bars(
    bars_1m: DataFrame, timeframe: str, gate: QualityGate | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bars of one width, split by the Gold rules into (passing, quarantined)."""
    return (gate or gold_bar_gate()).split(bars_unchecked(bars_1m, timeframe))


def gold_bars_together(
    bars_1m: DataFrame, timeframes: Iterable[str] = ("5m", "1h", "1d")
) -> DataFrame:
    """The bars of several widths that pass the Gold rules."""
    return gold_bar_gate().passing(bars_together_unchecked(bars_1m, timeframes))


def bars_together_unchecked(
    bars_1m: DataFrame, timeframes: Iterable[str] = ("5m", "1h", "1d")
) -> DataFrame:
    """Several widths from one scan and one shuffle: each bar is expanded to its bucket per width,
    and the partial aggregate folds the copies together again inside the map task."""
    wanted = [
        F.struct(F.lit(tf).alias("timeframe"), bucket_start("bar_open_ts", tf).alias("_bucket"))
        for tf in timeframes
    ]
    source = one_minute_only(bars_1m).select(
        "bar_open_ts", "symbol", "asset_class", "open", "high", "low", "close", "volume", "vwap",
        "trade_count", F.inline(F.array(*wanted)).alias("timeframe", "_bucket"),
    )
    return _roll_up(source, ("timeframe",)).withColumn("bar_date", F.to_date("bar_open_ts"))
