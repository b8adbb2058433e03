"""Bronze -> Silver projections: one Project over the scan, no exchange.

Feed values are untrusted text, so every conversion is a `try_` form: a value that does not convert
becomes NULL and is caught by the quality rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.market import money, seconds_between


def _optional(df: DataFrame, name: str, dtype: str) -> Column:
    """A column when the frame has it, else a typed NULL."""
    return (F.col(name) if name in df.columns else F.lit(None).cast(dtype)).alias(name)


def silver_trades(
    bronze: DataFrame, source: str = "binance", asset_class: str = "crypto"
) -> DataFrame:
    """Trades in Silver shape; the notional is decimal(38,6), as Spark types that product."""
    parsed = bronze.select(
        F.col("trade_time").try_cast("timestamp").alias("event_ts"),
        F.col("_ingest_ts").try_cast("timestamp").alias("ingest_ts"),
        "symbol",
        F.expr("CASE WHEN buyer_is_maker THEN 'sell' ELSE 'buy' END").alias("side"),
        money("price").alias("price"),
        money("quantity").alias("quantity"),
        F.concat(F.lit(f"{source}:"), F.col("trade_id").cast("string")).alias("trade_id"),
        _optional(bronze, "_raw_json", "string"),
    )
    return parsed.select(
        "event_ts",
        "ingest_ts",
        F.to_date("event_ts").alias("event_date"),
        F.lit(source).alias("source"),
        F.lit(asset_class).alias("asset_class"),
        "symbol",
        "side",
        "price",
        "quantity",
        F.try_multiply("price", "quantity").alias("notional"),
        "trade_id",
        seconds_between(F.col("ingest_ts"), F.col("event_ts"))
        .try_cast("int").alias("late_arrival_sec"),
        "_raw_json",
    )


def silver_bars(
    bronze: DataFrame, source: str = "alpaca", asset_class: str = "stock"
) -> DataFrame:
    """Bars in Silver shape. Historic feeds lack vwap and trade_count; those become NULL."""
    timed = bronze.withColumns({
        "bar_open_ts": F.col("bar_open_ts").try_cast("timestamp"),
        "_ingest_ts": F.col("_ingest_ts").try_cast("timestamp"),
    })
    return timed.select(
        "bar_open_ts",
        F.col("_ingest_ts").alias("ingest_ts"),
        F.to_date("bar_open_ts").alias("event_date"),
        F.lit(source).alias("source"),
        F.lit(asset_class).alias("asset_class"),
        "symbol",
        "timeframe",
        *(money(price).alias(price) for price in ("open", "high", "low", "close", "volume")),
        _optional(bronze, "vwap", "double").try_cast("decimal(38,18)").alias("vwap"),
        _optional(bronze, "trade_count", "bigint").try_cast("bigint").alias("trade_count"),
        _optional(bronze, "_raw_json", "string"),
    )
