"""Market-shaped inputs derived from the driver tables; every one covers its whole source table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bars import one_minute_bars
from strata.operators.quality import FAILURES_COL
from strata.operators.quarantine import with_metadata
from strata.operators.rules import trade_gate
from strata.operators.typed import silver_trades
from strata.schemas import TRADE_WIRE

AS_OF = "2024-02-01 00:00:00"

SYMBOL = (
    "CASE event_type WHEN 'click' THEN 'BTCUSDT' WHEN 'view' THEN 'ETHUSDT' "
    "WHEN 'purchase' THEN 'SOLUSDT' WHEN 'signup' THEN 'AAPL' ELSE 'DEMOUSDT' END"
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a zoned timestamp (the session is UTC) and the number inside `props`."""
    raw = load(spark, sf_dir, "events")
    return raw.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.get_json_object("props", "$.k"),
    })


def bronze_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade per event. Unknown symbols, zero quantities and late arrivals come from the data."""
    return events(spark, sf_dir).selectExpr(
        "'trade' AS event_type",
        "ts AS event_time",
        f"{SYMBOL} AS symbol",
        "event_id AS trade_id",
        "cast(cast(value AS decimal(18,4)) AS string) AS price",
        "k AS quantity",
        "ts AS trade_time",
        "user_id % 2 = 0 AS buyer_is_maker",
        "ts + make_dt_interval(0, 0, 0, event_id % 400) AS _ingest_ts",
        "to_date(ts + make_dt_interval(0, 0, 0, event_id % 400)) AS ingestion_date",
    )


def wire_columns() -> list[str]:
    return [field.split()[0] for field in TRADE_WIRE.split(", ")]


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_trades(bronze_trades(spark, sf_dir))


def clean_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_gate(AS_OF).passing(trades(spark, sf_dir), computed=True)


def quarantined_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed trades as a quarantine table that has been retried: entered when ingested, and the
    attempt counter (0..3) grows with how late the trade came in."""
    failed = with_metadata(trade_gate(AS_OF).quarantined(trades(spark, sf_dir), computed=True), AS_OF)
    return failed.withColumns({
        "_quarantined_ts": F.col("ingest_ts"),
        "quarantined_date": F.to_date("ingest_ts"),
        "_replay_attempts": F.expr("cast(least(3, late_arrival_sec div 100) AS int)"),
    })


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bars of the clean trades."""
    return one_minute_bars(clean_trades(spark, sf_dir))


def bronze_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed bar per event, with inverted ranges, unknown widths, negative volumes and missing
    symbols; hourly open times, so that keys repeat."""
    return events(spark, sf_dir).withColumn("k", F.col("k").cast("bigint")).selectExpr(
        "event_id AS seq",
        "CASE event_type WHEN 'click' THEN 'AAPL' WHEN 'view' THEN 'MSFT' "
        "WHEN 'purchase' THEN 'SPY' WHEN 'signup' THEN 'QQQ' END AS symbol",
        "date_trunc('HOUR', ts) AS bar_open_ts",
        "CASE user_id % 4 WHEN 0 THEN '1m' WHEN 1 THEN '1Min' WHEN 2 THEN '5m' ELSE '2m' END "
        "AS timeframe",
        "value AS open",
        "value + k % 10 - 1 AS high",
        "value - event_id % 10 + 1 AS low",
        "value + k % 3 - 1 AS close",
        "k - 3 AS volume",
        "value AS vwap",
        "k AS trade_count",
        "ts + make_dt_interval(0, 0, 0, event_id % 400) AS _ingest_ts",
    )


def bulk_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bulk trades, day grain, for volume profiles over the largest table."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_shipdate AS date) AS event_date",
        "concat(l_returnflag, l_linestatus) AS symbol",
        "'bulk' AS asset_class",
        "cast(l_quantity AS decimal(38,18)) AS quantity",
        "cast(cast(l_extendedprice AS decimal(18,4)) AS decimal(38,6)) AS notional",
        "cast(l_extendedprice AS decimal(38,18)) AS price",
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades in landing shape, as a stored history to replay."""
    return bronze_trades(spark, sf_dir).select(*wire_columns())


def comparable(df: DataFrame) -> DataFrame:
    """Result columns in types that compare across engines: decimals as doubles, instants without
    zone, failures as the comma-joined codes in rule order."""

    def plain(field) -> Column:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if field.name == FAILURES_COL:
            codes = F.transform(column, lambda failure: failure["error_code"])
            return F.array_join(codes, ",").alias(field.name)
        if kind.startswith("decimal"):
            return column.cast("double").alias(field.name)
        if kind == "timestamp":
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*(plain(field) for field in df.schema.fields))
