"""Feed registry and JSON-lines scans, batch and streaming.

Landing folders hold `day/hour/minute/*.jsonl` files, so scans look them up recursively; Spark skips
the `.tmp.` files of writers that are not done.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import BAR_WIRE, HISTORY_WIRE, TRADE_WIRE


@dataclass(frozen=True)
class Feed:
    source: str
    asset_class: str
    landing_subdir: str
    bronze_table: str
    wire: str


# The feeds, their asset class, landing folder and Bronze table.
FEEDS = {
    "binance": Feed("binance", "crypto", "binance", "binance_trades", TRADE_WIRE),
    "binance_replay": Feed("binance", "crypto", "replay", "binance_replay_trades", TRADE_WIRE),
    "alpaca": Feed("alpaca", "stock", "alpaca", "alpaca_bars", BAR_WIRE),
    "yfinance": Feed("yfinance", "stock", "yfinance", "yfinance_history", HISTORY_WIRE),
}


def feed_of(bronze_table: str) -> Feed:
    """The feed that fills a Bronze table."""
    return next(feed for feed in FEEDS.values() if feed.bronze_table == bronze_table)


def scan_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Batch scan. Unknown fields are dropped and a malformed line gives a row of NULLs; without a
    schema Spark reads the files once more to infer one."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def stream_jsonl(
    spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def _rescuing(lines: DataFrame, schema: str) -> DataFrame:
    """Text lines -> declared columns, the untouched line, and what the declaration missed."""
    names = [field.split()[0] for field in schema.replace("NOT NULL", "").split(",")]
    known = [F.lit(name) for name in names]
    everything = F.from_json("value", "map<string,string>")
    return lines.select(
        F.col("value").alias("_raw"),
        F.from_json("value", schema.replace(" NOT NULL", "")).alias("_record"),
        everything.alias("_fields"),
        F.col("_metadata.file_path").alias("_file_path"),
    ).select(
        "_record.*",
        "_raw",
        F.map_filter("_fields", lambda key, _: ~key.isin(*known)).alias("_rescued"),
        # from_json gives a NULL map for text that is no JSON object.
        F.col("_fields").isNull().alias("_corrupt"),
        "_file_path",
    )


def scan_evolving(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Batch scan that loses nothing: fields outside `schema` stay in the `_rescued` map and the
    line itself in `_raw`, also when it is malformed (`_corrupt`)."""
    return _rescuing(spark.read.option("recursiveFileLookup", "true").text(path), schema)


def stream_evolving(
    spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming form of `scan_evolving`."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _rescuing(reader.text(path), schema)


def rescued_fields(evolving: DataFrame) -> DataFrame:
    """Names found outside the declared schema, with counts: candidates for promotion to columns."""
    return (
        evolving.select(F.explode(F.map_keys("_rescued")).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def observed_schema(evolving: DataFrame) -> DataFrame:
    """One row: the merged schema of all raw records, as Spark's variant type describes it."""
    return evolving.agg(
        F.schema_of_variant_agg(F.try_parse_json("_raw")).alias("observed_schema")
    )


def promoted(schema: str, fields: dict[str, str]) -> str:
    """The declared schema with rescued fields added as columns, for the next start of the scan."""
    return ", ".join([schema, *(f"{name} {dtype}" for name, dtype in fields.items())])


def raw_field(field: str, dtype: str = "string", raw_col: str = "_raw") -> Column:
    """A field recovered from the raw record, whatever schema the row was read with."""
    return F.get_json_object(raw_col, f"$.{field}").try_cast(dtype)


def annotate(
    records: DataFrame,
    source: str,
    ingested_at: Column | None = None,
    file_path: Column | None = None,
) -> DataFrame:
    """Landing records -> Bronze rows.

    `_raw_json` is the record as parsed (NULL fields left out), or the line itself of an evolving scan. The clock defaults to the query's;
    the file path to the scan's metadata, for frames that are a file scan.
    """
    names = [c for c in records.columns if c not in ("_file_path", "_raw", "_rescued", "_corrupt")]
    kept = [c for c in records.columns if c != "_file_path"]
    own_path = F.col("_file_path") if "_file_path" in records.columns else F.col("_metadata.file_path")
    # An evolving scan has the line itself, which also holds what the declaration missed.
    raw = F.col("_raw") if "_raw" in records.columns else F.to_json(F.struct(*names))
    stamped = records.select(
        *kept,
        raw.alias("_raw_json"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingest_ts"),
        F.lit(source).alias("_source"),
        (own_path if file_path is None else file_path).alias("_file_path"),
    ).drop("_raw")
    return stamped.withColumn("ingestion_date", F.to_date("_ingest_ts"))
