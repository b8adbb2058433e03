"""Incremental reads by file: a ledger of the files of a table that each consumer has worked off.

No time mark is needed, so rows without a time, rows that share one, and files that a slow commit shows late
all arrive once. Files of a table are never changed in place, only added, dropped or rewritten under new names.
"""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import TableSpec, conform, table, table_path
from strata.sources.tables import append, day, read_if_exists, read_table, table_files

LEDGER = table("gold", "consumed_files")


def _key(path: str | Column) -> Column:
    """A file is known by its partition folder and its name, wherever the table lies."""
    return F.substring_index(path, "/", -2)


def _ledger(spark: SparkSession, root: str) -> DataFrame | None:
    return read_if_exists(spark, table_path(root, LEDGER.layer, LEDGER.name), schema=LEDGER.schema)


def _append(spark: SparkSession, root: str, entries: DataFrame) -> None:
    dated = entries.withColumn("noted_date", F.to_date("noted_ts"))
    append(conform(dated, LEDGER).coalesce(1), table_path(root, LEDGER.layer, LEDGER.name), LEDGER.partition_by)


def unread(spark: SparkSession, root: str, spec: TableSpec, consumer: str) -> tuple[DataFrame, list[str]]:
    """The rows of the files the consumer has not noted yet, and those files, for `note`.

    The frame reads just these files: what lands after this call belongs to the next one. The driver holds
    their names, as it does for any scan, but no rows.
    """
    path = table_path(root, spec.layer, spec.name)
    whole = read_table(spark, path, schema=spec.schema)
    listed = [unquote(file) for file in whole.inputFiles()]
    known = _ledger(spark, root)
    if known is None or not listed:
        return whole, listed
    names = spark.createDataFrame([(file,) for file in listed], "path string")
    done = known.filter(F.col("consumer") == consumer).select("file").distinct()
    fresh = [row.path for row in names.join(done, _key("path") == F.col("file"), "left_anti").collect()]
    if len(fresh) == len(listed):
        return whole, listed
    if not fresh:
        return whole.limit(0), []
    return spark.read.schema(spec.schema).option("basePath", path).parquet(*fresh), fresh


def note(spark: SparkSession, root: str, consumer: str, files: list[str], at: str) -> None:
    """Remember files as worked off, once everything made from them is written."""
    if files:
        rows = spark.createDataFrame([(file,) for file in files], "path string")
        _append(spark, root, rows.select(
            F.lit(consumer).alias("consumer"), _key("path").alias("file"), F.lit(at).cast("timestamp").alias("noted_ts"),
        ))


def partition_days(files: list[str]) -> list[date | None]:
    """The days of the partition folders that files lie in."""
    labels = {file.rsplit("/", 2)[-2].partition("=")[2] for file in files}
    return [None if label == "__HIVE_DEFAULT_PARTITION__" else day(label) for label in sorted(labels)]


def listing(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The names of a table's files, one row each."""
    return table_files(spark, table_path(root, spec.layer, spec.name)).select(_key("path").alias("file"))


def carry_over(spark: SparkSession, root: str, before: DataFrame, after: DataFrame, at: str) -> None:
    """Tell the ledger that maintenance has rewritten partitions: `before` and `after` are listings, the former stored.

    The new files of a partition count as worked off by a consumer that had worked off all the old ones. If it
    had not, they are read again, which the jobs' inserts by key and content stand.
    """
    known = _ledger(spark, root)
    if known is None:
        return
    folder = F.substring_index("file", "/", 1)
    gone = before.join(after, "file", "left_anti").withColumn("folder", folder)
    new = after.join(before, "file", "left_anti").withColumn("folder", folder)
    needed = gone.groupBy("folder").agg(F.count(F.lit(1)).alias("needed"))
    had = known.select("consumer", "file").distinct().join(gone, "file").groupBy("consumer", "folder").agg(
        F.count(F.lit(1)).alias("had")
    )
    whole = had.join(needed, "folder").filter("had = needed").select("consumer", "folder")
    _append(spark, root, new.join(whole, "folder").select("consumer", "file", F.lit(at).cast("timestamp").alias("noted_ts")))
