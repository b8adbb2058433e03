"""Table layout: compaction, clustering, retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

from strata.operators.curve import with_morton_key
from strata.session import scratch_root, session_conf
from strata.sources.tables import (
    append,
    binned,
    day,
    drop_partitions,
    partition_values,
    read_table,
    replace_partitions,
    staged_beside,
    table_files,
)

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Shuffled rows are larger than the Parquet written from them; a file near the target needs more.
SHUFFLE_TO_FILE = 3
SORTED_BYTES = 512 * 1024 * 1024  # of rows in memory that one task of `cluster` orders


def recent(column: str, as_of: date | datetime | str, days: int) -> Column:
    """Day partitions no older than `days` before `as_of`, as a prunable literal condition."""
    return F.col(column) >= F.lit(day(as_of) - timedelta(days=days))


def clustered(
    df: DataFrame, partition_by: str, cluster_by: tuple[str, ...], files: int | None = None, curve: bool = True
) -> DataFrame:
    """Rows range-partitioned by day and cluster columns, so files have narrow min-max ranges.

    Several columns are ordered along a Morton curve, so that a filter on any of them skips files; without `curve`
    by the first, then the second and so on, which serves the first only. A running number ends the range
    key: one symbol with most of a day is cut over several tasks instead of making one giant file.
    """
    numbered = df.withColumn("_seq", F.monotonically_increasing_id())
    key = list(cluster_by)
    if curve and len(cluster_by) > 1:
        numbered, key = with_morton_key(numbered, cluster_by), ["_curve"]
    order = [partition_by, *key, "_seq"]
    ranged = (
        numbered.repartitionByRange(files, *order) if files else numbered.repartitionByRange(*order)
    )
    return ranged.sortWithinPartitions(*order).drop("_seq", "_curve")


def _part(spark: SparkSession, path: str, where: Column | None) -> DataFrame:
    table = read_table(spark, path)
    return table if where is None else table.filter(where)


def _bytes(spark: SparkSession, path: str, where: Column | None) -> int:
    files = table_files(spark, path)
    total = (files if where is None else files.filter(where)).agg(F.sum("length")).first()[0]
    return total or 0


def _in_memory(df: DataFrame) -> int:
    """About the bytes that the rows of a frame take in memory: what its text holds is summed up, all else is by type.

    Stored bytes do not tell: repeated values pack to nothing in Parquet, but a sort holds each of them."""
    fixed, held = 16, F.lit(0)  # of a row: its place in the order and its NULL bits
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        fixed += 8
        if isinstance(kind, DecimalType) and kind.precision > 18:
            fixed += 16
        elif isinstance(kind, (StringType, BinaryType)):
            held = held + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            held = held + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return df.agg(F.coalesce(F.sum(held.cast("bigint") + fixed), F.lit(0))).first()[0]


def ill_sized(
    spark: SparkSession, path: str, partition_by: str, where: Column | None, target_bytes: int
) -> list:
    """Partitions with more files than their bytes need, or with much larger ones; read from the listing."""
    files = table_files(spark, path)
    per_day = (files if where is None else files.filter(where)).groupBy(partition_by).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")
    )
    needed = F.ceil(F.col("bytes") / target_bytes)
    mean = F.col("bytes") / F.col("n")
    wrong = ((F.col("n") > needed) & (mean < target_bytes / 2)) | (mean > 2 * target_bytes)
    return [row[0] for row in per_day.filter(wrong).collect()]


def compact(
    spark: SparkSession,
    path: str,
    partition_by: str,
    where: Column | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rewrite those of the matching partitions whose files are far from the target size. Rows are unchanged.

    `where` must be a condition on the partition column. Partitions that are well laid out stay as they are,
    so a second run rewrites nothing.
    """
    days = ill_sized(spark, path, partition_by, where, target_bytes)
    if not days:
        return
    same_day = [F.col(partition_by).eqNullSafe(F.lit(day)) for day in days]
    where = reduce(lambda a, b: a | b, same_day)
    with session_conf(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=str(target_bytes * SHUFFLE_TO_FILE),
    ):
        replace_partitions(spark, _part(spark, path, where), path, partition_by)


def cluster(
    spark: SparkSession,
    path: str,
    partition_by: str,
    cluster_by: tuple[str, ...],
    where: Column | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    curve: bool = True,
) -> None:
    """Rewrite the matching partitions ordered by the cluster columns. Rows are unchanged.

    A task writes what makes a file of the target size, or less where these rows take more than `SORTED_BYTES` in memory.
    """
    part = _part(spark, path, where)
    files = max(1, -(-_bytes(spark, path, where) // target_bytes), -(-_in_memory(part) // SORTED_BYTES))
    ordered = clustered(part, partition_by, cluster_by, files, curve)
    replace_partitions(spark, ordered, path, partition_by, rebalance=False)


def unexpired(df: DataFrame, partition_by: str, as_of: date | datetime | str, days: int) -> DataFrame:
    return df.filter(recent(partition_by, as_of, days))


def expired(df: DataFrame, partition_by: str, as_of: date | datetime | str, days: int) -> DataFrame:
    return df.filter(F.col(partition_by) < F.lit(day(as_of) - timedelta(days=days)))


def expire(
    spark: SparkSession,
    path: str,
    partition_by: str,
    as_of: date | datetime | str,
    days: int,
    archive_path: str | None = None,
) -> int:
    """Move partitions older than `days` to the archive (zstd Parquet), or just drop them.

    Archived rows are kept per day and per run, so a later run never replaces what an earlier one
    moved. Nothing is dropped before the archive is written: repeat a run that died with the same
    `as_of` and it overwrites its own part only. Returns the number of partitions dropped.
    """
    old = expired(read_table(spark, path), partition_by, as_of, days)
    values = partition_values(old, partition_by)
    if not values:
        return 0
    if archive_path is not None:
        (
            binned(old.withColumn("archive_run", F.lit(day(as_of))), partition_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(partition_by, "archive_run")
            .parquet(archive_path)
        )
    return drop_partitions(spark, path, partition_by, values)


def _listed(spark: SparkSession, folder: str) -> list:
    """What lies directly in a folder, which may be missing."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.listStatus(target)) if fs.exists(target) else []


def _delete_old(spark: SparkSession, found: list, before: datetime, live: set[str] = frozenset()) -> int:
    """Delete listed paths not written to since a moment, unless their names are live; returns how many."""
    cutoff = before.timestamp() * 1000
    old = [s.getPath() for s in found if s.getModificationTime() < cutoff and s.getPath().getName() not in live]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return sum(bool(path.getFileSystem(conf).delete(path, True)) for path in old)


def purge_scratch(spark: SparkSession, retain_hours: int = 168) -> int:
    """Delete staged copies that no run has written to for `retain_hours`; returns how many."""
    staged = [s for app in _listed(spark, scratch_root(spark)) for s in _listed(spark, app.getPath().toString())]
    return _delete_old(spark, staged, datetime.now() - timedelta(hours=retain_hours))


def orphans(spark: SparkSession, path: str) -> list:
    """What writers have left in and beside a table and no reader lists: folders of writes that never ended."""
    # The folders in which Spark's writers stage files.
    inside = [s for s in _listed(spark, path) if s.getPath().getName().startswith((".spark-staging-", "_temporary"))]
    return inside + _listed(spark, staged_beside(path))


def vacuum(spark: SparkSession, path: str, retain_hours: int = 168, live: set[str] = frozenset()) -> int:
    """Delete the orphans of a table that are older than `retain_hours`; returns how many.

    Data files are never touched, so a reader of the table notices nothing. `live` names staged folders that a
    batch begun and not done will still put in. The folder is listed, not its partitions.
    """
    return _delete_old(spark, orphans(spark, path), datetime.now() - timedelta(hours=retain_hours), live)


def log_run(
    spark: SparkSession,
    path: str,
    run_ts: datetime | str,
    operation: str,
    layer: str,
    table: str,
    metrics: dict[str, int],
) -> None:
    """Append one row per metric of a maintenance run to the run log."""
    rows = [(operation, layer, table, name, int(value)) for name, value in metrics.items()]
    frame = spark.createDataFrame(
        rows, "operation string, layer string, table string, metric string, value bigint"
    )
    _append_log(path, frame.select(
        F.lit(str(run_ts)).cast("timestamp").alias("run_ts"),
        F.to_date(F.lit(str(run_ts)).cast("timestamp")).alias("run_date"),
        "*",
    ))


def log_samples(path: str, metrics: DataFrame, sampled_at: datetime | str | Column, operation: str = "health") -> None:
    """Append table metrics (layer, table, metric_name, value) to the run log as one sample each."""
    at = sampled_at if isinstance(sampled_at, Column) else F.lit(str(sampled_at))
    _append_log(path, metrics.select(
        at.cast("timestamp").alias("run_ts"), F.to_date(at.cast("timestamp")).alias("run_date"),
        F.lit(operation).alias("operation"), "layer", "table", F.col("metric_name").alias("metric"), "value",
    ))


def _append_log(path: str, rows: DataFrame) -> None:
    append(rows.coalesce(1), path, "run_date")
