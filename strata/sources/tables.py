"""Stored tables: Parquet directories partitioned by one day column.

Parquet has no transactions, so a table has one writer at a time. Appends rely on Spark's job commit;
everything that rewrites goes through `replace_partitions`, which swaps whole partitions.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.wire import last_per_key
from strata.schemas import conform
from strata.session import stage

FORMAT = "parquet"


def read_table(
    spark: SparkSession, path: str, fmt: str = FORMAT, schema: StructType | str | None = None
) -> DataFrame:
    """Scan a table.

    With a declared schema only folders are listed. Without one, columns added over time are merged,
    which opens the footer of every file before anything is pruned.
    """
    if schema is not None:
        return spark.read.format(fmt).schema(schema).load(path)
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def read_if_exists(
    spark: SparkSession, path: str, fmt: str = FORMAT, schema: StructType | str | None = None
) -> DataFrame | None:
    """The table, or None when nothing has been written there yet; other errors are raised."""
    try:
        found = read_table(spark, path, fmt, schema)
        return found if schema is None or holds_files(spark, path) else None
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether any data file lies below a path, without listing further than the first."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def row_count(spark: SparkSession, path: str, fmt: str = FORMAT) -> int:
    df = read_if_exists(spark, path, fmt)
    return 0 if df is None else df.count()


def sample_rows(df: DataFrame, columns: Iterable[str] = (), n: int = 5) -> DataFrame:
    """A few rows to look at."""
    picked = list(columns)
    return (df.select(*picked) if picked else df).limit(n)


def table_name(path: str, fmt: str = FORMAT) -> str:
    """How SQL text names a table by its path."""
    return f"{fmt}.`{path}`"


def register(spark: SparkSession, name: str, path: str, fmt: str = FORMAT) -> None:
    """(Re)create `database.table` over an existing directory, partitions included."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rpartition('.')[0]}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if holds_files(spark, path) and _partition_columns(spark, name):
        spark.catalog.recoverPartitions(name)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def binned(df: DataFrame, partition_by: str) -> DataFrame:
    """Rows regrouped so that each task writes one well-filled file of one partition.

    After a shuffle on other keys every task holds rows of every day, and would write a small file
    for each. Rebalancing is sized by AQE from real shuffle statistics: small partitions are merged,
    and a day that holds a third of the table is cut into as many tasks as it needs.
    """
    return df.hint("rebalance", F.col(partition_by))


def append(df: DataFrame, path: str, partition_by: str | None = None, fmt: str = FORMAT) -> None:
    writer = df.write.format(fmt).mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)


def overwrite(df: DataFrame, path: str, partition_by: str | None = None, fmt: str = FORMAT) -> None:
    """Replace a whole table by a frame that does not read it."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)


def append_missing(
    df: DataFrame, path: str, partition_by: str, days: list, former: Column
) -> None:
    """Append what an earlier attempt at the same write did not get to.

    `former` selects, within the day partitions named, the stored rows such an attempt could have
    left. They are subtracted as a multiset, so equal rows are neither lost nor doubled.
    """
    existing = read_if_exists(df.sparkSession, path)
    if existing is not None:
        left = existing.filter(partition_filter(partition_by, days) & former)
        df = df.exceptAll(conform(left, df.schema))
    append(df, path, partition_by)


def partition_filter(column: str, values: list) -> Column:
    """Literals, so that the scan prunes directories before it starts."""
    known = [v for v in values if v is not None]
    hit = F.col(column).isin(known) if known else F.lit(False)
    return hit | F.col(column).isNull() if len(known) < len(values) else hit


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def set_modified(spark: SparkSession, path: str, at: datetime) -> None:
    """Give a folder another modification time."""
    fs, target = _file_system(spark, path)
    fs.setTimes(target, int(at.timestamp() * 1000), -1)


def staged_beside(path: str) -> str:
    """Where writers stage files that are to be moved into a table: the same store, but not the table."""
    return f"{path.rstrip('/')}__staged"


def move_in(spark: SparkSession, staged: str, path: str) -> None:
    """Move the data files of a staged frame into the same partition folders of a table.

    File names are unique, so a move that was cut short goes on with the files that are left.
    """
    fs, source = _file_system(spark, staged)
    if not fs.exists(source):
        return
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = fs.getFileStatus(source).getPath().toString()
    files = fs.listFiles(source, True)
    moves = []
    while files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith(("_", ".")):
            moves.append((file, new_path(f"{path.rstrip('/')}/{file.toString()[len(top) + 1:]}")))
    for file, target in moves:
        fs.mkdirs(target.getParent())
        if fs.exists(target):  # a copying store died between the copy and the removal of the source
            fs.delete(target, False)
        if not fs.rename(file, target):
            raise OSError(f"cannot move {file} to {target}")


def partition_values(df: DataFrame, column: str) -> list:
    """Distinct values of a day column: at most one per directory the driver lists anyway."""
    return [row[0] for row in df.select(column).distinct().collect()]


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable) -> int:
    """Remove whole partition directories; returns how many existed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for value in values:
        label = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={label}")
        dropped += bool(target.getFileSystem(conf).delete(target, True))
    return dropped


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: str,
    scope: list | None = None,
    reads_target: bool = True,
    rebalance: bool = True,
) -> None:
    """Swap in new content for the partitions that `df` holds; other partitions stay.

    `df` may read the table itself: Spark writes all new files aside and swaps the partitions when
    the job commits, so nothing is deleted while it is read. Executors may be lost at any time; a
    driver lost during the swap itself leaves the new files in the table's `.spark-staging-*` folder.

    `scope` names the partitions the new content stands for, and those it left empty are dropped,
    which the overwrite alone would keep. Finding them reads `df` again, so a frame that reads the
    table is staged first in that case.
    """
    if scope is not None and reads_target:
        df = stage(spark, df, "replace")
    (
        (binned(df, partition_by) if rebalance else df)
        .write.format(FORMAT)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .save(path)
    )
    if scope is not None:
        filled = set(partition_values(df, partition_by))
        drop_partitions(spark, path, partition_by, [v for v in scope if v not in filled])


def since(
    df: DataFrame,
    last: datetime | str | None,
    ts_col: str = "_ingest_ts",
    day_col: str | None = "ingestion_date",
) -> DataFrame:
    """Rows after the high watermark; the day condition prunes older partitions from the scan."""
    if last is None:
        return df
    mark = F.lit(str(last)).cast("timestamp")
    newer = df.filter(F.col(ts_col) > mark)
    return newer.filter(F.col(day_col) >= F.to_date(mark)) if day_col else newer


def high_watermark(df: DataFrame, ts_col: str = "_ingest_ts") -> DataFrame:
    """One row: the value to hand to the next `since`."""
    return df.agg(F.max(ts_col).alias("high_watermark"))


def _key_match(left: str, right: str, key: tuple[str, ...]) -> list[Column]:
    """Plain equality, as in SQL MERGE: a NULL in the key matches nothing. It lets the join use the
    partitioning an aggregate on the same key has left."""
    return [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in key]


def new_rows(existing: DataFrame, latest: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Insert-if-absent: the rows of `latest` (one per key) whose key the table lacks.

    Only the key columns of the table are read, and they are made distinct before the join, so a key
    stored many times costs one row.
    """
    known = existing.select(*key).distinct()
    return latest.alias("n").join(known.alias("k"), _key_match("n", "k", key), "left_anti")


def merged_rows(existing: DataFrame, latest: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Update-or-insert: `latest` (one row per key) replaces stored rows of the same key.

    The stored side is only filtered: when the incoming keys are small at run time they are broadcast
    and the stored rows are not shuffled at all. When they are not, both sides of the join are plain
    exchanges if `latest` is staged, and AQE can split a stored key that holds too many rows.
    """
    kept = existing.alias("e").join(
        latest.select(*key).alias("n"), _key_match("e", "n", key), "left_anti"
    )
    return kept.unionByName(latest, allowMissingColumns=True)


def content(columns: list[str]) -> dict[str, Column]:
    """What a row holds in some columns, as 128 bits of hashes; NULL is a content like any other."""
    # Hashes skip NULL, so it is said beside.
    values = [v for c in columns for v in (F.col(c), F.col(c).isNull())]
    return {"_content_a": F.xxhash64(*values), "_content_b": F.xxhash64(F.lit(1), *values)}


def by_content(rows: DataFrame, stored: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join of `rows` with stored rows of the same content in `columns`.

    Hashes are made once a row, before the join, so that it neither moves nor compares texts."""
    typed = stored.select(*(F.col(c).cast(rows.schema[c].dataType).alias(c) for c in columns))
    marks = content(columns)
    return rows.withColumns(marks).join(typed.select(*(m.alias(n) for n, m in marks.items())).distinct(), [*marks], how).drop(*marks)


def unseen(rows: DataFrame, stored: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows whose content in `columns` none of the stored frames has; equal rows are kept together."""
    return reduce(lambda left, frame: by_content(left, frame, columns, "left_anti"), stored, rows)


def insert_new(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    partition_by: str,
    key: tuple[str, ...],
    order: tuple[str, ...],
    everywhere: bool = False,
) -> None:
    """Append the rows whose key the table lacks. Running it twice adds nothing the second time.

    A key is looked for in the partitions the incoming rows fall into, which is enough when the key
    fixes the partition, as a trade id fixes its event date; set `everywhere` when it does not. Rows with a
    NULL in the key are told apart by their content.
    """
    nameless = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key))
    existing = read_if_exists(spark, path, schema=incoming.schema)
    named = last_per_key(incoming.filter(~nameless), key, order)
    latest = stage(spark, named.unionByName(incoming.filter(nameless)), "insert")
    if existing is None:
        append(binned(latest, partition_by), path, partition_by)
        return
    touched = partition_values(latest, partition_by)
    nearby = existing if everywhere else existing.filter(partition_filter(partition_by, touched))
    fresh = new_rows(nearby, latest.filter(~nameless), key)
    loose = unseen(latest.filter(nameless), [nearby.filter(nameless)], latest.columns)
    append(binned(fresh.unionByName(loose), partition_by), path, partition_by)


def upsert(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    partition_by: str,
    key: tuple[str, ...],
    order: tuple[str, ...],
    moves: bool = False,
    schema: StructType | str | None = None,
) -> None:
    """Replace stored rows by incoming rows of the same key, insert the others.

    Only the touched partitions are rewritten. `schema` declares the stored table, so that only folders are listed;
    without it every footer is opened for columns the incoming rows lack. Set `moves` when a row may change its partition: the
    key columns of the whole table are then searched for the partitions that hold the old rows.
    """
    existing = read_if_exists(spark, path, schema=schema)
    if existing is None:
        append(binned(last_per_key(incoming, key, order), partition_by), path, partition_by)
        return
    latest = stage(spark, last_per_key(incoming, key, order), "upsert")
    touched = set(partition_values(latest, partition_by))
    if moves:
        holding = existing.select(*key, partition_by).alias("e").join(
            latest.select(*key).alias("n"), _key_match("e", "n", key), "left_semi"
        )
        touched |= set(partition_values(holding, partition_by))
    nearby = existing.filter(partition_filter(partition_by, list(touched)))
    # Without moves every touched partition keeps at least its incoming rows.
    emptied = list(touched) if moves else None
    replace_partitions(spark, merged_rows(nearby, latest, key), path, partition_by, emptied)


def table_files(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """One row per data file: path, bytes, modification time and partition values.

    Lists files only; their content is not read because the content column is pruned.
    """
    suffix = {"parquet": "*.parquet", "json": "*.json"}.get(fmt, "*")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", suffix)
        .load(path)
        .drop("content")
    )


def day(value: date | datetime | str) -> date:
    """A calendar day from a date, a timestamp or ISO text."""
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else datetime.fromisoformat(value).date()
