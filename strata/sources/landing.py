"""Writing landing files: replay of stored history as JSON lines in time order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.market import as_col
from strata.session import stage

# A landing file holds at most this many records, and those of at most so many seconds.
RECORDS_PER_FILE = 1000
SECONDS_PER_FILE = 10


def in_time_order(
    history: DataFrame, ts_col: str = "event_time", partitions: int | None = None
) -> DataFrame:
    """The history as a totally ordered frame: range partitions, each sorted.

    Without a number Spark takes the session's shuffle partitions and merges small ones; give one for
    a history too large for those.

    A running number joins the range key, so rows sharing one timestamp can be cut into several
    partitions; it also keeps their original order.
    """
    order = (ts_col, "_seq")
    numbered = history.withColumn("_seq", F.monotonically_increasing_id())
    ranged = (
        numbered.repartitionByRange(partitions, *order)
        if partitions
        else numbered.repartitionByRange(*order)
    )
    return ranged.sortWithinPartitions(*order).drop("_seq")


def replay_schedule(
    history: DataFrame, ts_col: str = "event_time", speedup: float = 1.0
) -> DataFrame:
    """Adds `emit_after_sec`: when a paced replay emits the row, counted from its start.

    The gaps between rows, divided by the speed-up, sum to the distance from the first timestamp; a
    speed-up of zero or less replays without pauses.
    """
    if speedup <= 0:
        return history.withColumn("emit_after_sec", F.lit(0.0))
    micros = lambda c: F.unix_micros(as_col(c).cast("timestamp"))
    first = history.agg(F.min(micros(ts_col))).scalar()
    return history.withColumn(
        "emit_after_sec", (micros(ts_col) - first) / F.lit(1_000_000 * float(speedup))
    )


def write_landing(
    records: DataFrame,
    path: str,
    written_at: datetime,
    ts_col: str = "event_time",
    records_per_file: int = RECORDS_PER_FILE,
    partitions: int | None = None,
) -> str:
    """Time-ordered JSON-lines files in the day / hour / minute folder of the moment of writing.

    Files are numbered in time order and hold at most `records_per_file` records; raise that for
    large histories. Pacing is left to the reading stream (`max_files_per_trigger`). Returns the
    folder. Writing again at the same moment replaces its files, so a failed replay can be repeated.
    """
    folder = f"{path.rstrip('/')}/{written_at:%Y-%m-%d/%H/%M}"
    (
        in_time_order(records, ts_col, partitions)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", records_per_file)
        .json(folder)
    )
    return folder


def _fold(limit: int, seconds: int) -> Callable[[pa.Table], pa.Table]:
    """The file that is open, and how full it is, before the records of each moment of one minute."""

    def files(moments: pa.Table) -> pa.Table:
        ordered = moments.sort_by("_ms")
        number, held, opened, before = 0, 0, None, []
        for at, n in zip(ordered.column("_ms").to_pylist(), ordered.column("_n").to_pylist(), strict=True):
            if opened is None:
                opened = at
            elif held >= limit or at - opened >= 1000 * seconds:
                number, held, opened = number + 1, 0, at
            before.append((at, number, held))
            more = (held + n - 1) // limit  # files the moment fills and leaves behind
            number, held, opened = number + more, held + n - more * limit, at if more else opened
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("_ms", "_file", "_held"), zip(*before, strict=True), strict=True)})

    return files


def rotated(
    records: DataFrame, ts_col: str = "event_time", records_per_file: int = RECORDS_PER_FILE,
    seconds_per_file: int = SECONDS_PER_FILE,
) -> DataFrame:
    """Adds `landing_minute` and `landing_file`: the files a writer makes that closes one when it is full or a number of
    seconds have passed since its first record, and begins anew with each minute.

    Which file is open when depends on all records before, but only on how many there are of each millisecond: those
    counts are folded minute by minute, 60,000 at most in one task. A record's place among those of its
    millisecond comes from the counts of the partitions before its own, so no minute or moment is gathered in one task,
    however many records it has. Records without a time come last, in files by number of one minute NULL.
    """
    spark = records.sparkSession
    ms = F.floor(F.unix_micros(as_col(ts_col).cast("timestamp")) / 1000)
    # Stored, since the same rows must be in the same partitions both times.
    held = stage(spark, records.withColumns({
        "_ms": ms, "_part": F.spark_partition_id().cast("bigint"), "_seq": F.monotonically_increasing_id(),
    }), "rotation")
    counts = stage(spark, held.groupBy("_ms", "_part").agg(F.count(F.lit(1)).alias("_n")), "rotation-counts")
    minute = F.floor(F.col("_ms") / 60_000)
    moments = counts.filter("_ms IS NOT NULL").groupBy("_ms").agg(F.sum("_n").alias("_n")).withColumn("_minute", minute)
    states = moments.groupBy("_minute").applyInArrow(
        _fold(records_per_file, seconds_per_file), "_ms bigint, _file bigint, _held bigint"
    )
    so_far = Window.partitionBy("_ms").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("_ms", "_part", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_ahead"))
    own = Window.partitionBy("_part", "_ms").orderBy("_seq")
    placed = held.withColumn("_place", F.row_number().over(own) - 1)
    joined = placed.alias("r").join(ahead.alias("a"), F.col("r._ms").eqNullSafe(F.col("a._ms")) & (F.col("r._part") == F.col("a._part")))
    located = joined.select("r.*", "a._ahead").join(states, "_ms", "left")
    number = F.coalesce("_file", F.lit(0)) + F.floor(
        (F.coalesce("_held", F.lit(0)) + F.col("_ahead") + F.col("_place")) / records_per_file
    )
    return located.select(
        *records.columns, F.timestamp_millis(minute * 60_000).alias("landing_minute"), number.cast("bigint").alias("landing_file")
    )


def write_rotated(
    records: DataFrame, path: str, ts_col: str = "event_time", records_per_file: int = RECORDS_PER_FILE,
    seconds_per_file: int = SECONDS_PER_FILE,
) -> None:
    """JSON-lines files as `rotated` cuts them, one for each minute and number; recursive scans read them."""
    files = rotated(records, ts_col, records_per_file, seconds_per_file)
    files.repartition("landing_minute", "landing_file").write.mode("overwrite").partitionBy(
        "landing_minute", "landing_file"
    ).json(path)
