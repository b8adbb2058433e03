"""Helpers the operators of this package share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import session_conf
from strata.sources.tables import stage

BATCH_ROWS, BATCH_BYTES = "500", str(8 << 20)
SCAN_ROWS = "512"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Texts vary from a word to megabytes, so Arrow batches are bounded by rows and by bytes, and scans hold few rows at
    once: Spark's 4,096 texts are one array of many megabytes on an executor's heap, copied each time it grows.

    The settings are read when the frame runs, so they stay with the session.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    df.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", SCAN_ROWS)
    return df


def utf8(column: str) -> Column:
    """A text as its bytes; NULL is the empty text."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string")) % mod


def is_held_out(id_col: str, mod: int, rest: int) -> Column:
    """Whether a row belongs to the held-out fold; a NULL id is in no fold, and never learnt from."""
    return F.coalesce(remainder(id_col, mod) == rest, F.lit(False))


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`work` on every task's batches. Workers live on after their tasks, so Arrow's free memory is given back at the end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return small_batches(df).mapInArrow(task, schema)


def worker_cache(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between the tasks it runs; made anew in a new worker."""
    kept = sys.modules.setdefault("_strata_llm_worker", types.ModuleType("_strata_llm_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def settle(df: DataFrame, label: str) -> DataFrame:
    """`stage`, and let go of the shuffle files of the job that wrote it: nothing reads them again."""
    with session_conf(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return stage(df.sparkSession, df, label)
