"""Exactly-once writes of micro-batches: a ledger of batches beside each table.

A batch goes in three steps: its rows (or the new content of the partitions they touch) are staged beside the table,
the ledger notes that the batch has begun and where its rows lie, and the staged files are put in. A last note says
that it is done. A step that a lost driver left open is taken up from the staged files by whoever writes to the table
next, and putting them in twice is the same as once. So no batch is compared with what the table holds.

A batch is known by its stream, which keeps its id in the checkpoint, and its number. When a checkpoint is lost the stream starts
under a new id and reads everything again: a batch of another stream with the same rows counts as this batch repeated.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from threading import Lock
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strata.schemas import BATCHES
from strata.sources.tables import append, delete_path, move_in, read_if_exists, staged_beside

BEGUN, DONE = "begun", "done"

# Batches of several streams of one driver may meet at a table.
_LOCKS: defaultdict[str, Lock] = defaultdict(Lock)


def stream_of(batch: DataFrame) -> str:
    """The id of the running stream, the same after a restart from its checkpoint; empty outside of one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def row_content(df: DataFrame) -> Column:
    """A number for what a row holds. Sums of it tell sets of rows apart, whatever their order."""
    columns = [F.to_json(f.name) if isinstance(f.dataType, MapType) else F.col(f.name) for f in df.schema.fields]
    return F.xxhash64(*columns).cast("decimal(38,0)")


class BatchLedger:
    """The batches of one table. `put_in(spark, staged)` makes staged files part of it, and may be repeated."""

    def __init__(self, table: str, put_in: Callable[[SparkSession, str], None]):
        self.table, self.put_in = table.rstrip("/"), put_in
        self.path = f"{self.table}__batches"
        self.settled = False  # nothing that has begun is left open
        self.newest: dict[str, int] = {}  # the last batch done, by stream

    def entries(self, spark: SparkSession) -> DataFrame | None:
        return read_if_exists(spark, self.path, schema=BATCHES)

    def commit(self, batch: DataFrame, batch_id: int, build: Callable[[str], tuple[int, int | None]]) -> bool:
        """Write a batch unless it has been written. `build(staged)` stages it and returns the number and the summed
        content of its rows; it may read the table. Returns whether the batch was new."""
        spark, stream = batch.sparkSession, stream_of(batch)
        with _LOCKS[self.path]:
            if not self.settled:
                self._take_up(spark)
            if batch_id <= self._newest(spark, stream):
                return False
            staged = f"{staged_beside(self.table)}/{uuid4().hex}"
            rows, content = build(staged)
            fresh = rows > 0 and not self._held(spark, stream, rows, content)
            if fresh:
                self.settled = False
                self._note(spark, stream, batch_id, BEGUN, staged, rows, content)
                self.put_in(spark, staged)
            if rows:
                self._note(spark, stream, batch_id, DONE, staged, rows, content)
            self.settled, self.newest[stream] = True, batch_id
            delete_path(spark, staged)
            return fresh

    def _take_up(self, spark: SparkSession) -> None:
        """Finish what has begun and is not done, in the order it began."""
        noted = self.entries(spark)
        if noted is not None:
            left = noted.groupBy("stream", "batch").agg(
                F.bool_or(F.col("state") == DONE).alias("finished"), F.max_by("staged", "noted_ts").alias("staged"),
                F.max("n_rows").alias("n_rows"), F.max("content").alias("content"), F.min("noted_ts").alias("at"),
            ).filter("NOT finished")
            for row in left.orderBy("at").collect():  # at most one for each start that died
                self.put_in(spark, row.staged)
                self._note(spark, row.stream, row.batch, DONE, row.staged, row.n_rows, row.content)
                delete_path(spark, row.staged)
        self.settled = True

    def _newest(self, spark: SparkSession, stream: str) -> int:
        """The last batch of a stream that is done; read once, as numbers only grow."""
        if stream not in self.newest:
            noted = self.entries(spark)
            done = None if noted is None else noted.filter(
                (F.col("stream") == stream) & (F.col("state") == DONE)
            ).agg(F.max("batch")).first()[0]
            self.newest[stream] = -1 if done is None else done
        return self.newest[stream]

    def _held(self, spark: SparkSession, stream: str, rows: int, content: int | None) -> bool:
        """Whether another stream has written the same rows as one batch."""
        noted = self.entries(spark)
        if noted is None:
            return False
        same = (F.col("n_rows") == rows) & F.col("content").eqNullSafe(F.lit(content).cast("decimal(38,0)"))
        return not noted.filter(same & (F.col("stream") != stream) & (F.col("state") == DONE)).isEmpty()

    def _note(self, spark: SparkSession, *entry) -> None:
        row = spark.createDataFrame([(*entry, None)], BATCHES).withColumn("noted_ts", F.current_timestamp())
        append(row.coalesce(1), self.path)


class LedgerAppender:
    """Appends the batches of streams to one table, each once."""

    def __init__(self, path: str, partition_by: str):
        self.partition_by = partition_by
        self.ledger = BatchLedger(path, lambda spark, staged: move_in(spark, staged, path))

    def write(self, batch: DataFrame, batch_id: int, rows: DataFrame | None = None) -> bool:
        """Append `rows`, by default the batch itself, as what this batch adds to the table."""
        out = batch if rows is None else rows

        def build(staged: str) -> tuple[int, int | None]:
            append(out, staged, self.partition_by)
            stored = read_if_exists(out.sparkSession, staged, schema=out.schema)
            if stored is None:
                return 0, None
            return tuple(stored.agg(F.count(F.lit(1)), F.sum(row_content(out))).first())

        return self.ledger.commit(batch, batch_id, build)
