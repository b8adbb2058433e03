"""How streams are started.

A file sink would keep a log of every file ever written in the table folder, which grows with the
table and forbids compaction and retention. Instead each batch is written by `foreachBatch`, exactly once, through
the ledger of its table (`strata.streaming.ledger`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

TRIGGER_SECONDS = 30


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()
