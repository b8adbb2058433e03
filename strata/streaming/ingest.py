"""Landing files -> Bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.schemas import table_path
from strata.sources import inference
from strata.sources.feeds import FEEDS, Feed, annotate, promoted, stream_evolving, stream_jsonl
from strata.streaming.ledger import LedgerAppender
from strata.streaming.sinks import TRIGGER_SECONDS, start


def write_bronze(
    records: DataFrame,
    source: str,
    path: str,
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
    ingested_at: Column | None = None,
) -> StreamingQuery:
    """Annotate a streaming frame and append it, partitioned by ingestion day.

    The checkpoint remembers consumed files and the batch clock, so a repeated batch carries the same
    `_ingest_ts` and a restart neither repeats nor loses rows.
    """
    sink = LedgerAppender(path, "ingestion_date")
    return start(
        annotate(records, source, ingested_at),
        sink.write,
        checkpoint,
        trigger_seconds,
        available_now,
    )


def ingest(
    spark: SparkSession,
    feed: Feed | str,
    landing_root: str,
    table_root: str,
    checkpoint_root: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    evolving: bool = False,
    promoted_fields: dict[str, str] | None = None,
    inferred: bool = False,
) -> StreamingQuery:
    """Start the ingest of one feed; every feed has its own table and checkpoint.

    `evolving` loses nothing: Bronze then holds the line itself as `_raw_json`, fields outside the declared
    schema as JSON text in `_rescued`, and malformed lines with `_corrupt` set. At a later start
    `promoted_fields` (name to type) makes columns of such fields. With `inferred` the fields and types are learnt
    from what is stored, at every start; `inference.read_inferred` reads such a table.
    """
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    folder = f"{landing_root}/{spec.landing_subdir}"
    if evolving or inferred:
        learnt = inference.learn_fields(spark, table_root, spec) if inferred else {}
        types = {**{name: kinds[-1] for name, kinds in learnt.items()}, **(promoted_fields or {})}
        lines = stream_evolving(spark, folder, promoted(spec.wire, types), max_files_per_trigger)
        lines = inference.into_columns(lines, learnt)
        records = lines.withColumn("_rescued", F.to_json("_rescued"))  # maps cannot be compared on a restart
    else:
        records = stream_jsonl(spark, folder, spec.wire, max_files_per_trigger)
    return write_bronze(
        records,
        spec.source,
        table_path(table_root, "bronze", spec.bronze_table),
        f"{checkpoint_root}/bronze/{spec.bronze_table}",
        trigger_seconds,
        available_now,
    )
