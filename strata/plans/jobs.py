"""The batch jobs between stored layers, as plain functions.

Silver tables grow by insert-if-absent, quarantine by content, Gold is replaced by whole days, so any job
can be run again, at any time, without adding a row twice. A job reads the clock once.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import health, layout
from strata.operators.bars import GOLD_TIMEFRAMES, bars_together_unchecked, bars_unchecked, one_minute_bars
from strata.operators.profiles import (
    daily_volume,
    market_quality_with_quarantine,
    with_metric_date,
)
from strata.operators.quality import QualityGate
from strata.operators.quarantine import METADATA, Replay, with_metadata
from strata.operators.rules import SHORT_TIMEFRAMES, bar_gate, gold_bar_gate, short_timeframe, trade_gate
from strata.operators.typed import silver_bars, silver_trades
from strata.schemas import BATCHES, TableSpec, conform, table, table_path
from strata.session import frees_scratch
from strata.sources import consumed
from strata.sources.feeds import feed_of
from strata.sources.tables import (
    append,
    append_missing,
    binned,
    by_content,
    holds_files,
    insert_new,
    partition_filter,
    partition_values,
    read_if_exists,
    read_table,
    replace_partitions,
    since,
    stage,
    table_files,
    unseen,
)

Moment = datetime | str | None


def _path(root: str, spec: TableSpec) -> str:
    return table_path(root, spec.layer, spec.name)


def _read(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return read_table(spark, _path(root, spec), schema=spec.schema)


def _gate(kind: str, as_of: Moment) -> QualityGate:
    return trade_gate(as_of) if kind == "trades" else bar_gate()


def _insert(spark: SparkSession, df: DataFrame, root: str, spec: TableSpec, order) -> None:
    insert_new(spark, conform(df, spec), _path(root, spec), spec.partition_by, spec.key, order)


@frees_scratch
def bronze_to_silver(
    spark: SparkSession,
    root: str,
    kind: str,
    as_of: Moment = None,
    last_ingest_ts: Moment = None,
    bronze_table: str | None = None,
    level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    unique: bool = True,
    resume: bool = False,
) -> None:
    """Type and split new Bronze rows of `trades` or `bars` into Silver and quarantine.

    The typed rows are persisted for the two writes; pass `level=None` for a backfill larger than the
    executors' disks, which then scans Bronze twice. The clock is fixed when the job starts, so both
    halves agree either way. A failed row that is in quarantine, was archived from it or was promoted from it
    is known by its content and does not enter again.

    With `resume` the run reads only the Bronze files that no earlier such run has noted in the ledger of consumed
    files, whatever times their rows carry, and notes its own when all is written.

    Clean rows are inserted if their key is absent. `unique=False` appends them as they are, a job
    without any shuffle, for a first load of a feed that is known to deliver once; such a run must
    start from an empty Silver table when it is repeated.
    """
    names = {"trades": ("binance_trades", silver_trades), "bars": ("alpaca_bars", silver_bars)}
    default_table, normalise = names[kind]
    feed = feed_of(bronze_table or default_table)
    clock = as_of or _now(spark)
    source = table("bronze", feed.bronze_table)
    consumer = f"silver_{kind}:{feed.bronze_table}"
    if resume:
        bronze, files = consumed.unread(spark, root, source, consumer)
        if not files:
            return
    else:
        bronze = _read(spark, root, source)
    typed = normalise(since(bronze, last_ingest_ts), feed.source, feed.asset_class)
    if kind == "bars":
        typed = typed.withColumn("timeframe", short_timeframe())
    if level is not None:
        typed = typed.persist(level)
    try:
        gate = _gate(kind, clock)
        clean, bad = table("silver", kind), table("silver", f"quarantine_{kind}")
        parsed = level is None
        promoted = holds_files(spark, _path(root, clean))  # what this run inserts passes its rules, so it has not failed
        passing = gate.passing(typed, computed=parsed)
        if unique:
            _insert(spark, passing, root, clean, ("ingest_ts",))
        else:
            append(conform(passing, clean), _path(root, clean), clean.partition_by)
        failed = with_metadata(gate.quarantined(typed, computed=parsed), clock)
        _enter(spark, conform(failed, bad), root, bad, promoted_to=clean if promoted else None)
        if resume:
            consumed.note(spark, root, consumer, files, str(clock))
            _log(spark, root, clock, "silver_resume", source, files_read=len(files))
    finally:
        if level is not None:
            typed.unpersist()


def _enter(
    spark: SparkSession, failed: DataFrame, root: str, spec: TableSpec, promoted_to: TableSpec | None = None
) -> None:
    """Add quarantine entries, except rows that are there, have left it for good or were promoted.

    Rows may lack their key, so they are matched by everything but the quarantine's own columns."""
    failed = stage(spark, failed, "failed")
    columns = [c for c in spec.schema.names if c not in METADATA]
    known = [
        read_if_exists(spark, _path(root, spec), schema=spec.schema),
        read_if_exists(spark, f"{_path(root, spec)}_exhausted", schema=spec.schema),
    ]
    known = [k for k in known if k is not None]
    fresh = unseen(failed, known, columns)
    if promoted_to is not None:
        clean = read_if_exists(spark, _path(root, promoted_to), schema=promoted_to.schema)
        if clean is not None:
            if known:  # only days of rows that are left are looked through
                fresh = stage(spark, fresh, "failed-fresh")
            days = [d for d in partition_values(fresh, promoted_to.partition_by) if d is not None]
            if days:
                fresh = unseen(fresh, [clean.filter(F.col(promoted_to.partition_by).isin(days))], columns)
    append(binned(fresh, spec.partition_by), _path(root, spec), spec.partition_by)


def _whole_days(df: DataFrame, where: Column | None, column: str = "event_date") -> tuple[DataFrame, list]:
    """All rows of the days that a condition touches, and the days: a replaced day is built from all of it."""
    days = partition_values(df if where is None else df.filter(where), column)
    if where is None:
        return df, days
    known = [d for d in days if d is not None]
    kept = F.col(column).isin(known) if known else F.lit(False)
    return df.filter(kept | F.col(column).isNull() if None in days else kept), days


@frees_scratch
def trades_to_silver_bars(spark: SparkSession, root: str, where: Column | None = None) -> None:
    """One-minute bars of Silver trades into Silver bars, replacing the days that `where` touches.

    Bars of other sources in those days are kept.
    """
    trades, days = _whole_days(_read(spark, root, table("silver", "trades")), where)
    spec = table("silver", "bars")
    rolled = one_minute_bars(trades).withColumn("ingest_ts", F.lit(_now(spark)).cast("timestamp"))
    fresh = stage(spark, conform(rolled, spec), "rolled-bars")
    existing = read_if_exists(spark, _path(root, spec), schema=spec.schema)
    if existing is not None:
        others = existing.filter(
            F.col(spec.partition_by).isin([d for d in days if d is not None])
            & ~F.col("source").eqNullSafe("trade_rollup")
        )
        fresh = fresh.unionByName(conform(others, spec))
    replace_partitions(spark, fresh, _path(root, spec), spec.partition_by)


@frees_scratch
def silver_to_gold_bars(
    spark: SparkSession,
    root: str,
    timeframe: str | Iterable[str] = "1m",
    where: Column | None = None,
    as_of: Moment = None,
) -> None:
    """Bars of one or several widths for the days that `where` touches, from one scan of Silver.

    The days are replaced in the Gold tables, and so are their failing bars in the Gold quarantine.
    """
    widths = [timeframe] if isinstance(timeframe, str) else list(timeframe)
    source, days = _whole_days(_read(spark, root, table("silver", "bars")), where)
    bad = table("gold", "quarantine_bars")
    columns = [f.name for f in table("gold", "bars_1m").schema.fields]
    parts = [conform(bars_unchecked(source, width), table("gold", f"bars_{width}")) for width in widths if width == "1m"]
    wide = [width for width in widths if width != "1m"]
    if wide:
        parts.append(conform(bars_together_unchecked(source, wide), table("gold", "bars_1m")))
    built = stage(spark, reduce(DataFrame.unionByName, parts).select(*columns), "gold-bars")
    passing, failing = gold_bar_gate().split(built)
    for width in widths:
        spec = table("gold", f"bars_{width}")
        replace_partitions(
            spark, conform(passing.filter(F.col("timeframe").isin(_spellings(width))), spec), _path(root, spec),
            spec.partition_by, days, reads_target=False,
        )
    entries = conform(with_metadata(failing, as_of or _now(spark)), bad)
    _replace_entries(spark, root, bad, entries, widths, days)


def _spellings(width: str) -> list[str]:
    return [width, *(long for long, short in SHORT_TIMEFRAMES.items() if short == width)]


def _replace_entries(spark: SparkSession, root: str, bad: TableSpec, entries: DataFrame, widths: list[str], days: list) -> None:
    """Put new entries in the place of the quarantined bars of some widths and days.

    A bar that failed before as it does now keeps its entry and attempts; one that was archived stays away."""
    path, columns = _path(root, bad), [c for c in bad.schema.names if c not in METADATA]
    archived = read_if_exists(spark, f"{path}_exhausted", schema=bad.schema)
    entries = stage(spark, unseen(entries, [] if archived is None else [archived], columns), "gold-failed")
    existing = read_if_exists(spark, path, schema=bad.schema)
    if existing is None:
        append(binned(entries, bad.partition_by), path, bad.partition_by)
        return
    spelled = [s for width in widths for s in _spellings(width)]
    rebuilt = F.col("timeframe").isin(spelled) & F.col("bar_date").isin([d for d in days if d is not None])
    former = stage(spark, existing.filter(rebuilt), "gold-entries")
    same = by_content(former, entries, columns, "left_semi")
    fresh = unseen(entries, [former], columns)
    touched = sorted({*partition_values(former, bad.partition_by), *partition_values(fresh, bad.partition_by)})
    if not touched:
        return
    others = existing.filter(F.col(bad.partition_by).isin(touched) & ~F.coalesce(rebuilt, F.lit(False)))
    replace_partitions(
        spark, others.unionByName(same).unionByName(fresh), path, bad.partition_by, touched
    )


def _now(spark: SparkSession) -> str:
    """The present as text in the session's zone, free of the Python process's own zone."""
    return spark.sql("SELECT cast(current_timestamp() AS string)").first()[0]


def _silver_trades(spark: SparkSession, root: str, where: Column | None) -> DataFrame:
    return _whole_days(_read(spark, root, table("silver", "trades")), where)[0]


def _replace_gold(spark: SparkSession, df: DataFrame, root: str, name: str) -> None:
    spec = table("gold", name)
    replace_partitions(spark, conform(df, spec), _path(root, spec), spec.partition_by)


@frees_scratch
def trades_to_daily_volume(spark: SparkSession, root: str, where: Column | None = None) -> None:
    """Daily volume of the days that `where` touches, replacing those days."""
    _replace_gold(spark, daily_volume(_silver_trades(spark, root, where)), root,
                  "daily_volume_profile")


@frees_scratch
def trades_to_market_quality(
    spark: SparkSession, root: str, where: Column | None = None
) -> None:
    """Hourly quality of the days that `where` touches, replacing those days."""
    stored, spec = _read(spark, root, table("silver", "trades")), table("silver", "quarantine_trades")
    trades, days = _whole_days(stored, where)
    bad = read_if_exists(spark, _path(root, spec), schema=spec.schema)
    if bad is None:
        bad = trades.filter(F.lit(False))
    elif where is not None:
        bad = bad.filter(F.col("event_date").isin([d for d in days if d is not None]))
    quality = with_metric_date(market_quality_with_quarantine(trades, bad))
    _replace_gold(spark, quality, root, "market_quality")


def refresh_gold(
    spark: SparkSession, root: str, as_of: Moment = None, widths: Iterable[str] = GOLD_TIMEFRAMES
) -> dict[str, int]:
    """Rebuild what changed Silver days stand for: bars of trades, daily volume, market quality and Gold bars.

    The change set is the partition folders of the Silver files that a job has not worked off yet, whoever wrote them; no row is
    read to find it. A job notes its files once its days are written, so a run that died is repeated. Returns
    the number of days each job rebuilt.
    """
    clock = str(as_of or _now(spark))
    trades, bad, bars = table("silver", "trades"), table("silver", "quarantine_trades"), table("silver", "bars")

    def entered_days(files: list[str]) -> list:
        """Quarantine is stored by the day of entry; its new files alone tell the days of the trades."""
        return partition_values(spark.read.schema("event_date DATE").parquet(*files), "event_date")

    steps = (
        ("silver_bars", (trades,), lambda where: trades_to_silver_bars(spark, root, where)),
        ("daily_volume", (trades,), lambda where: trades_to_daily_volume(spark, root, where)),
        ("market_quality", (trades, bad), lambda where: trades_to_market_quality(spark, root, where)),
        ("gold_bars", (bars,), lambda where: silver_to_gold_bars(spark, root, widths, where, as_of)),
    )
    rebuilt = {}
    for name, sources, build in steps:
        days, noted = set(), []
        for source in sources:
            if read_if_exists(spark, _path(root, source), schema=source.schema) is None:
                continue
            consumer = f"{name}:{source.layer}.{source.name}"
            files = consumed.unread(spark, root, source, consumer)[1]
            days |= set(entered_days(files) if source is bad and files else consumed.partition_days(files))
            noted.append((consumer, files))
        if days:
            build(partition_filter("event_date", list(days)))
        for consumer, files in noted:
            consumed.note(spark, root, consumer, files, clock)
        rebuilt[name] = len(days)
        _log(spark, root, clock, "refresh", sources[0], **{f"{name}_days": len(days)})
    return rebuilt


@frees_scratch
def replay_quarantine(
    spark: SparkSession,
    root: str,
    layer: str = "silver",
    kind: str = "trades",
    gate: QualityGate | None = None,
    as_of: Moment = None,
    window_hours: int | None = None,
) -> dict[str, int]:
    """Re-check a quarantine table: promote, retry or archive each row; returns the run counters.

    The clock is read once and the outcomes are stored, so every row goes to exactly one place. Gold bars go
    back to the table of their width. A window of hours looks at when a row entered the quarantine, not at the
    last try: rows that have grown older than it wait for a run without one.

    Order matters for a run that dies: promoted rows are inserted if absent, then the archive is
    written, and only then is the quarantine rewritten without them.
    """
    spec = table(layer, f"quarantine_{kind}")
    clock = as_of or _now(spark)
    default = gold_bar_gate() if layer == "gold" else _gate(kind, clock)
    path = _path(root, spec)
    quarantine = stage(spark, conform(_read(spark, root, spec), spec), "quarantine")
    run = Replay(quarantine, gate or default, clock, window_hours)
    counted = run.observed()
    run.rows = stage(spark, run.rows, "replay")  # each row has one outcome, whatever is done with it below
    counters = counted.get
    if layer == "silver":
        _insert(spark, run.promoted(), root, table(layer, kind), ("ingest_ts",))
    else:
        for width in GOLD_TIMEFRAMES:
            bars = run.promoted().filter(F.col("timeframe").isin(_spellings(width)))
            if not bars.isEmpty():
                _insert(spark, bars, root, table(layer, f"bars_{width}"), ("bar_date",))
    archive = f"{path}_exhausted"
    leaving = run.archive()
    append_missing(
        leaving, archive, spec.partition_by, partition_values(leaving, spec.partition_by),
        F.lit(True),
    )
    replace_partitions(
        spark, run.remaining(), path, spec.partition_by,
        partition_values(quarantine, spec.partition_by), reads_target=False,
    )
    _log(spark, root, clock, "replay", spec, **counters)
    return counters


def _log(spark, root: str, run_ts: Moment, operation: str, spec: TableSpec, **metrics: int) -> None:
    log = table("gold", "maintenance_metrics")
    layout.log_run(
        spark, _path(root, log), run_ts or _now(spark), operation, spec.layer, spec.name, metrics
    )


def _file_count(spark: SparkSession, path: str, where: Column | None) -> int:
    files = table_files(spark, path)
    return (files if where is None else files.filter(where)).count()


@frees_scratch
def _optimize(
    spark: SparkSession, root: str, spec: TableSpec, where: Column | None, target_bytes: int,
    run_ts: Moment,
) -> None:
    path = _path(root, spec)
    before = _file_count(spark, path, where)
    listed = stage(spark, consumed.listing(spark, root, spec), "listing")
    if spec.cluster_by:
        layout.cluster(spark, path, spec.partition_by, spec.cluster_by, where, target_bytes)
    else:
        layout.compact(spark, path, spec.partition_by, where, target_bytes)
    consumed.carry_over(spark, root, listed, consumed.listing(spark, root, spec), str(run_ts or _now(spark)))
    _log(spark, root, run_ts, "cluster" if spec.cluster_by else "compact", spec,
         files_before=before, files_after=_file_count(spark, path, where))


def optimize_hot(
    spark: SparkSession, root: str, as_of: date | datetime | str, layer: str = "silver",
    name: str = "trades", days: int = 2, target_bytes: int = layout.TARGET_FILE_BYTES,
    run_ts: Moment = None,
) -> None:
    """Compact the newest day partitions; tables with cluster columns are clustered as well."""
    spec = table(layer, name)
    where = layout.recent(spec.partition_by, as_of, days)
    _optimize(spark, root, spec, where, target_bytes, run_ts)


def optimize_all(
    spark: SparkSession, root: str, layer: str = "silver", name: str = "trades",
    target_bytes: int = layout.TARGET_FILE_BYTES, run_ts: Moment = None,
) -> None:
    """Cluster a whole table by its registered columns."""
    _optimize(spark, root, table(layer, name), None, target_bytes, run_ts)


def enforce_retention(
    spark: SparkSession, root: str, as_of: date | datetime | str, layer: str = "silver",
    name: str = "trades", archive: bool = True, run_ts: Moment = None,
) -> int:
    """Apply a table's registered retention; tables without one are kept for ever."""
    spec = table(layer, name)
    if spec.keep_days is None:
        return 0
    path = _path(root, spec)
    dropped = layout.expire(
        spark, path, spec.partition_by, as_of, spec.keep_days,
        f"{path}_archive" if archive else None,
    )
    _log(spark, root, run_ts, "expire", spec, partitions_dropped=dropped)
    return dropped


def vacuum(
    spark: SparkSession, root: str, layer: str = "silver", name: str = "trades", retain_hours: int = 168,
    run_ts: Moment = None,
) -> int:
    """Delete what dead writers have left in and beside a table, and old staged copies; data files stay.

    Staged rows of a stream's batch that has begun and is not done are kept: the next writer puts them in."""
    path = _path(root, table(layer, name))
    noted = read_if_exists(spark, f"{path}__batches", schema=BATCHES)
    live: set[str] = set()
    if noted is not None:
        open_batches = noted.groupBy("staged").agg(F.bool_or(F.col("state") == "done").alias("done")).filter("NOT done")
        live = {row.staged.rsplit("/", 1)[-1] for row in open_batches.collect()}  # one for each start that died
    removed = layout.vacuum(spark, path, retain_hours, live)
    scratch = layout.purge_scratch(spark, retain_hours)
    _log(spark, root, run_ts, "vacuum", table(layer, name), orphans_removed=removed, scratch_removed=scratch)
    return removed


def sample_health(spark: SparkSession, root: str, sampled_at: Moment = None) -> None:
    """Note the row counts of all published tables in the run log, for `health.lasting_alerts`."""
    log = table("gold", "maintenance_metrics")
    layout.log_samples(_path(root, log), health.stored_table_metrics(spark, root), sampled_at or _now(spark))
