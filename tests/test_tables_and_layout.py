from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import multiset
from pyspark.sql import functions as F

from strata.operators import health, layout
from strata.operators.curve import with_morton_key
from strata.plans import jobs
from strata.schemas import BATCHES, TABLES, conform, table, table_path
from strata.session import scratch_path, scratch_root, session_conf
from strata.sources import tables
from strata.sources.generate import benchmark_trades

ROW = "k int, day date, v string, at int"


def rows(spark, *values):
    return spark.createDataFrame([(k, date(2026, 1, d), v, at) for k, d, v, at in values], ROW)


def stored(spark, path):
    return sorted((r.k, r.day.day, r.v) for r in tables.read_table(spark, path).collect())


def test_read_if_exists(spark, root):
    assert tables.read_if_exists(spark, root) is None
    assert tables.row_count(spark, root) == 0
    tables.append(rows(spark, (1, 1, "a", 0)), root, "day")
    assert tables.row_count(spark, root) == 1
    Path(root, "day=2026-01-01", "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        tables.read_if_exists(spark, root)


def test_added_columns_are_merged(spark, root):
    tables.append(rows(spark, (1, 1, "a", 0)), root, "day")
    tables.append(rows(spark, (2, 1, "b", 0)).withColumn("extra", F.lit(7)), root, "day")
    got = {r.k: r.extra for r in tables.read_table(spark, root).collect()}
    assert got == {1: None, 2: 7}


def test_replace_drops_emptied_partitions_only_in_scope(spark, root):
    tables.append(rows(spark, (1, 1, "a", 0), (2, 2, "b", 0), (3, 3, "c", 0)), root, "day")
    kept = tables.read_table(spark, root).filter("k <> 2 AND day <= DATE'2026-01-02'")
    scope = [date(2026, 1, 1), date(2026, 1, 2)]
    tables.replace_partitions(spark, kept.withColumn("v", F.upper("v")), root, "day", scope)
    assert stored(spark, root) == [(1, 1, "A"), (3, 3, "c")]


def test_insert_new_is_idempotent_and_takes_the_latest(spark, root):
    incoming = rows(spark, (1, 1, "old", 1), (1, 1, "new", 2), (2, 2, "b", 1))
    for _ in range(2):
        tables.insert_new(spark, incoming, root, "day", ("k",), ("at",))
    assert stored(spark, root) == [(1, 1, "new"), (2, 2, "b")]
    tables.insert_new(spark, rows(spark, (1, 1, "ignored", 9), (3, 1, "c", 0)), root, "day", ("k",), ("at",))
    assert stored(spark, root) == [(1, 1, "new"), (2, 2, "b"), (3, 1, "c")]


def test_upsert_replaces_and_can_move_rows(spark, root):
    tables.append(rows(spark, (1, 1, "a", 0), (2, 1, "b", 0), (3, 3, "c", 0)), root, "day")
    change = rows(spark, (2, 1, "B", 1), (4, 4, "d", 1))
    for _ in range(2):
        tables.upsert(spark, change, root, "day", ("k",), ("at",))
    assert stored(spark, root) == [(1, 1, "a"), (2, 1, "B"), (3, 3, "c"), (4, 4, "d")]
    tables.upsert(spark, rows(spark, (3, 5, "moved", 2)), root, "day", ("k",), ("at",), moves=True)
    assert stored(spark, root) == [(1, 1, "a"), (2, 1, "B"), (3, 5, "moved"), (4, 4, "d")]


def test_hot_keys_do_not_change_an_upsert(spark):
    existing = spark.range(4000).selectExpr("if(id < 3000, 0, id) AS k", "id AS v", "0 AS at")
    incoming = spark.range(2000).selectExpr("if(id < 1500, 0, id + 3000) AS k", "-id AS v", "id AS at")
    from strata.operators.wire import last_per_key

    latest = tables.stage(spark, last_per_key(incoming, ("k",), ("at",)), "hot")
    assert latest.count() == 501
    merged = tables.merged_rows(existing, latest, ("k",))
    assert merged.filter("k = 0").collect()[0].v == -1499
    assert merged.count() == 501 + 1000 - merged.filter("k > 0 AND v < 0 AND k < 4000").count()
    fresh = tables.new_rows(existing, latest, ("k",))
    assert {r.k for r in fresh.collect()} == set(range(4500, 5000)) - set(range(3000, 4000))


def test_append_missing_subtracts_a_partial_attempt(spark, root):
    batch = rows(spark, (1, 1, "a", 5), (1, 1, "a", 5), (2, 1, "b", 5), (3, 2, "c", 5))
    tables.append(rows(spark, (1, 1, "a", 5), (2, 1, "b", 5), (1, 1, "a", 4)), root, "day")
    days = [date(2026, 1, 1), date(2026, 1, 2)]
    for _ in range(2):
        tables.append_missing(batch, root, "day", days, F.col("at") == 5)
    assert stored(spark, root) == [(1, 1, "a"), (1, 1, "a"), (1, 1, "a"), (2, 1, "b"), (3, 2, "c")]


def test_since_prunes_days(spark, root):
    df = spark.range(72).selectExpr(
        "id", "TIMESTAMP'2026-01-01' + make_dt_interval(0, id) AS _ingest_ts",
    ).withColumn("ingestion_date", F.to_date("_ingest_ts"))
    tables.append(df, root, "ingestion_date")
    fresh = tables.since(tables.read_table(spark, root), "2026-01-02 12:00:00")
    assert sorted(r.id for r in fresh.collect()) == list(range(37, 72))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert tables.since(fresh, None) is fresh
    assert tables.high_watermark(fresh).first()[0].day == 3


def test_register_and_name(spark, root):
    tables.append(rows(spark, (1, 1, "a", 0), (2, 2, "b", 0)), root, "day")
    tables.register(spark, "strata_test.t", root)
    assert spark.table("strata_test.t").count() == 2
    assert spark.sql(f"SELECT * FROM {tables.table_name(root)}").count() == 2
    tables.register(spark, "strata_test.t", root)
    spark.sql("DROP DATABASE strata_test CASCADE")


def test_conform(spark):
    spec = table("gold", "bars_1m")
    df = spark.createDataFrame([("X", 1.5, "junk")], "symbol string, open double, extra string")
    out = conform(df, spec)
    assert out.columns == spec.schema.names and "extra" not in out.columns
    assert out.schema["open"].dataType.simpleString() == "decimal(38,18)"
    assert out.first().close is None


def test_catalogue_is_consistent():
    for spec in TABLES.values():
        assert f"{spec.partition_by} DATE" in spec.ddl
        assert all(f"{c} " in spec.ddl for c in (*spec.cluster_by, *spec.key))
    assert table_path("/r/", "gold", "bars_1m") == "/r/gold/bars_1m"


def test_session_conf_is_restored(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="123"):
        assert spark.conf.get(key) == "123"
    assert spark.conf.get(key) == before


@pytest.fixture
def fragmented(spark, root):
    df = benchmark_trades(spark, 20000, "2026-04-30 12:00:00")
    df.repartition(24).write.partitionBy("event_date").parquet(root)
    return root


def files(spark, path):
    return tables.table_files(spark, path).count()


def test_compaction_keeps_rows_and_merges_files(spark, fragmented):
    before, n = multiset(tables.read_table(spark, fragmented)), files(spark, fragmented)
    hot = layout.recent("event_date", "2026-04-30", 2)
    layout.compact(spark, fragmented, "event_date", hot)
    after = files(spark, fragmented)
    assert after < n
    per_day = {str(r.event_date): r["count"]
               for r in tables.table_files(spark, fragmented).groupBy("event_date").count().collect()}
    assert per_day["2026-04-30"] == 1 and per_day["2026-04-27"] > 1
    layout.compact(spark, fragmented, "event_date")
    assert files(spark, fragmented) == len(per_day)
    assert multiset(tables.read_table(spark, fragmented)) == before


def test_a_second_compaction_rewrites_nothing(spark, fragmented):
    layout.compact(spark, fragmented, "event_date")
    names = lambda: sorted(r.path for r in tables.table_files(spark, fragmented).select("path").collect())
    once = names()
    layout.compact(spark, fragmented, "event_date")
    assert names() == once


def test_jobs_free_what_they_stage(spark, tmp_path):
    from strata.session import frees_scratch, stage

    paths = []

    @frees_scratch
    def job(spark):
        paths.append(stage(spark, spark.range(3), "freed").inputFiles()[0])

    job(spark)
    from pathlib import Path
    from urllib.parse import urlparse

    assert not Path(urlparse(paths[0]).path).exists()


def test_what_a_returned_frame_reads_is_freed_by_the_job_around(spark):
    from strata.session import frees_scratch, freeing, stage

    paths = []

    def kept(frame):
        paths.append(frame.inputFiles()[0])
        return frame

    @frees_scratch
    def outer(spark):
        inner = freeing(spark, lambda: kept(stage(spark, kept(stage(spark, spark.range(3), "a")), "b")).filter("id > 0"))
        exists = [Path(p.removeprefix("file://")).exists() for p in paths]
        return exists, inner.count()

    assert outer(spark) == ([False, True], 2)
    assert not any(Path(p.removeprefix("file://")).exists() for p in paths)


def test_a_large_day_is_cut_to_the_target_size(spark, root):
    wide = spark.range(60000).selectExpr("id", "sha2(cast(id AS string), 256) AS v", "DATE'2026-01-01' AS day")
    tables.append(wide.repartition(40), root, "day")
    layout.compact(spark, root, "day", target_bytes=400_000)
    assert 4 <= files(spark, root) <= 20
    assert tables.read_table(spark, root).count() == 60000


def test_clustering_narrows_symbol_ranges(spark, fragmented):
    before = multiset(tables.read_table(spark, fragmented))
    layout.cluster(spark, fragmented, "event_date", ("symbol",), target_bytes=8_000)
    assert multiset(tables.read_table(spark, fragmented)) == before
    spread = (
        tables.read_table(spark, fragmented)
        .groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("symbol").alias("n"))
        .agg(F.avg("n")).first()[0]
    )
    assert spread < 4  # every file held all 8 symbols before


def skipped(path, column, low, high) -> float:
    """The share of files whose footers rule a range of a column out."""
    out, total = 0, 0
    for file in Path(path).rglob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        place = footer.schema.to_arrow_schema().get_field_index(column)
        groups = [footer.row_group(g).column(place).statistics for g in range(footer.num_row_groups)]
        out += all(s.max < low or s.min > high for s in groups)
        total += 1
    return out / total


def test_a_curve_serves_the_second_column_too(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "concat('sym-', lpad(cast(pmod(xxhash64(id, 1), 500) AS string), 4, '0')) AS symbol",
        "cast(pmod(xxhash64(id, 2), 100000) AS double) AS price", "cast(pmod(xxhash64(id, 3), 90) AS int) AS kind",
        "DATE'2026-01-01' AS day", "sha2(cast(id AS string), 256) AS v",
    ).withColumn("price", F.when(F.col("kind") != 7, F.col("price")))
    share = {}
    for curve in (True, False):
        path = str(tmp_path / str(curve))
        tables.append(rows, path, "day")
        layout.cluster(spark, path, "day", ("symbol", "price"), target_bytes=80_000, curve=curve)
        assert multiset(tables.read_table(spark, path).select("symbol", "price", "v")) == multiset(rows.select("symbol", "price", "v"))
        share[curve] = skipped(path, "price", 40_000.0, 42_000.0), skipped(path, "symbol", "sym-0200", "sym-0203")
    assert share[True][0] > 0.6 and share[True][1] > 0.6, share
    assert share[False][0] < 0.2, share


def test_morton_keys_interleave_ranges(spark):
    rows = spark.createDataFrame([(i, f"common-{i:03d}", date(2026, 1, 1 + i % 28), i % 2 == 0) for i in range(256)],
                                 "n int, s string, d date, b boolean")
    got = with_morton_key(rows, ("n", "s"), bits=4).orderBy("n").collect()
    assert [r._curve for r in got[::16]] == [sum(((k >> b) & 1) * 3 << (2 * b) for b in range(4)) for k in range(16)]
    assert with_morton_key(rows, ("d", "b", "n")).filter("_curve IS NULL OR _curve < 0").isEmpty()
    empty = with_morton_key(rows.limit(0), ("n", "s"))
    assert empty.count() == 0 and empty.columns == [*rows.columns, "_curve"]
    nulls = rows.select(F.lit(None).cast("string").alias("s"), F.lit(None).cast("int").alias("n"))
    assert with_morton_key(nulls, ("s", "n")).filter("_curve <> 0").isEmpty()
    with pytest.raises(ValueError):
        with_morton_key(rows, ("n",) * 11)


def test_vacuum_removes_old_orphans_only(spark, root):
    path = f"{root}/silver/trades"
    tables.append(spark.range(5).withColumn("event_date", F.lit(date(2026, 1, 1))), path, "event_date")
    open_batch = f"{tables.staged_beside(path)}/open"
    for folder in (f"{path}/.spark-staging-1", f"{tables.staged_beside(path)}/dead", open_batch):
        tables.append(spark.range(2), folder)
        tables.set_modified(spark, folder, datetime(2026, 1, 1))
    note = [("s", 1, "begun", open_batch, 2, None, None), ("s", 0, "begun", "x/dead", 2, None, None), ("s", 0, "done", "x/dead", 2, None, None)]
    tables.append(spark.createDataFrame(note, BATCHES), f"{path}__batches")
    before = sorted(map(str, Path(path).rglob("part-*")))
    assert jobs.vacuum(spark, root, retain_hours=10**6) == 0
    assert jobs.vacuum(spark, root, run_ts="2026-05-01 00:00:00") == 2
    assert Path(open_batch).exists() and not Path(f"{tables.staged_beside(path)}/dead").exists()
    assert sorted(map(str, Path(path).glob("event_date=*/part-*"))) == [f for f in before if "staging" not in f]
    assert jobs.vacuum(spark, root) == 0 and jobs.vacuum(spark, root, "silver", "bars") == 0


def test_alerts_that_last(spark):
    at = lambda minute: datetime(2026, 5, 1, 12) + timedelta(minutes=minute)
    made = {
        "steady": [(m, 1) for m in range(0, 13)],
        "flapping": [(m, int(m % 6 != 5)) for m in range(0, 30)],
        "gap": [(m, 2) for m in (*range(0, 8), *range(20, 28))],
        "healed": [*((m, 3) for m in range(0, 11)), (11, 0)],
        "quiet": [(0, 0)],
    }
    rows = [(at(m), "silver", name, "n", v) for name, points in made.items() for m, v in points]
    rows += [(at(3), "silver", "steady", "n", 0), (at(4), "silver", "steady", "n", None), (None, "silver", "steady", "n", 0)]
    samples = spark.createDataFrame(rows, "run_ts timestamp, layer string, table string, metric string, value bigint")
    got = {(r.table, r.active_since): (r.state, r.fired_at) for r in health.lasting_alerts(samples).collect()}
    assert got.pop(("steady", at(0))) == ("firing", at(10))
    assert got.pop(("healed", at(0))) == ("resolved", at(10))
    assert got.pop(("gap", at(0))) == ("inactive", None) and got.pop(("gap", at(20))) == ("pending", None)
    assert set(got.values()) == {("inactive", None)} and len(got) == 5
    later = health.lasting_alerts(samples, as_of="2026-05-01 13:00:00").filter("state IN ('firing', 'pending')")
    assert later.isEmpty()
    assert health.lasting_alerts(samples.limit(0)).count() == 0


def test_health_is_sampled_into_the_run_log(spark, root):
    tables.append(spark.range(3), f"{root}/silver/quarantine_trades")
    for minute in (0, 4, 8, 12):
        jobs.sample_health(spark, root, f"2026-05-01 12:{minute:02d}:00")
    log = tables.read_table(spark, f"{root}/gold/maintenance_metrics")
    fired = health.lasting_alerts(log).filter("state = 'firing'").collect()
    assert [(r.table, str(r.fired_at)) for r in fired] == [("quarantine_trades", "2026-05-01 12:12:00")]


def test_clustering_cuts_a_hot_symbol(spark, root):
    hot = spark.range(30000).selectExpr("if(id % 10 = 0, 'B', 'A') AS symbol", "sha2(cast(id as string), 256) v",
                                        "DATE'2026-01-01' AS day")
    sizes = [r["count"] for r in layout.clustered(hot, "day", ("symbol",), 6)
             .groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 30000 / 2


def test_clustering_bounds_what_a_task_sorts(spark, root, monkeypatch):
    """Repeated values pack to nothing in files, but a sort holds each of them: stored bytes alone made one task."""
    monkeypatch.setattr(layout, "SORTED_BYTES", 1 << 20, raising=False)
    rows = spark.range(20_000).selectExpr(
        "concat('S', id % 3) AS symbol", "repeat('same ', 40) AS note", "cast(7 AS decimal(38,18)) AS price",
        "if(id % 2 = 0, null, array('a', 'b')) AS tags", "DATE'2026-01-01' AS day",
    )
    tables.append(rows, root, "day")
    layout.cluster(spark, root, "day", ("symbol",))
    stored = tables.read_table(spark, root)
    counts = [r["count"] for r in stored.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(counts) >= 5 and max(counts) < 20_000 / 3
    assert multiset(stored) == multiset(rows)


def test_retention_moves_old_days(spark, fragmented, tmp_path):
    all_rows = multiset(tables.read_table(spark, fragmented))
    archive = str(tmp_path / "archive")
    dropped = layout.expire(spark, fragmented, "event_date", "2026-04-30", 3, archive)
    left = tables.read_table(spark, fragmented)
    assert dropped == 4 and left.agg(F.min("event_date")).first()[0] == date(2026, 4, 27)
    moved = tables.read_table(spark, archive).drop("archive_run")
    assert sorted(multiset(left) + multiset(moved.select(*left.columns))) == all_rows
    assert layout.expire(spark, fragmented, "event_date", "2026-04-30", 3, archive) == 0
    # Rows that turn up late for an archived day join the archive, they do not replace it.
    late = benchmark_trades(spark, 1, "2026-04-01 12:00:00").withColumn("event_date", F.lit(date(2026, 4, 25)))
    tables.append(late, fragmented, "event_date")
    layout.expire(spark, fragmented, "event_date", "2026-05-01", 3, archive)
    assert tables.read_table(spark, archive).filter("event_date = DATE'2026-04-25'").count() > 1


def test_scratch(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(scratch_root(spark)) and path != scratch_path(spark, "x")
    tables.stage(spark, spark.range(3), "purge-me")
    assert layout.purge_scratch(spark, retain_hours=24) == 0


def test_run_log(spark, root):
    layout.log_run(spark, root, "2026-05-01 01:00:00", "compact", "silver", "trades", {"files": 3, "rows": 5})
    got = {(r.metric, r.value, str(r.run_date)) for r in tables.read_table(spark, root).collect()}
    assert got == {("files", 3, "2026-05-01"), ("rows", 5, "2026-05-01")}


def test_health_of_stored_tables(spark, root):
    tables.append(spark.range(3), f"{root}/silver/quarantine_trades")
    tables.append(spark.range(4), f"{root}/silver/trades")
    metrics = health.stored_table_metrics(spark, root)
    got = {r.metric_name: r.value for r in metrics.collect()}
    assert got["strata_silver_trades_records_total"] == 4
    assert got["strata_gold_bars_5m_records_total"] == 0 and len(got) == 9
    firing = {r.table: r.firing for r in health.quarantine_alert(metrics).collect()}
    assert firing == {"quarantine_trades": True, "quarantine_bars": False}
    path = f"{root}/silver/trades"
    assert health.file_count(spark.read.parquet(path)).first().files == len(list(Path(path).glob("*.parquet")))
