"""The plans the design relies on."""

import pytest
from pyspark.sql import functions as F

from strata.operators import market_queries
from strata.operators.bars import gold_bars_together, one_minute_bars
from strata.operators.profiles import daily_volume, market_quality_with_quarantine
from strata.operators.quarantine import Replay, with_metadata
from strata.operators.rules import trade_gate
from strata.session import session_conf
from strata.sources import tables
from strata.sources.generate import benchmark_trades

AS_OF = "2026-04-30 12:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trades")
    tables.append(benchmark_trades(spark, 5000, AS_OF), path, "event_date")
    return tables.read_table(spark, path)


def test_single_symbol_prunes_and_pushes(stored):
    text = plan(market_queries.single_symbol(stored, as_of=AS_OF))
    assert "(event_date" in text and ">= 2026-04-29)" in text
    assert "EqualTo(symbol,BTCUSDT)" in text and "Exchange" not in text


def test_cross_section_reads_few_columns(stored):
    with session_conf(stored.sparkSession, spark__sql__maxMetadataStringLength="2000"):
        text = plan(market_queries.cross_section(stored, as_of=AS_OF))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert ">= 2026-04-30)" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "In(symbol" in scan and "GreaterThanOrEqual(event_ts" in scan
    columns = scan.split("ReadSchema: struct<")[1]
    assert "trade_id" not in columns and "notional" not in columns


def test_counting_reads_one_column(stored):
    scan = plan(market_queries.count_by_symbol(stored))
    assert "ReadSchema: struct<symbol:string>" in scan


@pytest.mark.parametrize(
    "build, exchanges",
    [
        (daily_volume, 1),
        (one_minute_bars, 1),
        (lambda trades: gold_bars_together(one_minute_bars(trades)), 2),
        (lambda trades: market_quality_with_quarantine(trades, trades), 1),
    ],
)
def test_hash_aggregates_with_few_shuffles(stored, build, exchanges):
    text = plan(build(stored))
    assert text.count("Exchange") == exchanges
    assert "partial_" in text and "SortAggregate" not in text and "Join" not in text


def test_replay_is_narrow(stored):
    quarantine = with_metadata(trade_gate(AS_OF).quarantined(stored), AS_OF)
    run = Replay(quarantine, trade_gate(AS_OF), AS_OF, 24)
    for part in (run.promoted(), run.remaining(), run.archive()):
        assert "Exchange" not in plan(part)
    assert plan(run.metrics()).count("Exchange") == 1


def test_insert_shuffles_each_side_once(spark, stored):
    latest = tables.stage(spark, stored.limit(100), "plan-feed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(tables.new_rows(stored, latest, ("trade_id",))).count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_stored_key_is_split(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    path = str(tmp_path / "hot")
    spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 0, id) AS k", "sha2(cast(id AS string), 256) AS v"
    ).repartition(8).write.parquet(path)
    latest = tables.stage(spark, spark.range(50_000).selectExpr("id * 7 + 1 AS k", "'n' AS v"), "hot-feed")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        merged = tables.merged_rows(spark.read.parquet(path), latest, ("k",)).agg(F.max("v"), F.count("v"))
        assert merged.collect()[0][1] == 300_000 + 50_000 - spark.range(300_000).filter(
            "id % 3 <> 0 AND id % 7 = 1 AND id <= 349994").count()
        assert "skew=true" in plan(merged)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
