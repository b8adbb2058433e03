import json
from datetime import datetime
from pathlib import Path

import pytest
from helpers import BRONZE_DDL, trade, write_lines
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.bars import one_minute_bars
from strata.operators.profiles import finished_quality, market_quality, merged_parts, quality_parts
from strata.operators.typed import silver_trades
from strata.plans.jobs import bronze_to_silver
from strata.schemas import BAR_WIRE, TRADE_WIRE, table_path
from strata.sources import feeds, inference, tables
from strata.streaming import ingest, refine
from strata.streaming import ledger as batches


@pytest.fixture
def lake(tmp_path):
    return {name: str(tmp_path / name) for name in ("landing", "tables", "checkpoints")}


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def start_ingest(spark, lake, feed="binance", **more):
    return ingest.ingest(spark, feed, lake["landing"], lake["tables"], lake["checkpoints"],
                         available_now=True, **more)


def bronze_rows(spark, lake, name="binance_trades"):
    return tables.read_table(spark, table_path(lake["tables"], "bronze", name))


def minute_folder(lake, feed, minute):
    return f"{lake['landing']}/{feed}/2026-04-30/12/{minute}"


def test_ingest_and_restart(spark, lake):
    write_lines(minute_folder(lake, "binance", "00"), "s-1.jsonl", [trade(42), "{broken"])
    run(start_ingest(spark, lake))
    rows = bronze_rows(spark, lake).collect()
    good = next(r for r in rows if r.trade_id == 42)
    assert len(rows) == 2 and good._source == "binance"
    assert good._file_path.endswith("s-1.jsonl") and json.loads(good._raw_json)["trade_id"] == 42
    run(start_ingest(spark, lake))
    assert bronze_rows(spark, lake).count() == 2
    write_lines(minute_folder(lake, "binance", "01"), "s-2.jsonl", [trade(43)])
    run(start_ingest(spark, lake))
    assert sorted(str(r.trade_id) for r in bronze_rows(spark, lake).collect()) == ["42", "43", "None"]


def test_added_field_does_not_break_the_stream(spark, lake):
    write_lines(minute_folder(lake, "binance", "00"), "v1.jsonl", [trade(1)])
    run(start_ingest(spark, lake))
    write_lines(minute_folder(lake, "binance", "01"), "v2.jsonl", [{**trade(2), "is_self_match": True}])
    run(start_ingest(spark, lake))
    rows = bronze_rows(spark, lake)
    assert sorted(r.trade_id for r in rows.collect()) == [1, 2]
    assert "is_self_match" not in rows.columns


def test_each_feed_has_its_own_table(spark, lake):
    bar = {"symbol": "AAPL", "bar_open_ts": "2026-04-30T12:00:00Z", "timeframe": "1m", "open": 1.0,
           "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10, "vwap": 1.2, "trade_count": 3}
    write_lines(minute_folder(lake, "alpaca", "00"), "b.jsonl", [bar, {**bar, "volume": -1}])
    write_lines(minute_folder(lake, "replay", "00"), "r.jsonl", [trade(n) for n in range(20)])
    for feed in ("alpaca", "binance_replay"):
        run(start_ingest(spark, lake, feed))
    assert bronze_rows(spark, lake, "alpaca_bars").count() == 2
    assert bronze_rows(spark, lake, "binance_replay_trades").count() == 20
    bronze_to_silver(spark, lake["tables"], "bars", as_of="2026-05-01 00:00:00")
    assert tables.row_count(spark, f"{lake['tables']}/silver/bars") == 1
    (bad,) = tables.read_table(spark, f"{lake['tables']}/silver/quarantine_bars").collect()
    assert (bad._error_code, bad._replay_attempts) == ("BAR_VOLUME_NEGATIVE", 0)


def test_evolving_stream(spark, lake):
    write_lines(lake["landing"], "a.jsonl", [{**trade(1), "is_self_match": True}, "{broken"])
    stream = feeds.stream_evolving(spark, lake["landing"], TRADE_WIRE)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", lake["checkpoints"])
        .trigger(availableNow=True).start(lake["tables"])
    )
    run(query)
    rows = {r.trade_id: r for r in spark.read.parquet(lake["tables"]).collect()}
    assert rows[1]._rescued == {"is_self_match": "true"} and rows[None]._corrupt


class Killed(Exception):
    pass


def test_a_killed_batch_is_taken_up_once(spark, root, monkeypatch):
    """The driver dies while the files of a batch are moved into the table, and starts again."""
    batch = spark.createDataFrame(
        [(n, datetime(2026, 4, 30 - n % 3, 12)) for n in (1, 2, 2, 3, 4, 5)], "n int, _ingest_ts timestamp"
    ).withColumn("ingestion_date", F.to_date("_ingest_ts"))

    def dies(spark, staged, path):
        moved = sorted(Path(staged).rglob("part-*"))[0]
        target = Path(path) / moved.relative_to(staged)
        target.parent.mkdir(parents=True, exist_ok=True)
        moved.rename(target)
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(batches, "move_in", dies)
        with pytest.raises(Killed):
            batches.LedgerAppender(root, "ingestion_date").write(batch, 0)
    assert 0 < tables.row_count(spark, root) < 6
    restarted = batches.LedgerAppender(root, "ingestion_date")
    assert not restarted.write(batch, 0)  # what had begun is finished, and the batch is known
    assert sorted(r.n for r in tables.read_table(spark, root).collect()) == [1, 2, 2, 3, 4, 5]
    assert restarted.write(batch, 1) and not restarted.write(batch, 1)  # equal rows of a later batch are new rows
    assert tables.row_count(spark, root) == 12
    assert not any(Path(tables.staged_beside(root)).iterdir())
    assert restarted.ledger.entries(spark).filter("state = 'done'").count() == 2
    assert not restarted.write(batch.limit(0), 2) and tables.row_count(spark, root) == 12


def bar_stream(spark, folder):
    raw = feeds.stream_jsonl(spark, folder, TRADE_WIRE, 1).withColumn("_ingest_ts", F.col("event_time"))
    return silver_trades(raw)


def test_two_streams_and_a_kill_feed_one_table_of_bars(spark, lake, monkeypatch):
    rows = [trade(n, price=str(100 + n % 7), quantity="2", ts=f"2026-04-{29 + n % 2}T12:{n % 50:02d}:{n % 60:02d}Z") for n in range(120)]
    for n in range(6):
        write_lines(f"{lake['landing']}/{n % 2}", f"{n}.jsonl", rows[n * 20:n * 20 + 20])
    replace, calls = tables.replace_partitions, []

    def dies_once(*args, **named):
        calls.append(1)
        if len(calls) == 2:
            replace(*args, **named)  # the days are swapped, but the ledger does not hear of it
            raise Killed
        replace(*args, **named)

    with monkeypatch.context() as patch:
        patch.setattr(refine, "replace_partitions", dies_once)
        query = refine.merge_bars(bar_stream(spark, f"{lake['landing']}/0"), lake["tables"], lake["checkpoints"] + "-0", available_now=True)
        with pytest.raises(Exception, match="Killed"):
            query.awaitTermination(120)
    # The second stream begins at batch 0 too, and first finishes what the first one left open.
    for n in (1, 0, 1):
        run(refine.merge_bars(bar_stream(spark, f"{lake['landing']}/{n}"), lake["tables"], lake["checkpoints"] + f"-{n}", available_now=True))
    got = refine.merged_bars(spark, lake["tables"])
    batch = feeds.scan_jsonl(spark, lake["landing"], TRADE_WIRE).withColumn("_ingest_ts", F.col("event_time"))
    want = one_minute_bars(silver_trades(batch))
    columns = sorted(want.columns)
    assert got.agg(F.sum("trade_count")).first()[0] == 120
    assert got.select(*columns).exceptAll(want.select(*columns)).isEmpty() and got.count() == want.count()


def test_refine_splits_each_batch_once(spark, lake):
    for n in range(3):
        write_lines(minute_folder(lake, "binance", f"0{n}"), f"s-{n}.jsonl",
                    [trade(10 * n), trade(10 * n + 1, symbol="DEMOUSDT"), trade(10 * n + 2, price="0")])
    run(start_ingest(spark, lake, max_files_per_trigger=1))
    silver, bad = (f"{lake['tables']}/silver/{t}" for t in ("trades", "quarantine_trades"))

    def refine_once():
        stream = refine.stream_bronze(
            spark, table_path(lake["tables"], "bronze", "binance_trades"), StructType.fromDDL(BRONZE_DDL))
        run(refine.refine(stream, "trades", lake["tables"], f"{lake['checkpoints']}/silver",
                          available_now=True))

    refine_once()
    refine_once()
    assert sorted(r.trade_id for r in tables.read_table(spark, silver).collect()) == [
        "binance:0", "binance:10", "binance:20"]
    failed = tables.read_table(spark, bad).collect()
    assert len(failed) == 6
    assert {r._error_code for r in failed} == {"SYMBOL_UNKNOWN", "PRICE_NOT_POSITIVE"}
    assert {r._quarantined_ts for r in failed} == {max(r.ingest_ts for r in failed)}
    # A restart whose checkpoint is lost repeats every row, and the first batch is recognised.
    stream = refine.stream_bronze(
        spark, table_path(lake["tables"], "bronze", "binance_trades"), StructType.fromDDL(BRONZE_DDL))
    run(refine.refine(stream, "trades", lake["tables"], f"{lake['checkpoints']}/again",
                      available_now=True))
    assert tables.row_count(spark, silver) == 3


def test_streaming_dedup_of_polled_bars(spark, lake):
    bar = {"symbol": "AAPL", "bar_open_ts": "2026-04-30T12:00:00Z", "timeframe": "1m", "open": 1.0}
    write_lines(lake["landing"], "a.jsonl", [bar, bar, {**bar, "symbol": "SPY"}])
    write_lines(lake["landing"], "b.jsonl", [bar, {**bar, "bar_open_ts": "2026-04-30T12:01:00Z"}])
    stream = refine.dedup_bars(feeds.stream_jsonl(spark, lake["landing"], BAR_WIRE, 1))
    run(stream.writeStream.format("parquet").option("checkpointLocation", lake["checkpoints"])
        .trigger(availableNow=True).start(lake["tables"]))
    assert spark.read.parquet(lake["tables"]).count() == 3


def test_rolling_bars_equal_batch_bars(spark, lake):
    records = [
        trade(n, price=str(100 + n % 7), quantity="2", ts=f"2026-04-30T12:{n // 10:02d}:{n % 10 * 5:02d}Z")
        for n in range(100)
    ]
    closing = trade(999, ts="2026-04-30T13:00:00Z")
    write_lines(lake["landing"], "a.jsonl", records)
    write_lines(lake["landing"], "b.jsonl", [closing])
    write_lines(lake["landing"], "c.jsonl", [trade(1000, ts="2026-04-30T13:00:01Z")])
    raw = feeds.stream_jsonl(spark, lake["landing"], TRADE_WIRE, 1).withColumn("_ingest_ts", F.col("event_time"))
    run(refine.rolling_bars(silver_trades(raw)).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", lake["checkpoints"]).trigger(availableNow=True).start(lake["tables"]))
    got = spark.read.parquet(lake["tables"])
    batch = feeds.scan_jsonl(spark, lake["landing"], TRADE_WIRE).withColumn("_ingest_ts", F.col("event_time"))
    want = one_minute_bars(silver_trades(batch)).filter("bar_open_ts < TIMESTAMP'2026-04-30 13:00:00'")
    cols = sorted(want.columns)
    assert got.count() == 10
    assert got.select(*cols).exceptAll(want.select(*cols)).isEmpty()


def test_merged_bars_survive_late_files_and_repeated_batches(spark, lake):
    late = trade(1, price="90", quantity="2", ts="2026-04-30T12:00:01Z")
    for n, rows in enumerate([[trade(2, price="100", quantity="2", ts="2026-04-30T12:00:02Z"),
                               trade(3, price="101", quantity="2", ts="2026-04-30T15:00:00Z")],
                              [late], [trade(4, price="95", quantity="2", ts="2026-04-30T12:00:59Z")]]):
        write_lines(lake["landing"], f"{n}.jsonl", rows)
    raw = feeds.stream_jsonl(spark, lake["landing"], TRADE_WIRE, 1).withColumn("_ingest_ts", F.col("event_time"))
    run(refine.merge_bars(silver_trades(raw), lake["tables"], lake["checkpoints"], available_now=True))
    bars = {r.bar_open_ts.hour: r for r in refine.merged_bars(spark, lake["tables"]).collect()}
    assert (bars[12].open, bars[12].close, bars[12].trade_count) == (90, 95, 3) and bars[15].trade_count == 1
    # A checkpoint that was lost after the write: the same batches, with the same numbers, come again.
    raw = feeds.stream_jsonl(spark, lake["landing"], TRADE_WIRE, 1).withColumn("_ingest_ts", F.col("event_time"))
    run(refine.merge_bars(silver_trades(raw), lake["tables"], lake["checkpoints"] + "-2", available_now=True))
    again = {r.bar_open_ts.hour: r.trade_count for r in refine.merged_bars(spark, lake["tables"]).collect()}
    assert again == {12: 3, 15: 1}


def test_types_of_new_fields_are_learnt_and_widened(spark, lake):
    feed, parts = feeds.FEEDS["binance"], [
        [{**trade(1), "lot": 7, "deep": {"a": [1]}, "Symbol": "x", "odd name": 1, "none": None}, "{broken", "42"],
        [{**trade(2), "lot": 8, "none": True}],
        [{**trade(3), "lot": 2.5, "none": False}],
        [{**trade(4), "lot": "many", "none": None}],
        [{**trade(5), "lot": 9}],
    ]
    for n, rows in enumerate(parts):
        write_lines(minute_folder(lake, "binance", f"0{n}"), f"{n}.jsonl", rows)
        run(start_ingest(spark, lake, inferred=True))
    run(start_ingest(spark, lake, inferred=True))
    assert inference.known_types(spark, lake["tables"], feed) == {
        "deep": ["STRING"], "lot": ["BIGINT", "DOUBLE", "STRING"], "none": ["BOOLEAN"]}
    rows = {r.trade_id: r for r in inference.read_inferred(spark, lake["tables"], feed).collect()}
    assert {n: rows[n].lot for n in range(1, 6)} == {1: "7", 2: "8", 3: "2.5", 4: "many", 5: "9"}
    assert (rows[1].deep, rows[2].none, rows[3].none, rows[4].none) == ('{"a":[1]}', True, False, None)
    assert json.loads(rows[1]._rescued)["odd name"] == "1" and rows[1].symbol == "BTCUSDT"
    stored = bronze_rows(spark, lake)
    assert stored.count() == 7 and {"lot", "lot__double", "lot__string"} <= set(stored.columns)
    assert stored.schema["lot"].dataType.simpleString() == "bigint"  # files keep the type they were written with
    assert inference.wider("BOOLEAN", "BIGINT") == "STRING" and inference.column_type("DECIMAL(20,0)") == "STRING"


def test_merged_variance_keeps_its_digits(spark):
    """Prices whose spread is tiny beside their size, in parts of many sizes and without any price."""
    rows = [(f"2026-05-01 12:{n % 60:02d}:00", "A", "crypto", None if n % 50 == 0 else 1e9 + n % 7 * 1e-3, n % 90 or None) for n in range(400)]
    rows += [("2026-05-01 13:00:00", "A", "crypto", 5.0, None), ("2026-05-01 14:00:00", "B", "crypto", None, None)]
    trades = spark.createDataFrame(rows, "t string, symbol string, asset_class string, price double, late_arrival_sec int")
    trades = trades.withColumn("event_ts", F.col("t").cast("timestamp"))
    state = None
    for part, share in enumerate((0, 1, 2, 3)):
        fresh = quality_parts(trades.filter(F.pmod(F.xxhash64(*trades.columns), F.lit(4)) == share))
        state = tables.stage(spark, fresh if part == 0 else merged_parts(state.unionByName(fresh)), "state")
    bad = quality_parts(trades.filter("symbol = 'A'").limit(3), clean=False)
    got = {(r.metric_hour.hour, r.symbol): r for r in finished_quality(merged_parts(state.unionByName(bad))).collect()}
    for want in market_quality(trades).collect():
        mine = got.pop((want.metric_hour.hour, want.symbol))
        assert mine.trade_count == want.trade_count and mine.late_arrival_pct == want.late_arrival_pct
        assert (mine.price_max, mine.price_min) == (want.price_max, want.price_min)
        if want.price_volatility is None:
            assert mine.price_volatility is None
        else:
            assert mine.price_volatility == pytest.approx(want.price_volatility, rel=1e-4)  # sums of squares would lose all digits
    assert not got


def test_a_batch_without_times_is_not_lost(spark, lake):
    write_lines(minute_folder(lake, "binance", "00"), "s.jsonl", [trade(1)])
    run(start_ingest(spark, lake))
    path = table_path(lake["tables"], "bronze", "binance_trades")
    blank = {name: F.lit(None).cast("timestamp") for name in ("_ingest_ts", "event_time", "trade_time")}
    bare = tables.stage(spark, bronze_rows(spark, lake).withColumns(blank), "bare")
    bare.write.parquet(path + "-bare")
    stream = refine.stream_bronze(spark, path + "-bare", bare.schema)
    run(refine.refine(stream, "trades", lake["tables"], f"{lake['checkpoints']}/s", available_now=True))
    assert tables.row_count(spark, f"{lake['tables']}/silver/quarantine_trades") == 1
