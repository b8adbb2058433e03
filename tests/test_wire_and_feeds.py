import json
from datetime import datetime

from helpers import trade, write_lines
from pyspark.sql import functions as F

from strata.operators.wire import (
    first_per_key,
    flatten_bars,
    landing_bars,
    landing_trades,
    last_per_key,
    poll_window,
    unwrap_trades,
)
from strata.schemas import BAR_WIRE, TRADE_WIRE
from strata.sources import feeds, landing
from strata.sources.generate import bar_records, benchmark_trades, trade_records


def lines(spark, *rows):
    text = [row if isinstance(row, str) else json.dumps(row) for row in rows]
    return spark.createDataFrame([(t,) for t in text], "value string")


WIRE = {"e": "trade", "E": 1714000000000, "s": "BTCUSDT", "t": 1, "p": "1", "q": "2",
        "T": 1714000000123, "m": True}


def test_trade_messages(spark):
    df = lines(
        spark, WIRE, {"stream": "x", "data": {**WIRE, "t": 2}}, {"data": {**WIRE, "e": "aggTrade"}},
        {"data": None, "e": "trade"}, {"data": [1], "e": "trade"}, "not json",
        {"e": "trade", "t": 3, "event_time": "2024-04-24T23:06:40Z", "is_self_match": True},
    )
    rows = {r.trade_id: r for r in landing_trades(unwrap_trades(df)).collect()}
    assert sorted(rows) == [1, 2, 3]
    one = rows[1]
    assert (one.event_type, one.symbol, one.price, one.quantity) == ("trade", "BTCUSDT", "1", "2")
    assert one.event_time == datetime(2024, 4, 24, 23, 6, 40)
    assert one.trade_time == datetime(2024, 4, 24, 23, 6, 40, 123000)
    assert one.buyer_is_maker is True and one._extra == {}
    assert rows[3]._extra == {"is_self_match": "true"}
    assert rows[3].event_time == one.event_time and rows[3].symbol is None


def test_bar_replies(spark):
    bar = {"t": "2026-04-30T14:30:00Z", "o": 175.0, "h": 176, "l": 174, "c": 175.5, "v": 10, "vw": 175.2,
           "n": 4, "S": "WRONG", "experimental": 42}
    df = lines(spark, {"bars": {"AAPL": [bar, {**bar, "t": "2026-04-30T14:31:00Z"}], "MSFT": [bar]}},
               {"bars": {}}, {"other": 1}, "broken")
    rows = landing_bars(flatten_bars(df)).orderBy("symbol", "bar_open_ts").collect()
    assert [r.symbol for r in rows] == ["AAPL", "AAPL", "MSFT"]
    first = rows[0]
    assert first.bar_open_ts == datetime(2026, 4, 30, 14, 30) and first.timeframe == "1Min"
    assert (first.open, first.high, first.volume, first.vwap, first.trade_count) == (175.0, 176.0, 10, 175.2, 4)
    assert first._extra == {"experimental": "42"}


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), (None, 5, "n")],
                               "k string, at int, v string")
    assert {(r.k, r.at, r.v) for r in first_per_key(df, ("k",), ("at",)).collect()} == {
        ("a", 1, "y"), (None, 5, "n")}
    assert {(r.k, r.at, r.v) for r in last_per_key(df, ("k",), ("at",)).collect()} == {
        ("a", 2, "x"), (None, 5, "n")}


def test_poll_window(spark):
    df = spark.range(6).selectExpr("TIMESTAMP'2026-04-30 12:00:00' + make_dt_interval(0,0,id) AS bar_open_ts")
    kept = poll_window(df, F.lit("2026-04-30 12:03:30").cast("timestamp"))
    assert [r.bar_open_ts.minute for r in kept.orderBy("bar_open_ts").collect()] == [2, 3]


def test_scan_skips_unfinished_files_and_keeps_malformed_lines(spark, tmp_path):
    folder = tmp_path / "binance" / "2026-04-30" / "12" / "00"
    write_lines(folder, "a.jsonl", [trade(1), "{broken", {**trade(2), "is_self_match": True}])
    write_lines(folder, ".tmp.b.jsonl", [trade(3)])
    df = feeds.scan_jsonl(spark, str(tmp_path), TRADE_WIRE)
    assert sorted((r.trade_id for r in df.collect()), key=str) == [1, 2, None]
    assert "is_self_match" not in df.columns
    assert "is_self_match" in feeds.scan_jsonl(spark, str(tmp_path)).columns


def test_annotation(spark, tmp_path):
    write_lines(tmp_path / "in", "a.jsonl", [trade(42)])
    row = feeds.annotate(feeds.scan_jsonl(spark, str(tmp_path / "in"), TRADE_WIRE), "binance").first()
    assert row._source == "binance" and row._file_path.endswith("a.jsonl")
    assert json.loads(row._raw_json)["price"] == "64000.00"
    assert row.ingestion_date == row._ingest_ts.date()


def test_evolving_scan_loses_nothing(spark, tmp_path):
    write_lines(tmp_path / "in", "a.jsonl",
                [trade(1), {**trade(2), "is_self_match": True, "note": {"a": 1}}, "{broken"])
    df = feeds.scan_evolving(spark, str(tmp_path / "in"), TRADE_WIRE)
    rows = {r.trade_id: r for r in df.collect()}
    assert rows[1]._rescued == {} and not rows[1]._corrupt
    assert rows[2]._rescued == {"is_self_match": "true", "note": '{"a":1}'}
    assert rows[None]._raw == "{broken" and rows[None]._corrupt
    assert rows[2].trade_time == datetime(2026, 4, 30, 12)
    found = {r.field: r.n_rows for r in feeds.rescued_fields(df).collect()}
    assert found == {"is_self_match": 1, "note": 1}
    recovered = df.select("trade_id", feeds.raw_field("is_self_match", "boolean").alias("m"))
    assert {r.trade_id: r.m for r in recovered.collect()} == {1: None, 2: True, None: None}
    assert feeds.scan_evolving(spark, str(tmp_path / "in"), BAR_WIRE).count() == 3
    assert "is_self_match: BOOLEAN" in feeds.observed_schema(df).first().observed_schema
    wider = feeds.promoted(TRADE_WIRE, {"is_self_match": "BOOLEAN"})
    again = {r.trade_id: r for r in feeds.scan_evolving(spark, str(tmp_path / "in"), wider).collect()}
    assert again[2].is_self_match is True and again[2]._rescued == {"note": '{"a":1}'}


def test_replay_writes_in_time_order(spark, tmp_path):
    history = trade_records(spark, 5000, "2026-04-30 12:00:00").repartition(7)
    folder = landing.write_landing(history, str(tmp_path), datetime(2026, 5, 1, 9, 5))
    assert folder.endswith("/2026-05-01/09/05")
    files = sorted(p for p in (tmp_path / "2026-05-01/09/05").iterdir() if p.name.startswith("part"))
    seen = []
    for file in files:
        rows = [json.loads(t) for t in file.read_text().splitlines()]
        assert len(rows) <= landing.RECORDS_PER_FILE
        seen += [r["event_time"] for r in rows]
    assert len(seen) == 5000 and seen == sorted(seen)
    again = landing.write_landing(history, str(tmp_path), datetime(2026, 5, 1, 9, 5))
    assert feeds.scan_jsonl(spark, again, TRADE_WIRE).count() == 5000


def test_one_timestamp_for_all_rows_is_still_spread(spark):
    same = spark.range(20000).selectExpr("TIMESTAMP'2026-01-01' AS event_time", "id")
    ordered = landing.in_time_order(same)
    sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 20000
    assert ordered.rdd.getNumPartitions() == 1 or max(r["count"] for r in sizes) < 20000


def test_files_rotate_by_count_and_age(spark, tmp_path):
    import random

    rnd = random.Random(9)
    times = [rnd.choice((0, 0, 5_000, rnd.randint(0, 180_000))) for _ in range(900)] + [59_999, 60_000]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(times)], "n int, ms bigint").selectExpr(
        "n", "timestamp_millis(1700000000000 - pmod(1700000000000, 60000) + ms) AS event_time")
    rows = rows.unionByName(spark.createDataFrame([(-1, None), (-2, None)], "n int, event_time timestamp")).repartition(5)
    want, held, opened, at, minute = {}, 0, None, -1, None
    for ms in sorted(times):
        if ms // 60_000 != minute:
            minute, at, held, opened = ms // 60_000, 0, 0, ms
        elif held >= 50 or ms - opened >= 10_000:
            at, held, opened = at + 1, 0, ms
        held += 1
        want[minute, at, ms] = want.get((minute, at, ms), 0) + 1
    got = {}
    out = landing.rotated(rows, records_per_file=50)
    assert out.columns == ["n", "event_time", "landing_minute", "landing_file"]
    for r in out.filter("event_time IS NOT NULL").collect():
        base = 1700000000000 - 1700000000000 % 60000
        ms = round(r.event_time.timestamp() * 1000) - base
        key = (round(r.landing_minute.timestamp() * 1000) - base) // 60_000, r.landing_file, ms
        got[key] = got.get(key, 0) + 1
    assert got == want and out.count() == len(times) + 2
    landing.write_rotated(rows.drop("ms"), str(tmp_path / "r"), records_per_file=50)
    files = list((tmp_path / "r").rglob("part-*.json"))
    assert len(files) == len({k[:2] for k in want}) + 1
    assert sum(1 for f in files for _ in f.open()) == len(times) + 2
    assert landing.rotated(rows.limit(0)).count() == 0


def test_schedule(spark):
    df = spark.range(3).selectExpr("timestamp_seconds(id * 10) AS event_time")
    assert sorted(r.emit_after_sec for r in landing.replay_schedule(df, speedup=2.0).collect()) == [0, 5, 10]
    assert {r.emit_after_sec for r in landing.replay_schedule(df, speedup=0).collect()} == {0.0}


def test_generators(spark):
    trades = trade_records(spark, 50, "2026-04-30 12:00:00")
    assert trades.count() == 50 and trades.exceptAll(trade_records(spark, 50, "2026-04-30 12:00:00")).isEmpty()
    assert trades.agg(F.max("event_time")).first()[0] == datetime(2026, 4, 30, 12)
    bars = bar_records(spark, "2026-04-30 12:00:00")
    rows = bars.orderBy("bar_open_ts").collect()
    assert [r.volume >= 0 for r in rows] == [True] * 5 + [False]
    assert all(r.low <= min(r.open, r.close) and r.high >= max(r.open, r.close) for r in rows)
    table = benchmark_trades(spark, 1000, "2026-04-30 12:00:00")
    assert table.select("symbol").distinct().count() == 8
    assert table.filter("event_date <> to_date(event_ts)").isEmpty()
    assert table.filter("unix_seconds(ingest_ts) - unix_seconds(event_ts) <> late_arrival_sec").isEmpty()
    assert table.groupBy("symbol").count().agg(F.max("count")).first()[0] > 300
