from datetime import date, datetime
from pathlib import Path

from helpers import AS_OF, bronze, multiset, trade
from pyspark.sql import functions as F

from strata.operators.quality import FAILURES_COL, QualityGate, Rule
from strata.operators.quarantine import Replay, with_metadata
from strata.operators.rules import trade_gate
from strata.plans import jobs
from strata.schemas import FAILURES, table
from strata.sources import consumed, tables

PRICE = QualityGate([Rule("R1", "PRICE_NOT_POSITIVE", "error", "price > 0", "price > 0")])
SCHEMA = f"id int, price double, _replay_attempts int, {FAILURES_COL} {FAILURES}"
OLD = [("OLD", "old", "error")]


def test_replay_fixture(spark):
    df = spark.createDataFrame([(1, 100.0, 0, OLD), (2, -1.0, 0, OLD), (3, 50.0, 3, OLD)], SCHEMA)
    run = Replay(df, PRICE)
    assert [r.id for r in run.promoted().collect()] == [1]
    assert run.promoted().columns == ["id", "price"]
    (failing,) = run.still_failing().collect()
    assert (failing.id, failing._replay_attempts) == (2, 1)
    assert failing[FAILURES_COL][0].error_code == "PRICE_NOT_POSITIVE"
    assert [r.id for r in run.archive().collect()] == [3]
    assert [r.id for r in run.remaining().collect()] == [2]
    assert run.metrics().first().asDict() == {
        "eligible": 2, "promoted": 1, "still_failing": 1, "archived": 1, "waiting": 0}


def test_every_row_has_one_outcome(spark):
    df = spark.createDataFrame(
        [(n, 1.0 if n % 2 else -1.0, n % 5 if n % 7 else None, OLD) for n in range(70)], SCHEMA
    ).withColumn("_quarantined_ts", F.expr("TIMESTAMP'2026-04-30' - make_dt_interval(0, id)"))
    run = Replay(df, PRICE, as_of="2026-04-30 00:00:00", window_hours=24)
    parts = [run.promoted(), run.remaining(), run.archive()]
    assert sorted(r.id for part in parts for r in part.collect()) == list(range(70))
    assert run.rows.filter("_outcome IS NULL").isEmpty()
    waiting = run.rows.filter("_outcome = 'waiting'")
    assert waiting.filter("id <= 24 AND _replay_attempts < 3").isEmpty()


def test_metadata(spark):
    failed = trade_gate(AS_OF).quarantined(
        jobs.silver_trades(bronze(spark, [trade(1, symbol="DEMOUSDT", quantity="0")])))
    row = with_metadata(failed, AS_OF).first()
    assert (row._error_code, row._error_msg, row._replay_attempts) == (
        "QUANTITY_NOT_POSITIVE", "quantity > 0", 0)
    assert row.quarantined_date == date(2026, 5, 1) and row._raw_json
    assert with_metadata(failed.drop("_raw_json"), AS_OF).schema["_raw_json"].dataType.simpleString() == "string"


def put_bronze(spark, root, rows, ingest="2026-04-30 12:00:30"):
    tables.append(bronze(spark, rows, ingest), f"{root}/bronze/binance_trades", "ingestion_date")


def read(spark, root, name):
    return tables.read_table(spark, f"{root}/{name}")


ROWS = [
    trade(1), trade(1), trade(2, price="64010.00", ts="2026-04-30T12:00:20Z"),
    trade(3, symbol="ETHUSDT", price="3000", ts="2026-04-30T13:00:00Z"),
    trade(4, symbol="DEMOUSDT"), trade(5, quantity="0"), trade(None, price="oops"),
]


def test_silver_job_can_be_repeated(spark, root):
    put_bronze(spark, root, ROWS)
    for _ in range(2):
        jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    silver, bad = read(spark, root, "silver/trades"), read(spark, root, "silver/quarantine_trades")
    assert sorted(r.trade_id for r in silver.collect()) == ["binance:1", "binance:2", "binance:3"]
    assert bad.count() == 3
    assert sorted(silver.columns) == sorted(table("silver", "trades").schema.names)
    put_bronze(spark, root, [trade(9, ts="2026-05-01T00:00:00Z")], "2026-05-01 00:00:10")
    mark = tables.high_watermark(read(spark, root, "bronze/binance_trades").filter("trade_id < 9")).first()[0]
    jobs.bronze_to_silver(spark, root, "trades", as_of="2026-05-01 01:00:00", last_ingest_ts=mark, level=None)
    assert read(spark, root, "silver/trades").count() == 4
    assert read(spark, root, "silver/quarantine_trades").count() == 3


def test_plain_append_keeps_repeated_trades(spark, root):
    put_bronze(spark, root, ROWS)
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF, level=None, unique=False)
    got = sorted(r.trade_id for r in read(spark, root, "silver/trades").collect())
    assert got == ["binance:1", "binance:1", "binance:2", "binance:3"]


def test_whole_pipeline(spark, root):
    put_bronze(spark, root, ROWS)
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    for _ in range(2):
        jobs.trades_to_silver_bars(spark, root)
        for width in ("1m", "5m", "1h", "1d"):
            jobs.silver_to_gold_bars(spark, root, width, as_of=AS_OF)
        jobs.trades_to_daily_volume(spark, root)
        jobs.trades_to_market_quality(spark, root)
    assert read(spark, root, "silver/bars").count() == 2
    for width, n in (("1m", 2), ("5m", 2), ("1h", 2), ("1d", 2)):
        bars = read(spark, root, f"gold/bars_{width}")
        assert bars.count() == n and {r.timeframe for r in bars.collect()} == {width}
    btc = read(spark, root, "gold/bars_1d").filter("symbol = 'BTCUSDT'").first()
    assert (btc.open, btc.close, btc.trade_count) == (64000, 64010, 2)
    daily = {r.symbol: r.trade_count for r in read(spark, root, "gold/daily_volume_profile").collect()}
    assert daily == {"BTCUSDT": 2, "ETHUSDT": 1}
    quality = {r.symbol: r for r in read(spark, root, "gold/market_quality").collect()}
    assert quality["BTCUSDT"].quarantine_pct > 0 and quality["BTCUSDT"].metric_date == date(2026, 4, 30)
    assert tables.row_count(spark, f"{root}/gold/quarantine_bars") == 0


def test_other_sources_survive_a_bar_rebuild(spark, root):
    put_bronze(spark, root, [trade(1)])
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    jobs.trades_to_silver_bars(spark, root)
    feed_bar = read(spark, root, "silver/bars").withColumns(
        {"source": F.lit("alpaca"), "symbol": F.lit("AAPL")})
    tables.append(feed_bar.select(*table("silver", "bars").schema.names), f"{root}/silver/bars", "event_date")
    jobs.trades_to_silver_bars(spark, root)
    assert {r.source for r in read(spark, root, "silver/bars").collect()} == {"alpaca", "trade_rollup"}
    assert read(spark, root, "silver/bars").count() == 2


def test_replay_job(spark, root):
    put_bronze(spark, root, [trade(9001, symbol="DEMOUSDT"), trade(9002, quantity="0")])
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    assert tables.row_count(spark, f"{root}/silver/trades") == 0
    relaxed = trade_gate(AS_OF).without("SYMBOL_UNKNOWN")
    first = jobs.replay_quarantine(spark, root, gate=relaxed, as_of=AS_OF)
    assert first == {"eligible": 2, "promoted": 1, "still_failing": 1, "archived": 0, "waiting": 0}
    assert [r.trade_id for r in read(spark, root, "silver/trades").collect()] == ["binance:9001"]
    (left,) = read(spark, root, "silver/quarantine_trades").collect()
    assert (left.trade_id, left._replay_attempts) == ("binance:9002", 1)
    jobs.replay_quarantine(spark, root, gate=relaxed, as_of=AS_OF)
    last = jobs.replay_quarantine(spark, root, gate=relaxed, as_of=AS_OF)
    assert last["archived"] == 1
    assert tables.row_count(spark, f"{root}/silver/quarantine_trades") == 0
    (gone,) = read(spark, root, "silver/quarantine_trades_exhausted").collect()
    assert (gone.trade_id, gone._replay_attempts) == ("binance:9002", 3)


def test_historic_bars_keep_their_source(spark, root):
    rows = spark.createDataFrame(
        [("AAPL", datetime(2026, 4, 29), "1d", 1.0, 2.0, 0.5, 1.5, 1.4, 10)],
        "symbol string, bar_open_ts timestamp, timeframe string, open double, high double, low double, "
        "close double, adj_close double, volume bigint",
    ).withColumns({"_ingest_ts": F.lit("2026-04-30 00:00:00").cast("timestamp"),
                   "ingestion_date": F.lit(date(2026, 4, 30))})
    tables.append(rows, f"{root}/bronze/yfinance_history", "ingestion_date")
    jobs.bronze_to_silver(spark, root, "bars", AS_OF, bronze_table="yfinance_history")
    (bar,) = read(spark, root, "silver/bars").collect()
    assert (bar.source, bar.asset_class, bar.timeframe, bar.vwap) == ("yfinance", "stock", "1d", None)


def test_quarantine_retention_and_replay_archive_are_apart(spark, root):
    put_bronze(spark, root, [trade(1, symbol="DEMOUSDT")])
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    for _ in range(3):
        jobs.replay_quarantine(spark, root, as_of=AS_OF)
    put_bronze(spark, root, [trade(2, symbol="DEMOUSDT")])
    jobs.bronze_to_silver(spark, root, "trades", as_of="2026-05-02 00:00:00")
    assert jobs.enforce_retention(spark, root, "2026-07-01", "silver", "quarantine_trades") == 1
    # The first trade was archived by the replays and does not enter the quarantine again.
    assert read(spark, root, "silver/quarantine_trades_archive").count() == 1
    assert read(spark, root, "silver/quarantine_trades_exhausted").count() == 1


def test_maintenance_jobs(spark, root):
    put_bronze(spark, root, [trade(n, ts=f"2026-04-{10 + n:02d}T12:00:00Z") for n in range(20)])
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    before = multiset(read(spark, root, "silver/trades"))
    jobs.optimize_hot(spark, root, "2026-04-30")
    jobs.optimize_all(spark, root)
    assert multiset(read(spark, root, "silver/trades")) == before
    assert jobs.enforce_retention(spark, root, datetime(2027, 4, 20)) == 10
    assert read(spark, root, "silver/trades").count() == 10
    assert read(spark, root, "silver/trades_archive").count() == 10
    assert jobs.enforce_retention(spark, root, "2030-01-01", "gold", "bars_1m") == 0
    log = read(spark, root, "gold/maintenance_metrics").collect()
    assert [r.value for r in log if r.metric == "partitions_dropped"] == [10]
    assert {r.operation for r in log} == {"cluster", "expire"}


def test_reruns_at_another_time_add_nothing(spark, root):
    put_bronze(spark, root, ROWS)
    for clock in ("2026-05-01 00:00:00", "2026-05-02 00:00:00", None):
        jobs.bronze_to_silver(spark, root, "trades", as_of=clock)
    assert read(spark, root, "silver/trades").count() == 3
    assert read(spark, root, "silver/quarantine_trades").count() == 3
    # Neither do rows that were promoted or archived in the meantime.
    relaxed = trade_gate(AS_OF).without("SYMBOL_UNKNOWN")
    for _ in range(3):
        jobs.replay_quarantine(spark, root, gate=relaxed, as_of=AS_OF)
    jobs.bronze_to_silver(spark, root, "trades", as_of="2026-05-03 00:00:00")
    assert tables.row_count(spark, f"{root}/silver/trades") == 4
    assert tables.row_count(spark, f"{root}/silver/quarantine_trades") == 0
    assert tables.row_count(spark, f"{root}/silver/quarantine_trades_exhausted") == 2


def test_replay_without_a_clock_conserves_rows(spark, root):
    """The limit of the clock rule lies among the rows, and the clock moves between the steps of a job."""
    soon = [F.expr(f"current_timestamp() + make_dt_interval(0, 0, 0, 60 + {n} * 0.05)") for n in range(200)]
    frame = bronze(spark, [trade(n) for n in range(200)])
    stamps = spark.range(1).select(*(s.alias(f"s{n}") for n, s in enumerate(soon))).first()
    by_id = spark.createDataFrame([(n, stamps[n]) for n in range(200)], "trade_id bigint, at timestamp")
    late = frame.join(by_id, "trade_id").withColumns({"event_time": F.col("at"), "trade_time": F.col("at")}).drop("at")
    tables.append(late.select(*frame.columns), f"{root}/bronze/binance_trades", "ingestion_date")
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    jobs.replay_quarantine(spark, root)
    count = lambda name: tables.row_count(spark, f"{root}/silver/{name}")
    assert count("trades") + count("quarantine_trades") + count("quarantine_trades_exhausted") == 200


def put_bars(spark, root, rows):
    bars = spark.createDataFrame(
        [("AAPL", datetime(2026, 4, 30, 12, m), w, 1.0, 2.0, 0.5, 1.5, v, 1.2, 3) for m, w, v in rows],
        "symbol string, bar_open_ts timestamp, timeframe string, open double, high double, low double, "
        "close double, volume bigint, vwap double, trade_count bigint",
    ).withColumns({"_ingest_ts": F.lit("2026-04-30 13:00:00").cast("timestamp"),
                   "ingestion_date": F.lit(date(2026, 4, 30))})
    tables.append(bars, f"{root}/bronze/alpaca_bars", "ingestion_date")


def test_two_spellings_are_one_bar(spark, root):
    put_bars(spark, root, [(0, "1m", 10), (0, "1Min", 10), (1, "1Min", 5)])
    jobs.bronze_to_silver(spark, root, "bars", as_of=AS_OF)
    jobs.silver_to_gold_bars(spark, root, ("1m", "5m"), as_of=AS_OF)
    assert read(spark, root, "silver/bars").count() == 2
    assert [r.volume for r in read(spark, root, "gold/bars_5m").collect()] == [15]


def test_gold_quarantine_is_rebuilt_and_replayed_by_width(spark, root):
    put_bars(spark, root, [(0, "1m", 10), (7, "1m", 5)])
    jobs.bronze_to_silver(spark, root, "bars", as_of=AS_OF)
    silver = read(spark, root, "silver/bars")
    broken = silver.withColumn("close", F.when(F.minute("bar_open_ts") == 7, F.lit(9).cast("decimal(38,18)")).otherwise(F.col("close")))
    broken = tables.stage(spark, broken, "broken")
    tables.overwrite(broken.select(*table("silver", "bars").schema.names), f"{root}/silver/bars", "event_date")
    for clock in (AS_OF, "2026-05-02 00:00:00"):
        jobs.silver_to_gold_bars(spark, root, ("5m", "1h"), as_of=clock)
    entries = read(spark, root, "gold/quarantine_bars").collect()
    assert sorted(r.timeframe for r in entries) == ["1h", "5m"]
    jobs.replay_quarantine(spark, root, layer="gold", kind="bars", gate=QualityGate([]), as_of=AS_OF)
    assert read(spark, root, "gold/bars_5m").count() == 2 and read(spark, root, "gold/bars_1h").count() == 1
    assert tables.row_count(spark, f"{root}/gold/bars_1m") == 0
    assert tables.row_count(spark, f"{root}/gold/quarantine_bars") == 0


def test_a_condition_on_part_of_a_day_rebuilds_the_day(spark, root):
    put_bronze(spark, root, ROWS)
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    jobs.trades_to_silver_bars(spark, root)
    jobs.trades_to_silver_bars(spark, root, F.col("event_ts") >= "2026-04-30 13:00:00")
    assert read(spark, root, "silver/bars").count() == 2
    jobs.trades_to_daily_volume(spark, root, F.col("symbol") == "ETHUSDT")
    assert read(spark, root, "gold/daily_volume_profile").count() == 2


def test_rows_without_a_key_stay_apart_and_are_added_once(spark, root):
    rows = spark.createDataFrame([(None, n, date(2026, 4, 30)) for n in range(5)] + [(1, 9, date(2026, 4, 30))],
                                 "id int, at int, day date")
    for _ in range(2):
        tables.insert_new(spark, rows, root, "day", ("id",), ("at",))
    assert tables.row_count(spark, root) == 6


def test_trade_order_is_total_for_all_64_bit_numbers(spark):
    from strata.functions.market import trade_order

    top = 2**63 - 1
    ids = [(f"x:{n}", t) for t in (1, 2) for n in (-top - 1, -1, 0, top)] + [("text", 3), ("other", 4)]
    rows = spark.createDataFrame(ids, "trade_id string, us bigint").selectExpr("trade_id", "us", "timestamp_micros(us) AS event_ts")
    got = rows.select("trade_id", "us", trade_order().alias("o")).orderBy("o").collect()
    assert [(r.trade_id, r.us) for r in got] == ids


def test_a_resumed_run_reads_what_is_new(spark, root):
    put_bronze(spark, root, ROWS)
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF, resume=True)
    put_bronze(spark, root, [trade(9, ts="2026-05-01T00:00:00Z")], "2026-05-01 00:00:10")
    jobs.bronze_to_silver(spark, root, "trades", as_of="2026-05-01 01:00:00", resume=True)
    jobs.bronze_to_silver(spark, root, "trades", as_of="2026-05-01 02:00:00", resume=True)
    assert read(spark, root, "silver/trades").count() == 4
    assert read(spark, root, "silver/quarantine_trades").count() == 3
    log = read(spark, root, "gold/maintenance_metrics").filter("operation = 'silver_resume'")
    assert sum(r.value for r in log.collect()) == read(spark, root, "gold/consumed_files").count()


def test_gold_is_refreshed_by_changed_days(spark, root):
    def files(name, day=""):
        folder = Path(root, "gold", name)
        return sorted(str(f) for f in folder.rglob("*.parquet") if day in str(f))

    def land(rows, at):
        put_bronze(spark, root, rows, at)
        jobs.bronze_to_silver(spark, root, "trades", as_of="2026-06-01 00:00:00", resume=True)
        return jobs.refresh_gold(spark, root, "2026-06-01 00:00:00")

    days = [trade(n, price=str(100 + n), ts=f"2026-05-0{1 + n % 3}T12:00:{n:02d}Z") for n in range(9)]
    assert set(land(days, "2026-05-04 00:00:00").values()) == {3}
    assert set(jobs.refresh_gold(spark, root, "2026-06-01 00:00:00").values()) == {0}
    before = {name: files(name) for name in ("bars_1d", "daily_volume_profile", "market_quality")}
    # A late trade of the second day, a new day, and a failed trade of the third.
    done = land([trade(20, price="7", ts="2026-05-02T23:00:00Z"), trade(21, ts="2026-05-05T01:00:00Z"),
                 trade(22, quantity="0", ts="2026-05-03T12:30:00Z")], "2026-05-06 00:00:00")
    assert done == {"silver_bars": 2, "daily_volume": 2, "market_quality": 3, "gold_bars": 2}
    for name, old in before.items():
        kept = [f for f in old if "2026-05-01" in f]
        assert kept and files(name, "2026-05-01") == kept, name  # the first day was not written again
    again = {name: multiset(read(spark, root, f"gold/{name}")) for name in before}
    jobs.trades_to_silver_bars(spark, root)
    jobs.silver_to_gold_bars(spark, root, "1d", as_of=AS_OF)
    jobs.trades_to_daily_volume(spark, root)
    jobs.trades_to_market_quality(spark, root)
    assert {name: multiset(read(spark, root, f"gold/{name}")) for name in before} == again
    quality = read(spark, root, "gold/market_quality").filter("metric_date = DATE'2026-05-03'").first()
    assert quality.quarantine_pct > 0


def test_replay_counts_while_it_writes(spark, root):
    put_bronze(spark, root, ROWS)
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF)
    run = Replay(read(spark, root, "silver/quarantine_trades"), trade_gate(AS_OF))
    plain = run.metrics().first().asDict()
    assert jobs.replay_quarantine(spark, root, as_of=AS_OF) == plain and plain["still_failing"] == 3
    for _ in range(3):
        last = jobs.replay_quarantine(spark, root, as_of=AS_OF)
    assert last == {"eligible": 0, "promoted": 0, "still_failing": 0, "archived": 0, "waiting": 0}  # nothing is left


def test_resumed_runs_miss_no_row_whatever_its_time(spark, root):
    bronze_spec, consumer = table("bronze", "binance_trades"), "silver_trades:binance_trades"

    def step(n, rows, ingest="2026-04-30 12:00:30", timeless=False):
        new = bronze(spark, rows, ingest)
        if timeless:
            new = new.withColumn("_ingest_ts", F.lit(None).cast("timestamp")).withColumn("ingestion_date", F.lit(None).cast("date"))
        tables.append(new.coalesce(1), f"{root}/bronze/binance_trades", "ingestion_date")
        frame, files = consumed.unread(spark, root, bronze_spec, consumer)
        assert frame.count() == len(rows) and len(files) == 1  # only the new file is scanned
        jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF, resume=True)
        assert read(spark, root, "silver/trades").count() == n

    step(2, [trade(1), trade(2)])
    step(4, [trade(3), trade(4)], timeless=True)  # no time at all
    step(6, [trade(5), trade(6)])  # the time of rows that were read before
    step(7, [trade(7)], "2026-04-29 00:00:00")  # a slow writer's older file
    assert consumed.unread(spark, root, bronze_spec, consumer)[0].isEmpty()
    # Maintenance renames what has been read; the ledger follows, but a day with an unread file stays unread.
    jobs.optimize_all(spark, root, "bronze", "binance_trades")
    assert consumed.unread(spark, root, bronze_spec, consumer)[0].isEmpty()
    tables.append(bronze(spark, [trade(8)]).coalesce(1), f"{root}/bronze/binance_trades", "ingestion_date")
    jobs.optimize_all(spark, root, "bronze", "binance_trades")
    assert consumed.unread(spark, root, bronze_spec, consumer)[0].count() == 5
    jobs.bronze_to_silver(spark, root, "trades", as_of=AS_OF, resume=True)
    assert sorted(r.trade_id for r in read(spark, root, "silver/trades").collect()) == [f"binance:{n}" for n in range(1, 9)]


def test_content_is_hashed_once_a_row(spark):
    """Rows are told apart by NULL and place as by value, and no text is made of them for the join."""
    from strata.sources.tables import unseen

    schema = "a string, b string, n int"
    rows = spark.createDataFrame([("x", None, 1), (None, "x", 1), ("xy", "z", 2), ("x", "yz", 2), (None, None, None)], schema)
    stored = spark.createDataFrame([("x", None, 1), ("x", "yz", 2), (None, None, None)], schema)
    left = unseen(rows, [stored, stored], ["a", "b", "n"])
    assert sorted(map(str, left.collect())) == sorted(["Row(a=None, b='x', n=1)", "Row(a='xy', b='z', n=2)"])
    assert left.columns == rows.columns and "sha2" not in left._jdf.queryExecution().toString()
