from decimal import Decimal

import pytest
from helpers import AS_OF, bronze, multiset, trade
from pyspark.sql import functions as F

from strata.operators.quality import FAILURES_COL, QualityGate, Rule, failures_by_code
from strata.operators.rules import (
    bar_gate,
    gold_bar_gate,
    repeated_keys,
    split_on_unique_key,
    trade_gate,
)
from strata.operators.typed import silver_bars, silver_trades

PRICE = Rule("R1", "PRICE_NOT_POSITIVE", "error", "price > 0", "price > 0")


def codes(df):
    return {
        row["k"]: [f["error_code"] for f in row[FAILURES_COL]]
        for row in df.withColumnRenamed(df.columns[0], "k").collect()
    }


def test_error_rule_splits(spark):
    df = spark.createDataFrame([(1, 100.0), (2, -1.0), (3, 50.0)], "id bigint, price double")
    passing, failed = QualityGate([PRICE]).split(df)
    assert passing.count() == 2
    assert passing.columns == ["id", "price"]
    assert codes(failed) == {2: ["PRICE_NOT_POSITIVE"]}


def test_warning_does_not_quarantine_but_can_be_kept(spark):
    late = Rule("W", "LATE", "warning", "late", "late_sec < 60")
    df = spark.createDataFrame([(1, 30), (2, 120)], "id bigint, late_sec int")
    gate = QualityGate([late])
    passing, failed = gate.split(df)
    assert (passing.count(), failed.count()) == (2, 0)
    assert codes(gate.passing(df, keep_warnings=True)) == {1: [], 2: ["LATE"]}


def test_null_predicate_is_a_failure(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0)], "id bigint, price double")
    passing, failed = QualityGate([PRICE]).split(df)
    assert [r.id for r in passing.collect()] == [2]
    assert [r.id for r in failed.collect()] == [1]


def test_no_rules_gives_an_empty_typed_array(spark):
    out = QualityGate([]).evaluate(spark.range(2))
    assert [r[FAILURES_COL] for r in out.collect()] == [[], []]
    assert out.schema[FAILURES_COL].dataType.simpleString() == (
        "array<struct<error_code:string,error_msg:string,severity:string>>"
    )
    assert QualityGate([]).passing(spark.range(2)).count() == 2


def test_column_predicates_and_bad_severity(spark):
    rule = Rule("C", "ODD", "error", "even", lambda: F.col("id") % 2 == 0)
    assert QualityGate([rule]).quarantined(spark.range(4)).count() == 2
    with pytest.raises(ValueError, match="severity"):
        Rule("C", "X", "fatal", "", "true")


EDGE_ROWS = [
    (trade(1), []),
    (trade(2, price=None), ["PRICE_NOT_POSITIVE", "PRICE_OUT_OF_RANGE"]),
    (trade(3, price="abc"), ["PRICE_NOT_POSITIVE", "PRICE_OUT_OF_RANGE"]),
    (trade(4, quantity="0"), ["QUANTITY_NOT_POSITIVE"]),
    (trade(5, symbol=None), ["PRICE_OUT_OF_RANGE", "SYMBOL_UNKNOWN"]),
    (trade(6, symbol="AAPL", price="0.001"), ["PRICE_OUT_OF_RANGE"]),
    (trade(7, price="0.001"), []),
    (trade(8, price="20000000"), ["PRICE_OUT_OF_RANGE"]),
    (trade(9, ts="2014-12-31T23:59:59Z"), ["EVENT_TS_INVALID", "LATE_ARRIVAL"]),
    (trade(10, ts="2026-05-01T00:02:00Z"), ["EVENT_TS_INVALID"]),
    (trade(11, ts="2026-05-01T00:01:00Z"), []),
    (trade(12, trade_time=None), ["EVENT_TS_INVALID", "LATE_ARRIVAL"]),
    (trade(None), ["TRADE_ID_MISSING"]),
    (trade(14, ts="2026-04-30T11:55:30Z"), ["LATE_ARRIVAL"]),
    (trade(15, ts="2026-04-30T11:55:31Z"), []),
    (trade(16, symbol="DEMOUSDT", quantity="-1"), ["QUANTITY_NOT_POSITIVE", "SYMBOL_UNKNOWN"]),
    (trade(17, price="1" + "0" * 25), ["PRICE_NOT_POSITIVE", "PRICE_OUT_OF_RANGE"]),
]


def test_trade_rules_on_edge_rows(spark):
    typed = silver_trades(bronze(spark, [row for row, _ in EDGE_ROWS]))
    gate = trade_gate(AS_OF)
    got = {
        r.trade_id: [f.error_code for f in r[FAILURES_COL]] for r in gate.evaluate(typed).collect()
    }
    want = {
        None if row["trade_id"] is None else f"binance:{row['trade_id']}": failed
        for row, failed in EDGE_ROWS
    }
    assert got == want
    # The two halves are the evaluated rows, split exactly by "any error failed".
    passing, failed = gate.split(typed)
    any_error = F.exists(FAILURES_COL, lambda f: f["severity"] == "error")
    evaluated = gate.evaluate(typed)
    assert multiset(passing) == multiset(evaluated.filter(~any_error).drop(FAILURES_COL))
    assert multiset(failed) == multiset(evaluated.filter(any_error))
    tally = {r.error_code: r.failed_rows for r in gate.tally(typed).collect()}
    flat = [code for _, row in EDGE_ROWS for code in row]
    assert tally == {rule.error_code: flat.count(rule.error_code) for rule in gate.rules}
    by_code = {r.error_code: (r.n_rows, r.n_first) for r in failures_by_code(failed).collect()}
    assert by_code["SYMBOL_UNKNOWN"] == (2, 0)
    assert by_code["QUANTITY_NOT_POSITIVE"] == (2, 2)


def test_typed_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "cast(id AS double) AS price").write.parquet(path)
    plan = QualityGate([PRICE]).passing(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "GreaterThan(price,0.0)" in plan


BAR = "symbol string, bar_open_ts string, timeframe string, open double, high double, low double, " \
      "close double, volume bigint, vwap double, trade_count bigint, _ingest_ts string"


def bars(spark, *rows):
    full = [(*row, "2026-04-30 12:10:00") for row in rows]
    return silver_bars(spark.createDataFrame(full, BAR))


def test_bar_rules(spark):
    ts = "2026-04-30 12:00:00"
    typed = bars(
        spark,
        ("A", ts, "1m", 100.0, 102.0, 99.0, 101.0, 10, 100.5, 3),
        ("B", ts, "1m", 100.0, 102.0, 99.0, 101.0, -1, 100.5, 3),
        ("C", ts, "1m", 100.0, 98.0, 99.0, 101.0, 1, 100.5, 3),
        ("D", ts, "2m", 103.0, 102.0, 99.0, 98.0, 1, 100.5, 3),
        ("E", ts, "1m", 100.0, 102.0, 99.0, 101.0, None, 100.5, 3),
        (None, None, "1Min", 100.0, 102.0, 99.0, 101.0, 1, None, None),
    )
    got = {r.symbol: [f.error_code for f in r[FAILURES_COL]]
           for r in bar_gate().evaluate(typed).collect()}
    assert got == {
        "A": [],
        "B": ["BAR_VOLUME_NEGATIVE"],
        "C": ["BAR_HIGH_LOW_INVERTED", "BAR_OPEN_OUT_OF_RANGE", "BAR_CLOSE_OUT_OF_RANGE"],
        "D": ["BAR_TIMEFRAME_INVALID", "BAR_OPEN_OUT_OF_RANGE", "BAR_CLOSE_OUT_OF_RANGE"],
        "E": ["BAR_VOLUME_NEGATIVE"],
        None: ["BAR_TIMESTAMP_NULL", "BAR_SYMBOL_NULL"],
    }
    gold = {r.symbol: [f.error_code for f in r[FAILURES_COL]]
            for r in gold_bar_gate().evaluate(typed).collect()}
    assert gold["A"] == [] and gold["B"] == ["VOLUME_NEGATIVE"] and gold["C"] == ["BAR_INCONSISTENT"]


def test_typed_trade_values(spark):
    rows = [trade(1, price="1.0000005", quantity="3", buyer_is_maker=True),
            trade(2, price="2", quantity="2", buyer_is_maker=None)]
    first, second = silver_trades(bronze(spark, rows)).orderBy("trade_id").collect()
    assert (first.side, second.side) == ("sell", "buy")
    assert first.notional == Decimal("3.000002")  # decimal(38,6), half up
    assert (first.source, first.asset_class, first.trade_id) == ("binance", "crypto", "binance:1")
    assert first.late_arrival_sec == 30
    assert str(first.event_date) == "2026-04-30"


def test_missing_raw_column_is_a_typed_null(spark):
    out = silver_trades(bronze(spark, [trade(1)]).drop("_raw_json"))
    assert out.schema["_raw_json"].dataType.simpleString() == "string"
    assert out.first()._raw_json is None


def test_unique_key_split_with_a_hot_key(spark):
    hot = spark.range(3000).selectExpr("'HOT' AS symbol", "1 AS bar_open_ts", "'1m' AS timeframe", "id")
    rest = spark.range(500).selectExpr(
        "if(id < 2, NULL, concat('S', id)) AS symbol", "1 AS bar_open_ts", "'1m' AS timeframe", "id")
    df = hot.unionByName(rest)
    unique, repeated = split_on_unique_key(df)
    assert (unique.count(), repeated.count()) == (498, 3002)
    assert {r.symbol: r.n_rows for r in repeated_keys(df).collect()} == {"HOT": 3000, None: 2}
    assert multiset(unique.unionByName(repeated)) == multiset(df)
