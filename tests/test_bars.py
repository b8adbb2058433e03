from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.market import bucket_start
from strata.operators.bars import (
    bars_unchecked,
    gold_bars,
    gold_bars_together,
    one_minute_bars,
)
from strata.operators.profiles import (
    daily_volume,
    market_quality,
    market_quality_with_quarantine,
)

D = Decimal
BAR = (
    "bar_open_ts timestamp, symbol string, asset_class string, timeframe string, "
    "open decimal(38,18), high decimal(38,18), low decimal(38,18), close decimal(38,18), "
    "volume decimal(38,18), vwap decimal(38,18), trade_count bigint"
)
NOON = datetime(2026, 4, 30, 12, 0)


def minute_bars(spark, rows):
    return spark.createDataFrame(
        [
            (NOON + timedelta(minutes=i), "BTCUSDT", "crypto", tf, D(100 + i), D(102 + i), D(99 + i),
             D(101 + i), D(volume), None if vwap is None else D(vwap), i + 1)
            for i, tf, volume, vwap in rows
        ],
        BAR,
    )


GOLDEN = [(i, "1m", i + 1, 100 + i) for i in range(5)]


def test_five_minute_golden_row(spark):
    passing, failing = gold_bars(minute_bars(spark, GOLDEN), "5m")
    (bar,) = passing.collect()
    assert failing.count() == 0
    assert (bar.open, bar.high, bar.low, bar.close) == (100, 106, 99, 105)
    assert (bar.volume, bar.vwap, bar.trade_count) == (15, D("102.666667"), 15)
    assert (bar.timeframe, str(bar.bar_date)) == ("5m", "2026-04-30")


def test_one_minute_passes_through_and_is_checked(spark):
    passing, failing = gold_bars(minute_bars(spark, [*GOLDEN, (5, "1m", -1, 1)]), "1m")
    assert (passing.count(), failing.count()) == (5, 1)
    assert "bar_date" in passing.columns


def test_unknown_width_is_refused(spark):
    with pytest.raises(ValueError, match="15m"):
        gold_bars(minute_bars(spark, GOLDEN), "15m")


def test_zero_volume_gives_null_vwap(spark):
    (bar,) = gold_bars(minute_bars(spark, [(0, "1m", 0, 5), (1, "1m", 0, 6)]), "5m")[0].collect()
    assert (bar.volume, bar.vwap) == (0, None)


def test_null_vwap_bar_keeps_its_volume(spark):
    (bar,) = gold_bars(minute_bars(spark, [(0, "1m", 1, 10), (1, "1m", 1, None)]), "5m")[0].collect()
    assert (bar.volume, bar.vwap) == (2, D(5))


def test_other_widths_are_not_counted_twice(spark):
    rows = [*GOLDEN, (0, "5m", 15, 102), (1, "1Min", 1, 101)]
    (bar,) = gold_bars(minute_bars(spark, rows), "5m")[0].collect()
    assert bar.volume == 16


def test_widths_together_equal_widths_apart(spark):
    bars = minute_bars(spark, [(i, "1m", i % 7, 100 + i) for i in range(0, 1500, 3)])
    together = gold_bars_together(bars)
    for width in ("5m", "1h", "1d"):
        one = gold_bars(bars, width)[0]
        cols = sorted(one.columns)
        left = together.filter(F.col("timeframe") == width).select(*cols)
        assert left.exceptAll(one.select(*cols)).count() == 0
        assert one.select(*cols).exceptAll(left).count() == 0


TRADE = (
    "event_ts timestamp, event_date date, symbol string, asset_class string, trade_id string, "
    "price decimal(38,18), quantity decimal(38,18), notional decimal(38,6), late_arrival_sec int"
)


def trades(spark, rows):
    return spark.createDataFrame(
        [(ts, ts.date(), "X", "crypto", f"binance:{n}", None if p is None else D(p), D(q),
          None if p is None else D(p) * D(q), late) for ts, n, p, q, late in rows],
        TRADE,
    )


def test_open_and_close_follow_time_then_sequence(spark):
    # 9 and 10 share a microsecond: numeric order, not text order, decides.
    rows = [(NOON, 10, 3, 1, 0), (NOON, 9, 2, 1, 0), (NOON + timedelta(seconds=5), 1, 7, 2, 0),
            (NOON + timedelta(seconds=59), 12, 5, 1, 0), (NOON + timedelta(seconds=59), 11, 6, 1, 0)]
    for parts in (1, 3, 5):
        (bar,) = one_minute_bars(trades(spark, rows).repartition(parts)).collect()
        assert (bar.open, bar.close, bar.high, bar.low) == (2, 5, 7, 2)
        assert (bar.volume, bar.trade_count, bar.vwap) == (6, 5, D("5.000000"))
        assert (bar.source, bar.timeframe) == ("trade_rollup", "1m")


def test_rows_without_price_set_no_open(spark):
    (bar,) = one_minute_bars(
        trades(spark, [(NOON, 1, None, 1, 0), (NOON + timedelta(seconds=1), 2, 4, 1, 0)])
    ).collect()
    assert (bar.open, bar.close, bar.trade_count) == (4, 4, 2)


def test_one_minute_bars_use_hash_aggregation(spark):
    plan = one_minute_bars(trades(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_bucket_start_against_python(spark):
    moments = [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1),
               datetime(2024, 2, 29, 23, 59, 59, 1), datetime(2026, 3, 29, 1, 30),
               datetime(2026, 10, 25, 2, 59, 59)]
    df = spark.createDataFrame([(m,) for m in moments], "ts timestamp")
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    for width, seconds in (("1m", 60), ("5m", 300), ("1h", 3600), ("1d", 86400)):
        got = df.select(F.unix_micros("ts"), F.unix_micros(bucket_start("ts", width))).collect()
        for m, (micros, start) in zip(moments, got, strict=True):
            assert micros == (m.replace(tzinfo=UTC) - epoch) // timedelta(microseconds=1)
            assert start == micros // (seconds * 10**6) * (seconds * 10**6)


def test_daily_volume(spark):
    rows = [(NOON, 1, 10, 2, 0), (NOON + timedelta(hours=3), 2, 20, 1, 0),
            (NOON + timedelta(days=1), 3, 5, 0, 0)]
    first, second = daily_volume(trades(spark, rows)).orderBy("bar_date").collect()
    assert (first.total_volume, first.total_notional, first.trade_count) == (3, 40, 2)
    assert (first.price_high, first.price_low, first.vwap) == (20, 10, D("13.333333"))
    assert (second.total_volume, second.vwap) == (0, None)


def test_market_quality(spark):
    rows = [(NOON, 1, 10, 1, 61), (NOON + timedelta(minutes=59), 2, 20, 1, 60),
            (NOON + timedelta(minutes=60), 3, 30, 1, 0)]
    first, second = market_quality(trades(spark, rows)).orderBy("metric_hour").collect()
    assert (first.trade_count, first.late_arrival_pct, first.quarantine_pct) == (2, 0.5, 0.0)
    assert first.price_volatility == pytest.approx(7.0710678, abs=1e-6)
    assert (first.price_max, first.price_min) == (20.0, 10.0)
    assert second.price_volatility is None


def test_market_quality_with_quarantine(spark):
    clean = trades(spark, [(NOON, 1, 10, 1, 0), (NOON, 2, 10, 1, 0), (NOON, 3, 10, 1, 90)])
    bad = trades(spark, [(NOON, 4, -1, 1, 0), (NOON + timedelta(hours=2), 5, -1, 1, 0)])
    (row,) = market_quality_with_quarantine(clean, bad).collect()
    assert (row.trade_count, row.quarantine_pct, row.price_min) == (3, 0.25, 10.0)
    assert row.late_arrival_pct == pytest.approx(1 / 3)
    (plain,) = market_quality(clean).collect()
    assert (row.price_volatility, row.late_arrival_pct) == (plain.price_volatility, plain.late_arrival_pct)


def test_unchecked_bars_keep_failing_rows(spark):
    assert bars_unchecked(minute_bars(spark, [(0, "1m", -5, 1)]), "5m").count() == 1
