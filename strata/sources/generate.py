"""Synthetic feeds for demos and benchmarks, made in parallel from a row number."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The symbols of the benchmark table and of the demo trades.
BENCH_SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT", "AAPL", "MSFT", "NVDA", "SPY", "QQQ")
DEMO_SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT")


def _unit(salt: int, column: str = "id") -> str:
    """A number in [0, 1) that depends on the row alone."""
    return f"pmod(xxhash64({column}, {salt}), 1048576) / 1048576D"


def trade_records(spark: SparkSession, rows: int, until: datetime | str, seed: int = 42) -> DataFrame:
    """Landing-shaped trades, the last one at `until`. Same seed, same rows.

    Trades thin out towards the past. Each symbol swings round a level of its own, a tenth of that of the one before;
    sizes have a heavy tail, and the side follows the swing."""
    names = ", ".join(f"'{name}'" for name in DEMO_SYMBOLS)
    swing = f"sin(seconds / 240D + {_unit(seed + 2)})"
    return spark.range(rows).selectExpr(
        "id",
        f"cast(pow({rows} - 1 - id, 1.25D) AS bigint) AS seconds",
        f"cast({len(DEMO_SYMBOLS)} * pow({_unit(seed)}, 2) AS int) AS rank",
    ).selectExpr(
        "'trade' AS event_type",
        f"TIMESTAMP'{until}' - make_dt_interval(0, 0, 0, seconds) AS event_time",
        f"element_at(array({names}), rank + 1) AS symbol",
        f"{seed} * 10000000L + id AS trade_id",
        f"cast(round(pow(10D, 4 - rank) * (1 + 0.03 * {swing}), 4) AS string) AS price",
        f"cast(round(0.002 / (0.01 + {_unit(seed + 1)}), 5) AS string) AS quantity",
        f"TIMESTAMP'{until}' - make_dt_interval(0, 0, 0, seconds) AS trade_time",
        f"{swing} > 0 AS buyer_is_maker",
    )


def bar_records(
    spark: SparkSession, start: datetime | str, good: int = 5, symbol: str = "AAPL"
) -> DataFrame:
    """Landing-shaped one-minute bars: `good` valid ones, then one with a negative volume.

    Prices swing round a slow wave; the body of a bar lies inside its range by construction."""
    middle = "180 + 12 * sin(id / 9D)"
    spread = f"(0.05 + {_unit(5)})"
    return spark.range(good + 1).selectExpr(
        f"'{symbol}' AS symbol",
        f"TIMESTAMP'{start}' + make_dt_interval(0, 0, id) AS bar_open_ts",
        "'1m' AS timeframe",
        f"{middle} + {spread} * ({_unit(6)} - 0.5) AS open",
        f"{middle} + {spread} AS high",
        f"{middle} - {spread} AS low",
        f"{middle} + {spread} * ({_unit(7)} - 0.5) AS close",
        f"CASE WHEN id = {good} THEN -1 ELSE cast(exp(3 + 5 * {_unit(8)}) AS bigint) END AS volume",
        f"{middle} AS vwap",
        f"1 + cast(40 * {_unit(9)} AS bigint) AS trade_count",
    )


def benchmark_trades(spark: SparkSession, rows: int, as_of: datetime | str) -> DataFrame:
    """Silver-shaped trades over the seven days before `as_of`.

    A few symbols hold most rows, sizes are heavy-tailed, every trade near the full hour shares its second
    with others, and one trade in fifty comes minutes late."""
    share = _unit(1)
    ranks = ", ".join(f"'{name}'" for name in BENCH_SYMBOLS)
    late = f"CASE WHEN {_unit(4)} < 0.02 THEN cast(60 + 900 * {_unit(10)} AS int) ELSE cast(5 * {_unit(10)} AS int) END"
    back = f"cast(604799 * {_unit(2)} AS int)"
    seconds = f"CASE WHEN pmod({back}, 3600) < 20 THEN {back} - pmod({back}, 20) ELSE {back} END"
    base = spark.range(rows).selectExpr(
        "id",
        f"TIMESTAMP'{as_of}' - make_dt_interval(0, 0, 0, {seconds}) AS event_ts",
        # The share of a symbol halves from one to the next.
        f"least({len(BENCH_SYMBOLS)}, 1 + cast(-log2(1 - {share}) AS int)) AS rank",
    )
    return base.selectExpr(
        "event_ts",
        f"event_ts + make_dt_interval(0, 0, 0, {late}) AS ingest_ts",
        "to_date(event_ts) AS event_date",
        "'binance' AS source",
        "'crypto' AS asset_class",
        f"element_at(array({ranks}), rank) AS symbol",
        f"CASE WHEN {_unit(3)} < 0.55 THEN 'sell' ELSE 'buy' END AS side",
        f"cast(round(exp(11 - rank) * (0.9 + 0.2 * {_unit(11)}), 4) AS decimal(38,18)) AS price",
        f"cast(round(0.0001 / (0.0005 + {_unit(12)}), 6) AS decimal(38,18)) AS quantity",
        "concat('binance:', id) AS trade_id",
        f"{late} AS late_arrival_sec",
    ).selectExpr(
        "*",
        "price * quantity AS notional",
        "to_json(named_struct('id', trade_id)) AS _raw_json",
    )
