"""Small frames shared by the tests."""

from __future__ import annotations

import json
from pathlib import Path

from strata.schemas import INGEST_EXTRAS, TRADE_WIRE

AS_OF = "2026-05-01 00:00:00"


def trade(n=1, symbol="BTCUSDT", price="64000.00", quantity="0.10", ts="2026-04-30T12:00:00Z", **more):
    row = {
        "event_type": "trade", "event_time": ts, "symbol": symbol, "trade_id": n, "price": price,
        "quantity": quantity, "trade_time": ts, "buyer_is_maker": False,
    }
    return {**row, **more}


def write_lines(folder, name: str, rows) -> None:
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    lines = [row if isinstance(row, str) else json.dumps(row) for row in rows]
    (target / name).write_text("\n".join(lines) + "\n")


def bronze(spark, rows, ingest="2026-04-30 12:00:30"):
    """Trade dicts as a Bronze frame."""
    lines = spark.createDataFrame([(json.dumps(row),) for row in rows], "value string")
    from pyspark.sql import functions as F

    parsed = lines.select(F.from_json("value", TRADE_WIRE).alias("r"), "value").select("r.*", "value")
    return parsed.selectExpr(
        *[f.split()[0] for f in TRADE_WIRE.split(", ")],
        "value AS _raw_json", f"TIMESTAMP'{ingest}' AS _ingest_ts", "'binance' AS _source",
        "'-' AS _file_path", f"DATE'{ingest[:10]}' AS ingestion_date",
    )


def multiset(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


BRONZE_DDL = f"{TRADE_WIRE}, {INGEST_EXTRAS}"
