"""Compare registered queries with their oracle SQL; run as a script for a report."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def _same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return type(left) is type(right) and left == right


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_differences(df, con, sql: str) -> list[str]:
    described = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} != {described.get(name)}"
        for name, kind in df.dtypes
        if SAME_TYPE.get(kind) != described.get(name)
    ]


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    df = build(spark, sf_dir)
    if wrong := type_differences(df, con, sql):
        return f"types {wrong}"
    got = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if not all(map(_same, a, b)):
            return f"{sorted(names)}\n  spark {a}\n  duckdb {b}"
    return None


def main(sf_dir: str, *wanted: str) -> int:
    from strata.plans.catalog import ORACLES, QUERIES
    from strata.session import build_session

    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                     "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in wanted or QUERIES:
        started = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = f"(no oracle) {QUERIES[name](spark, sf_dir).count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
