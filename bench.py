"""Benchmark: the four analytic queries over three table layouts, then whole-table jobs.

Prints one JSON line. Layouts and queries are timed warm and in shuffled order; times are medians in
seconds of collecting the result (queries) or computing every row of it (jobs).
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import health, layout, market_queries  # noqa: E402
from strata.plans import inputs  # noqa: E402
from strata.plans.catalog import QUERIES, stored_layers  # noqa: E402
from strata.session import build_session, scratch_path  # noqa: E402
from strata.sources import tables  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "7"))
JOB_RUNS = int(os.environ.get("BENCH_JOB_RUNS", "2"))
JOBS = (
    "silver_trades", "silver_quarantine_trades", "rules_trades", "bars_1m", "bars_5m", "bars_1h",
    "bars_1d", "bars_all_widths", "daily_volume", "daily_volume_bulk", "market_quality",
    "market_quality_full", "quarantine_replay_pass", "normalize_wire_trades", "normalize_wire_bars",
    "dedup_bars", "unique_bars", "upsert_update", "compact_roundtrip", "cluster_roundtrip", "stream_ingest",
)


def session():
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "strata-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def clock(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def make_layouts(spark, sf_dir: str) -> dict[str, str]:
    """The same Silver trades three times: fragmented, compacted, clustered by symbol."""
    paths = {name: scratch_path(spark, f"bench-{name}") for name in ("raw", "compacted", "clustered")}
    trades = inputs.trades(spark, sf_dir)
    for path in paths.values():
        tables.append(trades.repartition(48, "symbol", "side"), path, "event_date")
    layout.compact(spark, paths["compacted"], "event_date")
    layout.cluster(spark, paths["clustered"], "event_date", ("symbol",))
    return paths


def analytic(spark, path: str, schema, day, newest) -> dict:
    """Each run plans the query anew, from a table whose listing is cached by the frame."""
    trades = tables.read_table(spark, path, schema=schema)
    return {
        "q1": lambda: market_queries.single_symbol(trades, as_of=day).collect(),
        "q2": lambda: market_queries.hourly_vwap(trades, as_of=day).collect(),
        "q3": lambda: market_queries.cross_section(trades, as_of=newest).collect(),
        "q4": lambda: market_queries.count_by_symbol(trades).collect(),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    paths = make_layouts(spark, sf_dir)
    stored = inputs.trades(spark, sf_dir)
    newest = stored.agg(F.max("event_ts")).first()[0]
    plans = {
        (name, state): action
        for state, path in paths.items()
        for name, action in analytic(spark, path, stored.schema, newest.date(), newest).items()
    }
    shuffled = random.Random(7)
    timed: dict[tuple[str, str], list[float]] = {key: [] for key in plans}
    for turn in range(RUNS + 2):
        for key in shuffled.sample(sorted(plans), len(plans)):
            spent = clock(plans[key])
            if turn >= 2:
                timed[key].append(spent)
    result = {f"{q}_{state}": round(statistics.median(runs), 4) for (q, state), runs in timed.items()}
    jobs: dict[str, float] = {}
    for name in JOBS:
        def run(build=QUERIES[name]):
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        jobs[name] = round(statistics.median(clock(run) for _ in range(JOB_RUNS)), 4)
    # Counting is what a monitor repeats; the tables it counts are stored once.
    layers = stored_layers(spark, sf_dir)

    def count() -> None:
        health.stored_table_metrics(spark, layers).write.format("noop").mode("overwrite").save()

    count()
    jobs["table_metrics_stored"] = round(statistics.median(clock(count) for _ in range(JOB_RUNS)), 4)
    files = {
        state: tables.table_files(spark, path).agg(F.count("*"), F.sum("length")).first()
        for state, path in paths.items()
    }
    spark.stop()
    print(json.dumps({
        "metric": "sum of median times of q1-q4 over raw, compacted and clustered layouts",
        "value": round(sum(result.values()), 4),
        "unit": "sec",
        "queries": {**result, **jobs},
        "files": {state: row[0] for state, row in files.items()},
        "bytes": {state: row[1] for state, row in files.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
