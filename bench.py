"""Benchmark: the three layers over the supplied tables, timed per step.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. ``value`` is the wall time of one full load (bronze,
silver, gold) plus an incremental load merging a second batch; ``queries``
holds the time of each step. The whole sequence runs twice in one session:
the first (cold) pass warms the JVM and is reported as ``cold_total_sec``,
the second is timed as ``value``. Reported, not counted: input preparation
(writing the product CSV and the listing table from the supplied tables), the
DDL of a new store, the first batch of the incremental load, and a full load in
which every valid row is a product of its own (``distinct_products``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from strata.plans.layers import RunParams, run_bronze, run_gold, run_silver
    from strata.plans.tables import ensure_tables
    from strata.plans.testdata import FULL_AS_OF, HISTORY_RUNS, StepClock, TestdataRuns
    from strata.sources.store import TableStore

    runs = TestdataRuns(spark, sf_dir)
    t0 = time.perf_counter()
    sources_all = runs.sources("all")
    sources_early, sources_late = runs.sources("early"), runs.sources("late")
    sources_distinct, sources_late_distinct = runs.distinct_sources("all"), runs.distinct_sources("late")
    prepare = round(time.perf_counter() - t0, 3)

    def one_pass(tag: str):
        times: dict[str, float] = {}
        aside: dict[str, float] = {}

        def timed(name, fn, into=times):
            t0 = time.perf_counter()
            out = fn()
            into[name] = round(time.perf_counter() - t0, 3)
            return out

        # Full load of every product row.
        store = TableStore(spark, f"{runs.root}/bench-{tag}-full")
        run = RunParams("batch-full", FULL_AS_OF, clock=StepClock(FULL_AS_OF))
        timed("create_tables", lambda: ensure_tables(store), aside)
        bronze = timed("bronze", lambda: run_bronze(store, sources_all, run))
        silver = timed("silver", lambda: run_silver(store, bronze.bronze, run))
        timed("gold", lambda: run_gold(store, silver_rows=silver.silver_rows))

        # Incremental: load the earlier batch, then merge the later one into it.
        hist = TableStore(spark, f"{runs.root}/bench-{tag}-history")
        (b1, t1), (b2, t2) = HISTORY_RUNS
        r1, r2 = RunParams(b1, t1), RunParams(b2, t2)
        ensure_tables(hist)
        first = timed("first_bronze", lambda: run_bronze(hist, sources_early, r1), aside)
        loaded = timed("first_silver", lambda: run_silver(hist, first.bronze, r1), aside)
        timed("first_gold", lambda: run_gold(hist, silver_rows=loaded.silver_rows), aside)
        second = timed("incremental_bronze", lambda: run_bronze(hist, sources_late, r2))
        merged = timed("incremental_silver_merge", lambda: run_silver(hist, second.bronze, r2))
        timed("incremental_gold", lambda: run_gold(hist, silver_rows=merged.silver_rows))

        # As many products as rows: silver, its merge and the fact at bronze's size.
        wide = TableStore(spark, f"{runs.root}/bench-{tag}-distinct")
        ensure_tables(wide)
        landed = timed("bronze", lambda: run_bronze(wide, sources_distinct, run), many)
        kept = timed("silver", lambda: run_silver(wide, landed.bronze, run), many)
        timed("gold", lambda: run_gold(wide, silver_rows=kept.silver_rows), many)
        again = RunParams("batch-again", FULL_AS_OF, clock=StepClock(FULL_AS_OF))
        relanded = timed("incremental_bronze", lambda: run_bronze(wide, sources_late_distinct, again), many)
        remerged = timed("incremental_silver_merge", lambda: run_silver(wide, relanded.bronze, again), many)
        timed("incremental_gold", lambda: run_gold(wide, silver_rows=remerged.silver_rows), many)
        many["silver_rows"] = remerged.silver_rows
        return times, aside, bronze, silver, merged

    many: dict[str, float] = {}
    cold, *_ = one_pass("cold")
    times, aside, bronze, silver, merged = one_pass("warm")
    total = round(sum(times.values()), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "full_plus_incremental_load",
        "value": total,
        "unit": "sec",
        "queries": times,
        "cold_total_sec": round(sum(cold.values()), 3),
        "prepare_inputs_sec": prepare,
        "first_batch_sec": aside,
        "distinct_products": many,
        "rows": {"bronze": bronze.rows, "silver": silver.silver_rows,
                 "merged_silver": merged.silver_rows},
        "sf": float(sf.group(1)) if sf else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
