"""Benchmark: headline models at $BENCH_SF_DIR on local[$BENCH_CPUS].

The load stage (deriving and writing the raw tables) is timed as
``load_raw`` (two warm-ups, median of three); every model is then run to completion with the ``noop`` sink
(full execution, nothing collected): two warm-ups, median of three runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from staylake.plans.registry import QUERIES, load_warehouse  # noqa: E402
from staylake.session import get_session  # noqa: E402

HEADLINE = [
    "dm_host_neighbourhood", "dm_listing_neighbourhood", "dm_property_type",
    "fact_listing", "q1_best_worst", "q2_best_type", "q3_local_rate",
    "q4_mortgage_cover", "scd2_listing", "stg_host",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="staylake-bench",
                        shuffle_partitions=partitions)
    spark.sparkContext.setLogLevel("ERROR")

    for _ in range(2):  # warm-up (JVM start, JIT, code generation)
        load_warehouse(spark, sf_dir)
    loads = []
    for _ in range(runs):
        t0 = time.perf_counter()
        load_warehouse(spark, sf_dir)
        loads.append(time.perf_counter() - t0)
    timings = {"load_raw": round(statistics.median(loads), 3)}

    for name in names:
        fn = QUERIES[name]
        for _ in range(2):  # warm-up (JIT, code generation)
            _run(fn(spark, sf_dir))
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            _run(fn(spark, sf_dir))
            samples.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(samples), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings,
        "models_sec": round(sum(v for k, v in timings.items() if k != "load_raw"), 3), "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
