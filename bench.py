"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (full execution, no
collect); prints one JSON line with per-query seconds and the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarmac.plans import catalog  # noqa: E402
from tarmac.session import get_session  # noqa: E402

HEADLINE = [
    "a1_delay_rate_per_airport",   # flagship: clean x4 + join + aggregate
    "d7_clean_flights",
    "d10_clean_weather",
    "d11_clean_reviews",
    "d14_join_flights",
    "a9_describe_joined",
    "a11_arrival_delay_kde",
    "d15_f22_f23_features_train",
    "m1_label_codes",
    "m4_stratified_split",
    "j4_j5_live_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session("tarmac-bench", master=f"local[{cpus}]", shuffle_partitions=2 * cpus)
    qs = catalog.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
