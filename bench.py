"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  A query is timed to full
materialisation with the ``noop`` sink (every row computed, nothing
collected on the driver).  Each query runs once cold, then ``$BENCH_REPS``
(default 3) warm times; the reported time is the best warm run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from radiolens.plans.queries import QUERIES  # noqa: E402
from radiolens.session import local_session  # noqa: E402

HEADLINE = [
    "pair_stats",            # E1: render + decode records, moments, sort
    "pair_stats_tabular",    # same statistics from the table (J1 by joins)
    "pair_stats_multi_report",
    "pair_stats_zero",
    "synthetic_pairs",
    "rollup_partials",       # partials stored per period, merged
    "field_stats",
    "measurements",
    "bearers",
    "long_stats",
    "report_text",
    "edges",
    "components",
    "components_low_threshold",   # a graph with edges at sf0.1
    "file_window",
    "windowed_stats",        # E1 from record files of a window
    "windowed_field_stats",
    "stream_pair_sums",
]


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus))
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, sf), 3)
        warm[name] = round(min(run(spark, name, sf) for _ in range(max(reps, 1))), 3)
    out = {
        "metric": "sum of warm query seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
