"""Headline-query benchmark.

Runs the BASELINE queries through the DataFrame code on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``:
one warm-up, then the median of ``$BENCH_REPS`` (default 5) timed runs each.
A run is wall time from building the DataFrame to holding the full result
on the driver (fetched as Arrow batches, ``toArrow()``). Each run builds a
fresh DataFrame, so no shuffle output is reused between runs. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edumart.plans.analogues import QUERIES  # noqa: E402
from edumart.session import build_session  # noqa: E402

HEADLINE = ["course_mart", "institution_mart", "all_editions_mart", "course_age_stats",
            "institution_age_stats", "institution_score_mean", "crosstab_count",
            "dedupe_keep_first"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = sys.argv[1:] or HEADLINE
    extra = dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if kv)
    spark = build_session(f"local[{cpus}]", cpus, extra=extra)
    times, rows = {}, {}
    for name in names:
        q = QUERIES[name]
        rows[name] = q(spark, sf_dir).toArrow().num_rows  # warm-up
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            q(spark, sf_dir).toArrow()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "reps": reps,
        "fetch": "toArrow",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
