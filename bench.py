"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line with per-query seconds.

Each query runs to completion through the no-op sink (the whole plan is
executed, nothing is collected to the driver). One untimed pass over all
queries warms the JVM (JIT, generated code, file cache); each query then
runs $BENCH_REPEAT times (default 2) and the best time is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parcelle.queries import REGISTRY  # noqa: E402
from parcelle.session import local_session  # noqa: E402

HEADLINE = [
    "clean_sales",
    "building_sales",
    "land_sales",
    "serving_sales",
    "type_sales",
    "row_metrics",
    "scan_gz_partitions",
    "sink_parquet",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    for name in names:  # warm-up pass, untimed
        run(REGISTRY[name](spark, sf_dir))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    times = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(REGISTRY[name](spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
