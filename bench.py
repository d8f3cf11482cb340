"""Headline-query benchmark.

Runs the headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS] and prints one JSON line.  Each query is fully executed
with the ``noop`` sink (no collect to the driver); the reported time is the
better of two runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mapfold import plans  # noqa: E402
from mapfold.session import get_spark  # noqa: E402

HEADLINE = [
    "join_within_area",
    "join_intersects",
    "join_overlay_lines",
    "ov_neighbour_lines",
    "ras_slope",
    "pcode_units",
    "osm_school",
    "admin_route",
    "tag_catalog",
    "page_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", **{"spark.sql.shuffle.partitions": str(int(cpus) * 2)})
    qs = plans.queries()
    # warm-up: JVM, codegen and file listing
    qs["join_within_area"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
