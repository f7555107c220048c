"""Headline-query timings: one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default: the registry's headline queries).
Each query is run to completion with the no-op sink (all columns computed,
nothing collected), once, after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tessera.plans import registry
    from tessera.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="tessera-bench")
    qs, _ = registry.load_all()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(registry.HEADLINE)
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
