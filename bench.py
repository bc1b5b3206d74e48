"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line {"metric", "value", "unit", "queries", "sf"}.

Each query is timed end to end (plan + full materialisation with a no-op
write, so every row is produced) after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    from agrospark.session import local_session
    from agrospark.plans import catalog
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")))
    qs = catalog.bench_queries() if not only else {k: v for k, v in catalog.queries().items()
                                                     if k in only}
    # warm-up: JVM, parquet footers
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    times = {}
    for name, build in qs.items():
        t0 = time.time()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
