"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned from scratch and executed in full with the ``noop``
sink (every row is produced, nothing is collected).  One warm-up pass runs
first; each query's time is the best of $BENCH_REPEAT (default 3) runs.  Prints one
JSON line (a query that fails is reported on stderr and recorded as null).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinity.plans.queries import QUERIES  # noqa: E402
from affinity.session import build_session  # noqa: E402

HEADLINE = (
    "daily_events",        # ETL: five scans, one join
    "cco_all",             # LLR cross-occurrence, events adapter
    "cco_orders",          # LLR cross-occurrence, lineitem adapter (largest)
    "popularity_table",    # one scan, one conditional aggregate
    "vector_similarity",   # exact in-category top-k cosine (blocked)
    "text_similarity",     # Word2Vec + top-k cosine
    "serving_table",       # CCO + popularity + similarity + catalogue
)


def run(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    times = {}
    for n in names:
        try:
            run(spark, n, sf_dir)         # warm-up
            times[n] = round(min(run(spark, n, sf_dir) for _ in range(repeat)), 3)
        except Exception as e:            # report, keep the JSON line coming
            print(f"{n} failed: {type(e).__name__}: {e}", file=sys.stderr)
            times[n] = None
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    done = [t for t in times.values() if t is not None]
    print(json.dumps({"metric": "total_seconds", "value": round(sum(done), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
