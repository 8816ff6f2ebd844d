"""Time the query catalogue and print one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores, BENCH_QUERIES (optional,
comma-separated) a selection. Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressflow.plans.queries import catalogue  # noqa: E402
from pressflow.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    queries = catalogue()
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(queries)

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    # the first query pays for JVM and Python worker start-up, so it runs once unmeasured
    run("top_keywords")
    seconds = {name: round(run(name), 3) for name in chosen}
    print(json.dumps({
        "metric": "catalogue_total_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
