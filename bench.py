"""Time the library's queries once over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; print one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from orderlens.queries import queries
from orderlens.session import local_session

ROOT = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
# Names of queries to time instead of all.
ONLY = os.environ.get("BENCH_QUERIES", "").split()


def run(spark, name: str) -> float:
    start = time.perf_counter()
    queries()[name](spark, ROOT).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=CPUS)
    names = ONLY or list(queries())
    run(spark, "kpi07_carrier_performance")  # starts the JVM, untimed
    seconds = {name: run(spark, name) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(ROOT).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
