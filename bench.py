"""Time the star-schema build and the queries on it; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. The rules are those of the checked
queries. The build (``curate``) is timed on its own, with the time of every table it stages under
``staged``, as the queries after it read those tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract.queries import all_queries, plan  # noqa: E402
from tarmac.session import local_session  # noqa: E402


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {"curate": timed(lambda: plan(spark, sf_dir).tables())}
    for name, query in all_queries().items():
        # The noop sink computes every row and column without sending them to the driver.
        seconds[name] = timed(
            lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    staged = {k: round(v, 3) for k, v in plan(spark, sf_dir).stage.seconds.items()}
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
        "staged": staged,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
