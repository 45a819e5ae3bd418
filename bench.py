"""Time every stage table and every named result; print one JSON line.

A stage is timed when it is written, a result when all its rows are computed
over the stage tables it reads. Stages that a result builds for itself (ranked
rows, pair members) count as part of the result. `value` is the sum of all.
Results that only try an edge case (`TRIALS`) are left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlark.catalog import RESULTS, TRIALS, run, workspace  # noqa: E402
from ledgerlark.plans.workspace import STAGES  # noqa: E402
from ledgerlark.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("stage_landing", lambda: workspace(spark, folder))
    tables = workspace(spark, folder)
    for name in STAGES:
        timed(f"stage_{name}", lambda: tables.stage(name))
    for name in [name for name in RESULTS if name not in TRIALS]:
        timed(name, lambda: run(name, spark, folder).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "total seconds for all stages and named results",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder).removeprefix("sf") or 0),
                "cpus": int(cores),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
