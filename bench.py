"""Times every query at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query is planned, run in full and written to a sink that discards the rows. Files that
several queries read (landed text, snapshots, stored products) are prepared before the clock
of a query starts; their times are reported as ``prepare`` and are part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from orebelt.plans import workload
from orebelt.plans.queries import QUERIES
from orebelt.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))
PREPARED = {
    "landing": workload.landing,
    "record_snapshots": workload.record_snapshots,
    "yearly_snapshots": workload.yearly_snapshots,
    "shipment_files": workload.shipment_files,
    "stored_links": workload.stored_links,
    "refresh": workload.refreshed,
    "mixed_landing": workload.mixed_landing,
    "number_snapshots": workload.number_snapshots,
    "refresh_twice": workload.refreshed_twice,
}


def main(names: list[str]) -> None:
    spark = build_session("orebelt-bench", CPUS, **{"spark.sql.shuffle.partitions": CPUS})
    spark.sparkContext.setLogLevel("ERROR")
    workload.table(spark, SF_DIR, "lineitem").groupBy("l_suppkey").count().write.format(
        "noop"
    ).mode("overwrite").save()

    prepare = {}
    for name, make in PREPARED.items():
        start = time.perf_counter()
        make(spark, SF_DIR)
        prepare[name] = round(time.perf_counter() - start, 3)

    seconds = {}
    for name in names or QUERIES:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(seconds.values()) + sum(prepare.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "prepare": prepare,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
