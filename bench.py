"""Time the whole job and the headline queries; print one JSON line.

``pipeline`` reads the raw CSV and writes every output; the query times
each start from the source tables. Only the panels share something: the cube,
which the first run of the first of them stores; ``cube_flights`` and
``cube_sales`` show what its cells cost.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from skyledger.catalog import QUERIES
from skyledger.plans import kpis, pipeline
from skyledger.session import local_session
from skyledger.sources import bridge, outputs

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    *kpis.KPI_QUERIES,
    "clean_pipeline",
    "clean_report",
    "check_all",
    "reconcile_headline",
    "cube_flights",
    "cube_sales",
    "slice_vs_network",
    "panel_demand_vs_punctuality",
    "panel_delayed_routes_adaptive",
    "insight_daypart",
]
RUNS = 3


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "bench")
    folder = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    raw = f"{folder}/raw"
    outputs.write_csv(bridge.dirty_feed(spark, SF_DIR).drop("src_row"), raw)
    rows = spark.read.option("header", True).csv(raw).count()

    times = {}
    # Some small groups have no known fare, so the feed cannot pass the strict checks.
    # The first run also pays for starting up the JVM; it is reported on its own.
    first, times["pipeline"] = (
        timed(lambda: pipeline.run(spark, raw, f"{folder}/out-{i}", strict=False)) for i in range(2)
    )
    for name in HEADLINE:
        run = lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = statistics.median(timed(run) for _ in range(RUNS))
    print(
        json.dumps(
            {
                "metric": "sum of headline query seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": SF_DIR.rsplit("/sf", 1)[-1],
                "pipeline_rows": rows,
                "pipeline_first_run": round(first, 3),
                "pipeline_rows_per_sec": round(rows / times["pipeline"]),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
