"""Time the graph builds and the routing queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8)
the cores, BENCH_BLOCK_ROWS the arcs per block (the library's default if unset: at
sf0.1 that is two blocks, 512 make over a hundred). Building is timed apart from querying: a graph is built once and kept.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadloom.operators.blocks import ROWS_PER_BLOCK  # noqa: E402
from roadloom.plans import route  # noqa: E402
from roadloom.sources.schemas import INPUTS  # noqa: E402
from workload.graph import workload  # noqa: E402
from workload.queries import all_queries  # noqa: E402

BUILDS = ["nodes", "edges", "network", "walk_nodes", "walk_edges", "requests", "vehicles", "walkers", "areas"]
QUERIES = [
    "node_table", "edge_table_basic", "edge_table_speeds", "split_roadlink", "edge_table_pedestrian", "snap_nearest", "clip_edges", "arcs_by_period",
    "to_lonlat", "to_grid", "route_distance", "route_time", "route_astar", "route_walk", "route_all_periods", "route_edges",
    "route_summary", "geojson_features", "service_area_nodes", "service_area_edges", "drive_time_bands", "hull_convex", "hull_concave",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count().collect()  # start the executors' threads
    w = workload(spark, sf_dir, int(os.environ.get("BENCH_BLOCK_ROWS", ROWS_PER_BLOCK)))
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    timed("derive_inputs", lambda: [w.table(name) for name in INPUTS])
    for name in BUILDS:
        timed(f"build_{name}", lambda: getattr(w, name))
    queries = all_queries()
    only = os.environ.get("BENCH_ONLY", "").split(",") if os.environ.get("BENCH_ONLY") else QUERIES
    for name in only:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    searches = {}
    ended = route.attach_ends(w.vehicles, w.requests)
    for name, directed in (("plain", False), ("goal_directed", True)):
        start = time.perf_counter()
        run = route.solve(w.vehicles, ended, directed)
        searches[name] = {"steps": run.steps, "messages": run.sent, "sec": round(time.perf_counter() - start, 3)}

    requests = w.requests.count()
    rates = {
        f"{name}_per_sec": round(requests / times[name], 2)
        for name in ("snap_nearest", "route_distance", "route_time", "route_astar", "route_walk", "service_area_nodes") if name in times
    }
    print(json.dumps({
        "metric": "total query and build time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "requests": requests, "blocks": w.vehicles.blocks.blocks, "searches": searches, **rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
