"""Benchmark: every registered report, end to end, at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_RUNS=3 python bench.py

Each query is built from the folder's `lineitem` table and fully executed into a
no-op sink (every row produced, nothing collected). One untimed warm-up run, then
the median of BENCH_RUNS timed runs per query. Prints one JSON line; `value` is the
sum of the per-query medians.

`flat_queries` (BENCH_FLAT=1, default) times the production path separately: the
derived snapshots and trips are written once as month-partitioned flat Parquet tables
(under `spark.checkpoint.dir`; this local run sets a fresh folder when it is unset), then a set of reports
runs on them. It does not enter `value`.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from dockwise.operators import stations as ST  # noqa: E402
from dockwise.operators import trips as TR  # noqa: E402
from dockwise.plans import catalog  # noqa: E402
from dockwise.session import build_session, staging_path  # noqa: E402
from dockwise.sources.flat_table import (  # noqa: E402
    read_flat_snapshots,
    read_flat_trips,
    write_flat_snapshots,
    write_flat_trips,
)

# Reports timed again on the month-partitioned flat tables (parsed once, then read
# columnar with pruning and pushdown), with the parameters of the registry.
FLAT_STATION = {
    "stations_per_hour": ST.stations_per_hour,
    "never_empty_stations": ST.never_empty_stations,
    "heavy_use_log": ST.heavy_use_log,
    "full_log_pages": lambda s: ST.full_log(s, grouped=True),
    "dock_histogram": ST.dock_histogram,
}
FLAT_TRIP = {
    "trips_by_user_type": TR.trips_by_user_type,
    "trips_on_date": lambda t: TR.trips_on_date(t, catalog.DERIVED_DATE),
    "trip_count_in_hours": lambda t: TR.trip_count_in_hours(t, catalog.DERIVED_TIMES),
    "duration_bins_trimmed": TR.duration_bins_trimmed,
    "least_departures_station": TR.least_departures_station,
    "round_trip_mean_per_station": TR.round_trip_mean_per_station,
}


def run_once(spark, build, sf_dir: str) -> float:
    t0 = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def time_query(spark, build, sf_dir: str, runs: int) -> float:
    run_once(spark, build, sf_dir)  # warm-up: JIT, file listing, metadata
    return round(statistics.median(run_once(spark, build, sf_dir) for _ in range(runs)), 4)


def flat_timings(spark, sf_dir: str, runs: int) -> dict[str, float]:
    """Write the derived snapshots and trips once as flat tables, then time reports on them."""
    snap_path = staging_path(spark, f"bench-flat-snapshots-{os.getpid()}")
    trip_path = staging_path(spark, f"bench-flat-trips-{os.getpid()}")
    t0 = time.perf_counter()
    write_flat_snapshots(catalog.snapshots(spark, sf_dir), snap_path)
    write_flat_trips(catalog.trips(spark, sf_dir), trip_path)
    out = {"write_flat_tables": round(time.perf_counter() - t0, 4)}
    for name, fn in FLAT_STATION.items():
        out[name] = time_query(spark, lambda sp, d, fn=fn: fn(read_flat_snapshots(sp, snap_path)), sf_dir, runs)
    for name, fn in FLAT_TRIP.items():
        out[name] = time_query(spark, lambda sp, d, fn=fn: fn(read_flat_trips(sp, trip_path)), sf_dir, runs)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")}
    start = lambda: build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="dockwise-bench", extra=extra)
    spark = start()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.stop()
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="dockwise-bench-")
        spark = start()
    spark.sparkContext.setLogLevel("ERROR")
    names = only or list(catalog.REGISTRY)
    timings: dict[str, float] = {}
    for name in names:
        timings[name] = time_query(spark, catalog.REGISTRY[name].build, sf_dir, runs)
    flat: dict[str, float | str] = {}
    if os.environ.get("BENCH_FLAT", "1") == "1":
        try:  # optional section: never lose the headline line over it
            flat = flat_timings(spark, sf_dir, runs)
        except Exception as e:  # noqa: BLE001
            flat = {"error": f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "flat_queries": flat,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
