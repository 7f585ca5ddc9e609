"""Run every report on snapshot and trip inputs and write each result table.

    python -m dockwise.plans.reports --snapshots 202106.json \
        --trips 202106_movements.json --out results/ [--format parquet|json|csv]

The defaults of the original analysis apply (``dockwise.fixed_values``). Each
report is written to `<out>/<name>` by the executors; nothing is collected to the
driver. Inputs are JSON Lines files or folders, or flat Parquet tables written by
``dockwise.sources.flat_table`` (`--flat`). JSON inputs are parsed once, into flat tables
under `--stage` (by default under `spark.checkpoint.dir`), and all reports run on those.
"""

from __future__ import annotations

import argparse
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dockwise import fixed_values as FV
from dockwise.operators import stations as ST
from dockwise.operators import trips as TR
from dockwise.operators.core import count_rows

StationReport = Callable[[DataFrame], DataFrame]

STATION_REPORTS: dict[str, StationReport] = {
    "snapshot_preview": ST.snapshot_preview,
    "stations_per_hour": ST.stations_per_hour,
    "avg_stations_per_hour": ST.avg_stations_per_hour,
    "activation_counts": ST.activation_counts,
    "inactive_stations": ST.inactive_stations,
    "station_capacity": ST.station_capacity,
    "station_dock_series": ST.station_dock_series,
    "station_empty_hours": ST.station_empty_hours,
    "broken_stations": ST.broken_stations,
    "broken_station_count": ST.broken_station_count,
    "never_broken_stations": ST.never_broken_stations,
    "broken_log": ST.broken_log,
    "occupancy_range_stations": ST.occupancy_range_stations,
    "occupancy_range_count": ST.occupancy_range_count,
    "occupancy_range_log": ST.occupancy_range_log,
    "never_in_range_stations": ST.never_in_range_stations,
    "empty_stations": ST.empty_stations,
    "empty_station_count": ST.empty_station_count,
    "never_empty_stations": ST.never_empty_stations,
    "empty_log": ST.empty_log,
    "empty_log_as_written": lambda s: ST.empty_log(s, as_written=True),
    "reservation_value_counts": ST.reservation_value_counts,
    "reserved_stations": ST.reserved_stations,
    "reserved_station_count": ST.reserved_station_count,
    "reserved_station_pct": ST.reserved_station_pct,
    "reserved_station_pct_of_264": lambda s: ST.reserved_station_pct(s, total=FV.STATION_COUNT),
    "reservation_log": ST.reservation_log,
    "full_stations": ST.full_stations,
    "full_station_count": ST.full_station_count,
    "full_log": ST.full_log,
    "full_hours_per_station": ST.full_hours_per_station,
    "heavy_use_stations": ST.heavy_use_stations,
    "heavy_use_count": ST.heavy_use_count,
    "heavy_use_count_strict": lambda s: ST.heavy_use_count(s, inclusive=False),
    "heavy_use_log": ST.heavy_use_log,
    "heavy_use_full_hours": ST.heavy_use_full_hours,
    "dock_histogram": ST.dock_histogram,
    "broken_log_pages": lambda s: ST.broken_log(s, grouped=True),
    "occupancy_range_log_pages": lambda s: ST.occupancy_range_log(s, grouped=True),
    "empty_log_pages": lambda s: ST.empty_log(s, grouped=True),
    "reservation_log_pages": lambda s: ST.reservation_log(s, grouped=True),
    "full_log_pages": lambda s: ST.full_log(s, grouped=True),
    "heavy_use_log_pages": lambda s: ST.heavy_use_log(s, grouped=True),
}

TRIP_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "trip_rows": count_rows,
    "trip_preview": TR.trip_preview,
    "trips_by_user_type": TR.trips_by_user_type,
    "trips_of_user_type": TR.trips_of_user_type,
    "trip_count_of_user_type": TR.trip_count_of_user_type,
    "trip_counts_of_user_types": TR.trip_counts_of_user_types,
    "trips_per_day": TR.trips_per_day,
    "trips_on_date": TR.trips_on_date,
    "trip_count_on_date": TR.trip_count_on_date,
    "trips_on_date_by_user_type": TR.trips_on_date_by_user_type,
    "trips_per_time": TR.trips_per_time,
    "trips_in_hours": TR.trips_in_hours,
    "trip_count_in_hours": TR.trip_count_in_hours,
    "durations_in_hours": TR.durations_in_hours,
    "durations_in_hours_between": TR.durations_in_hours_between,
    "duration_range_count": TR.duration_range_count,
    "long_trip_count": TR.long_trip_count,
    "long_trip_count_strict": lambda t: TR.long_trip_count(t, inclusive=False),
    "long_trip_mean_minutes": TR.long_trip_mean_minutes,
    "duration_histogram": TR.duration_histogram,
    "duration_bins": TR.duration_bins,
    "duration_bins_trimmed": TR.duration_bins_trimmed,
    "departures_per_station": TR.departures_per_station,
    "min_departures": TR.min_departures,
    "least_departures_station": TR.least_departures_station,
    "trips_from_station": TR.trips_from_station,
    "trips_from_least_station": TR.trips_from_least_station,
    "arrivals_per_station": TR.arrivals_per_station,
    "busiest_origins": TR.busiest_origins,
    "busiest_destinations": TR.busiest_destinations,
    "round_trips": TR.round_trips,
    "round_trip_count": TR.round_trip_count,
    "round_trip_user_count": lambda t: TR.round_trip_count(t, distinct_users=True),
    "round_trips_per_station": TR.round_trips_per_station,
    "round_trip_mean_per_station": TR.round_trip_mean_per_station,
    "round_trips_per_user": TR.round_trips_per_user,
}


def all_reports(snap: DataFrame | None, trips: DataFrame | None) -> dict[str, DataFrame]:
    """Every report over the given inputs (either may be None), with default parameters."""
    out: dict[str, DataFrame] = {}
    if snap is not None:
        out["snapshot_station_rows"] = count_rows(snap)
        out.update({name: fn(snap) for name, fn in STATION_REPORTS.items()})
    if trips is not None:
        out.update({name: fn(trips) for name, fn in TRIP_REPORTS.items()})
    return out


def write_reports(reports: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> list[str]:
    """Write each report to `<out_dir>/<name>` in `fmt`; returns the paths written."""
    paths = []
    for name, df in reports.items():
        path = os.path.join(out_dir, name)
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(path)
        paths.append(path)
    return paths


def _load(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame | None, DataFrame | None, dict[str, DataFrame]]:
    """Flat snapshots and trips, and reports that only the parse can give."""
    from dockwise.session import staging_path
    from dockwise.sources import flatten_snapshots, read_snapshots, read_trips
    from dockwise.sources.flat_table import read_flat_snapshots, read_flat_trips, write_flat_snapshots, write_flat_trips

    snap = trips = None
    extra: dict[str, DataFrame] = {}
    stage = args.stage
    if not args.flat and not stage:
        stage = staging_path(spark, f"reports-{uuid.uuid4().hex}")
    if args.snapshots:
        path = args.snapshots
        if not args.flat:
            path = os.path.join(stage, "snapshots")
            nested = read_snapshots(spark, args.snapshots, mode=args.mode)
            # Parsed once: the flat table's range step reads its input twice, so the parsed
            # rows are stored first, and the lines are counted as they pass.
            lines = Observation("lines")
            parsed = os.path.join(stage, "parsed_snapshots")
            nested.observe(lines, F.count(F.lit(1)).alias("n")).write.parquet(parsed)
            extra["snapshot_rows"] = spark.createDataFrame([(lines.get["n"],)], "n long")
            write_flat_snapshots(flatten_snapshots(spark.read.schema(nested.schema).parquet(parsed)), path)
        snap = read_flat_snapshots(spark, path)
    if args.trips:
        path = args.trips
        if not args.flat:
            path, parsed = os.path.join(stage, "trips"), os.path.join(stage, "parsed_trips")
            read = read_trips(spark, args.trips, mode=args.mode)
            read.write.parquet(parsed)
            write_flat_trips(spark.read.schema(read.schema).parquet(parsed), path)
        trips = read_flat_trips(spark, path)
    return snap, trips, extra


def main(argv: list[str] | None = None) -> None:
    from dockwise.session import build_session

    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--snapshots", help="snapshot JSON Lines file/folder (or flat table with --flat)")
    p.add_argument("--trips", help="trip JSON Lines file/folder (or flat table with --flat)")
    p.add_argument("--out", required=True, help="output folder, one sub-folder per report")
    p.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    p.add_argument("--flat", action="store_true", help="inputs are flat Parquet tables")
    p.add_argument("--stage", help="folder for the parsed inputs, shared by the cluster")
    p.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE", "DROPMALFORMED"])
    p.add_argument("--master", default=None)
    args = p.parse_args(argv)
    spark = build_session(args.master)
    snap, trips, extra = _load(spark, args)
    for path in write_reports(extra | all_reports(snap, trips), args.out, args.format):
        print(path)


if __name__ == "__main__":
    main()
