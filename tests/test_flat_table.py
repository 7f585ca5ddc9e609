"""Flat Parquet tables and reports run on them."""

import json
import os
import re

from dockwise.operators import stations as ST
from dockwise.operators import trips as TR
from dockwise.sources import flatten_snapshots, read_snapshots
from dockwise.sources.flat_table import (
    read_flat_snapshots,
    read_flat_trips,
    write_flat_snapshots,
    write_flat_trips,
)
from fixtures import SNAPSHOTS, TRIPS, station_dict, trips_df
from support import as_dict, rows

TRIP_KEYS = ["user_type", "user_day_code", "idunplug_station", "idplug_station", "travel_time", "unplug_hourTime"]


def write_trip_file(path, data):
    with open(path, "w") as f:
        for t in data:
            f.write(json.dumps(dict(zip(TRIP_KEYS, t))) + "\n")


def test_flat_trips_round_trip_and_prune(spark, tmp_path):
    extra = [(1, "u99", 10, 20, 60, "2021-07-02T08:00:00Z")]
    for period, folders in (
        ("day", ["trip_period=2021-06-19", "trip_period=2021-06-20", "trip_period=2021-06-21", "trip_period=2021-07-02"]),
        ("month", ["trip_period=2021-06", "trip_period=2021-07"]),
    ):
        path = str(tmp_path / f"trips_{period}")
        write_flat_trips(trips_df(spark, TRIPS + extra), path, period=period)
        assert sorted(d for d in os.listdir(path) if d.startswith("trip_period=")) == folders
        flat = read_flat_trips(spark, path)
        assert as_dict(TR.trips_per_day(flat), "trip_date") == {
            "2021-06-19": 4, "2021-06-20": 3, "2021-06-21": 5, "2021-07-02": 1
        }
        assert TR.trip_count_in_hours(flat).first()["n"] == 7
        on_date = TR.trips_on_date(flat, "2021-06-20")
        plan = on_date._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*trip_period#\d+[^\]]* IN \(2021-06,2021-06-20\)", plan)
        assert "PushedFilters: [IsNotNull(trip_date), EqualTo(trip_date,2021-06-20)]" in plan
        assert on_date.count() == 3


def test_flat_snapshots_round_trip(spark, tmp_path):
    src = tmp_path / "snap.json"
    with open(src, "w") as f:
        for hour, stations in SNAPSHOTS:
            f.write(json.dumps({"_id": f"2021-06-0{hour[1]}T10:00:00", "stations": [station_dict(*s) for s in stations]}) + "\n")
    flat = flatten_snapshots(read_snapshots(spark, str(src)))
    path = str(tmp_path / "flat")
    write_flat_snapshots(flat, path)
    back = read_flat_snapshots(spark, path)
    assert back.count() == 9
    assert as_dict(ST.full_hours_per_station(back), "name") == {"B": 2, "Miguel Moya": 1}
    assert [r[0] for r in back.select("snapshot_period").distinct().collect()] == ["2021-06"]
