"""End to end: derived data written as JSON Lines files, every report run by the CLI."""

import os

import pytest

from dockwise.plans import catalog
from dockwise.plans.reports import STATION_REPORTS, TRIP_REPORTS, main
from dockwise.sources import derived
from support import SF_SMALL, rows


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("cli")
    li = derived.load_lineitem(spark, SF_SMALL)
    derived.snapshot_json_lines(li).write.text(str(base / "snapshots"))
    derived.trip_json_lines(li).write.text(str(base / "trips"))
    out = base / "out"
    main(["--snapshots", str(base / "snapshots"), "--trips", str(base / "trips"), "--out", str(out)])
    return out


def test_every_report_written(written):
    names = set(os.listdir(written))
    assert set(STATION_REPORTS) | set(TRIP_REPORTS) <= names


@pytest.mark.parametrize(
    "name",
    [
        "stations_per_hour",
        "never_empty_stations",
        "heavy_use_count",
        "reserved_station_pct",
        "dock_histogram",
        "trips_by_user_type",
        "duration_bins_trimmed",
        "least_departures_station",
        "trips_from_least_station",
        "round_trip_mean_per_station",
        "busiest_origins",
    ],
)
def test_written_report_equals_registry(spark, written, name):
    got = spark.read.parquet(str(written / name))
    want = catalog.REGISTRY[name].build(spark, SF_SMALL)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
