"""Cross-checks between reports, as the reference does by hand, on derived data."""

import pytest
from pyspark.sql import functions as F

from dockwise.operators import stations as ST
from dockwise.operators import trips as TR
from dockwise.plans import catalog
from support import SF_SMALL

TIMES = ("15:00:00", "16:00:00", "17:00:00")


@pytest.fixture(scope="module")
def snap(spark):
    return catalog.snapshots(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def trips(spark):
    return catalog.trips(spark, SF_SMALL).cache()


def n(df):
    return df.first()["n"]


def test_grouped_counts_sum_to_rows(snap, trips):
    total = snap.count()
    for df in (ST.stations_per_hour(snap), ST.activation_counts(snap), ST.dock_histogram(snap)):
        assert df.agg(F.sum("n")).first()[0] == total
    assert TR.trips_by_user_type(trips).agg(F.sum("n")).first()[0] == trips.count()


def test_match_plus_complement_is_all_stations(snap):
    every = snap.select("name").distinct().count()
    assert ST.broken_stations(snap).count() + ST.never_broken_stations(snap).count() == every
    assert ST.empty_stations(snap).count() + ST.never_empty_stations(snap).count() == every
    assert ST.occupancy_range_stations(snap).count() + ST.never_in_range_stations(snap).count() == every


def test_log_length_is_count_per_station(snap):
    a = {r["name"]: r["n"] for r in ST.full_hours_per_station(snap).collect()}
    b = {r["name"]: r["n"] for r in ST.full_log(snap).groupBy("name").count().withColumnRenamed("count", "n").collect()}
    assert a == b


def test_hours_sum_and_date_row(trips):
    per_time = {r["trip_time"]: r["n"] for r in TR.trips_per_time(trips).collect()}
    assert n(TR.trip_count_in_hours(trips, TIMES)) == sum(per_time.get(t, 0) for t in TIMES)
    per_day = {r["trip_date"]: r["n"] for r in TR.trips_per_day(trips).collect()}
    assert n(TR.trip_count_on_date(trips, "1997-06-19")) == per_day["1997-06-19"]


def test_published_values_for_sf0001(snap, trips):
    # Values recorded for the derived tables at sf0.001 (FIXTURES.md section 2).
    assert snap.select("_id").distinct().count() == 2289
    assert ST.broken_stations(snap).count() == 9 and ST.never_broken_stations(snap).count() == 1
    assert n(ST.heavy_use_count(snap)) == 8
    assert ST.reserved_station_pct(snap).first()["pct"] == 90.0
    assert n(TR.trip_count_in_hours(trips, TIMES)) == 701
    assert n(TR.long_trip_count(trips)) == 3675
    assert TR.long_trip_mean_minutes(trips).first()["mean_minutes"] == pytest.approx(81.0834, abs=1e-4)
    assert n(TR.round_trip_count(trips)) == 650
    assert n(TR.round_trip_count(trips, distinct_users=True)) == 533
    assert [tuple(r) for r in TR.least_departures_station(trips).collect()] == [(1, 545)]


def test_approx_distinct_is_close(snap):
    exact = n(ST.heavy_use_count(snap))
    approx = n(ST.heavy_use_count(snap, approx=True))
    assert abs(approx - exact) <= max(1, 0.1 * exact)
