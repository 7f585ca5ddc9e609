"""Trip reports on the hand-worked trip table (answers worked out by hand)."""

import pytest

from dockwise.operators import trips as TR
from fixtures import TRIPS, trips_df
from support import as_dict, rows

TIMES = ("15:00:00", "16:00:00", "17:00:00")


@pytest.fixture(scope="module")
def t(spark):
    return trips_df(spark).cache()


def test_by_user_type(t):
    assert as_dict(TR.trips_by_user_type(t), "user_type") == {1: 6, 2: 1, 3: 2, 6: 1, 7: 2}


def test_counts_of_user_types_zero_fill(t):
    got = as_dict(TR.trip_counts_of_user_types(t, (1, 2, 3, 5, 6, 7)), "user_type")
    assert got == {1: 6, 2: 1, 3: 2, 5: 0, 6: 1, 7: 2}
    assert TR.trip_count_of_user_type(t, 3).first()["n"] == 2


def test_trips_of_user_type(t):
    got = TR.trips_of_user_type(t, 2)
    assert got.columns == ["user_day_code", "idunplug_station", "idplug_station", "travel_time", "unplug_hourTime"]
    assert rows(got) == [("u3", 20, 10, 250, "2021-06-19T18:00:00Z")]


def test_per_day_and_on_date(t):
    assert as_dict(TR.trips_per_day(t), "trip_date") == {"2021-06-19": 4, "2021-06-20": 3, "2021-06-21": 5}
    assert TR.trip_count_on_date(t).first()["n"] == 4  # default date is the reference's
    assert as_dict(TR.trips_on_date_by_user_type(t, "2021-06-19"), "user_type") == {1: 3, 2: 1}
    assert TR.trips_on_date(t, "2021-06-20").count() == 3


def test_per_time(t):
    got = as_dict(TR.trips_per_time(t), "trip_time")
    assert got == {"00:00:00": 1, "09:00:00": 2, "15:00:00": 3, "16:00:00": 2, "17:00:00": 2, "18:00:00": 1, "23:00:00": 1}


def test_in_hours(t):
    got = TR.trips_in_hours(t, TIMES)
    assert sorted(r["travel_time"] for r in got.collect()) == [50, 51, 150, 600, 1200, 1800, 4051]
    assert TR.trip_count_in_hours(t, TIMES).first()["n"] == 7
    assert TR.durations_in_hours(t, TIMES).columns == ["user_day_code", "travel_time"]


def test_duration_ranges(t):
    assert TR.durations_in_hours_between(t, TIMES, 1200, 1800).count() == 2
    got = {(r["min_s"], r["max_s"]): r["n"] for r in TR.duration_range_count(t, TIMES).collect()}
    assert got == {(1200, 1800): 2, (600, 900): 1}


def test_long_trips(t):
    assert TR.long_trip_count(t).first()["n"] == 6
    assert TR.long_trip_count(t, 1800, inclusive=False).first()["n"] == 5
    r = TR.long_trip_mean_minutes(t).first()
    assert r["total_s"] == 51701
    assert r["mean_minutes"] == pytest.approx(143.6138888888889, rel=1e-15)


def test_long_trip_mean_of_nothing_is_null(t):
    r = TR.long_trip_mean_minutes(t, 10**9).first()
    assert r["total_s"] is None and r["mean_minutes"] is None


def test_bins_half_even(t):
    assert as_dict(TR.duration_bins(t), "bin") == {
        0.0: 1, 1.0: 1, 2.0: 2, 6.0: 1, 12.0: 1, 18.0: 2, 40.0: 1, 41.0: 1, 200.0: 1
    }
    assert as_dict(TR.duration_bins_trimmed(t), "bin") == {
        0.0: 1, 1.0: 1, 2.0: 2, 6.0: 1, 12.0: 1, 18.0: 2, 40.0: 1
    }


def test_duration_histogram(t):
    got = as_dict(TR.duration_histogram(t), "travel_time")
    assert sum(got.values()) == len(TRIPS) and got[50] == 1


def test_departures(t):
    assert as_dict(TR.departures_per_station(t), "idunplug_station") == {10: 5, 20: 5, 30: 2}
    assert TR.min_departures(t).first()["n"] == 2
    assert rows(TR.least_departures_station(t)) == [(30, 2)]
    assert as_dict(TR.arrivals_per_station(t), "idplug_station") == {10: 5, 20: 4, 30: 3}


def test_least_departures_ties(spark):
    tied = trips_df(spark, [r for i, r in enumerate(TRIPS, 1) if i not in (1, 2, 5)])
    assert rows(TR.least_departures_station(tied)) == [(10, 2), (30, 2)]
    assert rows(TR.least_departures_station(tied, ties="first")) == [(10, 2)]
    got = TR.trips_from_least_station(tied)
    assert sorted(r["travel_time"] for r in got.collect()) == [1800, 4050, 19999, 20000]


def test_trips_from_station(t):
    assert rows(TR.trips_from_station(t, 30)) == [("u5", 10, 1800), ("u9", 30, 19999)]
    assert TR.trips_from_station(t).count() == 0  # the reference's station id is absent


def test_busiest(t):
    assert rows(TR.busiest_origins(t, 2)) == [(10, 5), (20, 5)]
    assert [tuple(r) for r in TR.busiest_destinations(t, 1).collect()] == [(10, 5)]


def test_round_trips(t):
    assert TR.round_trips(t).count() == 5
    assert TR.round_trip_count(t).first()["n"] == 5
    assert TR.round_trip_count(t, distinct_users=True).first()["n"] == 5
    assert as_dict(TR.round_trips_per_station(t), "idunplug_station") == {10: 2, 20: 2, 30: 1}
    assert as_dict(TR.round_trip_mean_per_station(t), "idunplug_station", "mean_s") == {
        10: 625.0, 20: 375.0, 30: 19999.0
    }
    assert as_dict(TR.round_trips_per_user(t), "user_day_code") == {"u1": 1, "u2": 1, "u4": 1, "u9": 1, "u10": 1}


def test_null_ends_are_not_a_round_trip(spark):
    t = trips_df(spark, TRIPS + [(1, "u11", None, None, 10, "2021-06-21T10:00:00Z")])
    assert TR.round_trip_count(t).first()["n"] == 5


def test_preview_is_ordered(t):
    got = TR.trip_preview(t, 3).collect()
    assert [r["user_day_code"] for r in got] == ["u1", "u1", "u2"]
    assert [r["travel_time"] for r in got] == [50, 51, 150]


def test_trip_dates_and_times(t):
    d = TR.trip_dates(t)
    assert d.columns[0] == "trip_date" and d.count() == len(TRIPS)
    assert TR.trip_times(t).columns[0] == "trip_time"
