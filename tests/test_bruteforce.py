"""Every report against a plain-Python computation on random small tables.

The tables include repeated stations within an hour, stations without bases,
trips with microsecond times, equal departure counts, and round trips.
"""

import random
from collections import Counter
from datetime import datetime

import pytest

from dockwise.operators import stations as ST
from dockwise.operators import trips as TR
from dockwise.schemas import TRIP
from support import rows

SEEDS = (1, 2, 3)
NAMES = ["A", "B", "C", "D", "E", "F"]


def random_snapshots(rng):
    out = []
    for day in range(1, 4):
        for hour in range(0, 24, 6):
            _id = f"2021-06-{day:02d}T{hour:02d}:00:00"
            for name in rng.sample(NAMES, rng.randint(2, 6)) + rng.sample(NAMES, 1):
                total = rng.choice([0, 5, 10, 10, 12])
                dock = rng.randint(0, total)
                res = rng.randint(0, total - dock)
                free = rng.randint(0, total - dock - res)
                out.append((_id, name, rng.choice([0, 1, 1, 1]), total, free, res, dock))
    return out


def random_trips(rng, n=300):
    out = []
    for i in range(n):
        start = rng.randint(1, 8)
        end = start if rng.random() < 0.2 else rng.randint(1, 8)
        micro = rng.choice(["", "", "", ".250000"])
        when = f"2021-06-{rng.randint(18, 21):02d}T{rng.randint(0, 23):02d}:00:00{micro}Z"
        tt = rng.choice([rng.randint(0, 5000), rng.randint(1150, 1850), rng.randint(15000, 25000), 50, 150, 250])
        out.append((rng.choice([1, 2, 3, 6, 7]), f"u{rng.randint(1, 60)}", start, end, tt, when))
    return out


SNAP_COLS = "_id string, name string, activate bigint, total_bases bigint, free_bases bigint, " \
            "reservations_count bigint, dock_bikes bigint"


@pytest.fixture(scope="module", params=SEEDS)
def data(spark, request):
    rng = random.Random(request.param)
    snaps, trips = random_snapshots(rng), random_trips(rng)
    snap_df = spark.createDataFrame(snaps, SNAP_COLS).cache()
    trip_df = spark.createDataFrame(trips, TRIP).cache()
    return snaps, trips, snap_df, trip_df


def counter_rows(c):
    return sorted(c.items(), key=repr)


def names(df):
    return sorted(r[0] for r in df.collect())


# ---------------------------------------------------------------- stations


def test_station_reports(data):
    snaps, _, df, _ = data
    every = {r[1] for r in snaps}
    broken = lambda r: r[3] > r[4] + r[5] + r[6]
    in_range = lambda r: 1 <= r[6] <= 2
    empty = lambda r: r[6] == 0
    full = lambda r: r[6] == r[3]
    heavy = lambda r: r[4] >= r[3] * 0.8

    assert rows(ST.stations_per_hour(df)) == counter_rows(Counter(r[0] for r in snaps))
    per_hour = Counter(r[0] for r in snaps)
    assert ST.avg_stations_per_hour(df).first()[0] == pytest.approx(sum(per_hour.values()) / len(per_hour))
    assert rows(ST.activation_counts(df)) == counter_rows(Counter(r[2] for r in snaps))
    assert rows(ST.inactive_stations(df)) == sorted(((r[0], r[1]) for r in snaps if r[2] == 0), key=repr)
    for pred, distinct, count, never in (
        (broken, ST.broken_stations, ST.broken_station_count, ST.never_broken_stations),
        (in_range, ST.occupancy_range_stations, ST.occupancy_range_count, ST.never_in_range_stations),
        (empty, ST.empty_stations, ST.empty_station_count, ST.never_empty_stations),
        (full, ST.full_stations, ST.full_station_count, None),
        (heavy, ST.heavy_use_stations, ST.heavy_use_count, None),
    ):
        hit = {r[1] for r in snaps if pred(r)}
        assert names(distinct(df)) == sorted(hit)
        assert count(df).first()["n"] == len(hit)
        if never is not None:
            assert names(never(df)) == sorted(every - hit)
    assert rows(ST.broken_log(df)) == sorted(
        ((r[1], r[0], r[3] - r[4] - r[5] - r[6]) for r in snaps if broken(r)), key=repr
    )
    assert rows(ST.empty_log(df)) == sorted(((r[1], r[0], r[6]) for r in snaps if empty(r)), key=repr)
    assert rows(ST.reservation_value_counts(df)) == counter_rows(Counter(r[5] for r in snaps))
    reserved = {r[1] for r in snaps if r[5] > 0}
    assert ST.reserved_station_pct(df).first()["pct"] == pytest.approx(len(reserved) * 100 / len(every))
    assert rows(ST.full_hours_per_station(df)) == counter_rows(Counter(r[1] for r in snaps if full(r)))
    ratio = lambda r: r[4] / r[3] if r[3] else None
    assert rows(ST.heavy_use_log(df)) == sorted(((r[1], r[0], ratio(r)) for r in snaps if heavy(r)), key=repr)
    heavy_names = {r[1] for r in snaps if heavy(r)}
    assert rows(ST.heavy_use_full_hours(df)) == sorted(
        ((r[1], r[0]) for r in snaps if full(r) and r[1] in heavy_names), key=repr
    )
    assert rows(ST.dock_histogram(df)) == counter_rows(Counter(r[6] for r in snaps))


def test_station_pages(data):
    snaps, _, df, _ = data
    grouped = ST.full_log(df, grouped=True, page_size=3).collect()
    want = {}
    for r in sorted((r for r in snaps if r[6] == r[3]), key=lambda r: (r[1], r[0])):
        want.setdefault(r[1], []).append(r[0])
    got = {}
    for r in sorted(grouped, key=lambda r: (r["name"], r["page"])):
        assert len(r["log"]) <= 3
        got.setdefault(r["name"], []).extend(e["_id"] for e in r["log"])
    assert got == want


# ---------------------------------------------------------------- trips


def parse(s):
    return datetime.fromisoformat(s[:-1])


def test_trip_reports(data):
    _, trips, _, df = data
    times = ("15:00:00", "16:00:00", "17:00:00")
    assert rows(TR.trips_by_user_type(df)) == counter_rows(Counter(t[0] for t in trips))
    assert rows(TR.trips_per_day(df)) == counter_rows(Counter(parse(t[5]).date().isoformat() for t in trips))
    assert rows(TR.trips_per_time(df)) == counter_rows(Counter(parse(t[5]).time().isoformat() for t in trips))
    on = [t for t in trips if parse(t[5]).date().isoformat() == "2021-06-19"]
    assert rows(TR.trips_on_date_by_user_type(df)) == counter_rows(Counter(t[0] for t in on))
    hours = [t for t in trips if parse(t[5]).time().isoformat() in times]
    assert TR.trip_count_in_hours(df).first()["n"] == len(hours)
    assert rows(TR.durations_in_hours(df)) == sorted(((t[1], t[4]) for t in hours), key=repr)
    ranges = {(r["min_s"], r["max_s"]): r["n"] for r in TR.duration_range_count(df).collect()}
    assert ranges == {(a, b): sum(1 for t in hours if a <= t[4] <= b) for a, b in ((1200, 1800), (600, 900))}
    long = [t[4] for t in trips if t[4] >= 1800]
    assert TR.long_trip_count(df).first()["n"] == len(long)
    r = TR.long_trip_mean_minutes(df).first()
    assert (r["total_s"], r["mean_minutes"]) == (sum(long), (sum(long) / len(long)) / 60)
    assert rows(TR.duration_bins(df)) == counter_rows(Counter(round(t[4], -2) / 100 for t in trips if t[4] < 20000))
    assert rows(TR.duration_bins_trimmed(df)) == counter_rows(
        Counter(b for b in (round(t[4], -2) / 100 for t in trips if t[4] < 20000) if b <= 40)
    )
    dep = Counter(t[2] for t in trips)
    low = min(dep.values())
    assert TR.min_departures(df).first()["n"] == low
    least = sorted((s, n) for s, n in dep.items() if n == low)
    assert rows(TR.least_departures_station(df)) == least
    least_ids = {s for s, _ in least}
    assert rows(TR.trips_from_least_station(df)) == sorted(
        ((t[1], t[3], t[4]) for t in trips if t[2] in least_ids), key=repr
    )
    top = sorted(dep.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [tuple(r) for r in TR.busiest_origins(df).collect()] == top
    arr = Counter(t[3] for t in trips)
    assert [tuple(r) for r in TR.busiest_destinations(df).collect()] == sorted(arr.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    rt = [t for t in trips if t[2] == t[3]]
    assert TR.round_trip_count(df).first()["n"] == len(rt)
    assert TR.round_trip_count(df, distinct_users=True).first()["n"] == len({t[1] for t in rt})
    assert rows(TR.round_trips_per_station(df)) == counter_rows(Counter(t[2] for t in rt))
    means = {}
    for t in rt:
        means.setdefault(t[2], []).append(t[4])
    got = {r["idunplug_station"]: r["mean_s"] for r in TR.round_trip_mean_per_station(df).collect()}
    assert got == pytest.approx({k: sum(v) / len(v) for k, v in means.items()})
    assert rows(TR.round_trips_per_user(df)) == counter_rows(Counter(t[1] for t in rt))
