"""Readers and parsing edge cases: bad lines, missing arrays, time zones, microseconds."""

import json

import pytest
from pyspark.sql import functions as F

from dockwise.functions import columns as C
from dockwise.operators import trips as TR
from dockwise.sources import (
    drop_unused_trip_columns,
    flatten_snapshots,
    read_snapshot_lines,
    read_snapshots,
    read_trip_lines,
    read_trips,
    trip_fields,
)
from fixtures import TRIPS
from support import rows

TRIP_KEYS = ["user_type", "user_day_code", "idunplug_station", "idplug_station", "travel_time", "unplug_hourTime"]


def write_trips(path, extra_fields=True):
    with open(path, "w") as f:
        for i, t in enumerate(TRIPS):
            rec = dict(zip(TRIP_KEYS, t))
            if extra_fields:
                rec.update({"_id": f"x{i}", "ageRange": 2, "zip_code": "28001", "idplug_base": 3, "idunplug_base": 4})
            f.write(json.dumps(rec) + "\n")
    return str(path)


def test_trip_readers_agree(spark, tmp_path):
    path = write_trips(tmp_path / "t.json")
    a = trip_fields(read_trips(spark, path))
    b = trip_fields(read_trip_lines(spark, path))
    assert a.columns == TRIP_KEYS
    assert rows(a) == rows(b) == sorted(TRIPS, key=repr)


def test_inferred_schema_then_drop(spark, tmp_path):
    path = write_trips(tmp_path / "t.json")
    inferred = read_trips(spark, path, schema=None)
    assert "ageRange" in inferred.columns
    dropped = drop_unused_trip_columns(inferred)
    assert sorted(dropped.columns) == sorted(TRIP_KEYS)


def test_failfast_and_permissive(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"_id": "h1", "stations": [{"name": "A", "dock_bikes": 1}]}\n{"_id": "h2", "stat\n')
    with pytest.raises(Exception):
        read_snapshots(spark, str(path)).collect()
    with pytest.raises(Exception):
        read_snapshot_lines(spark, str(path)).collect()
    kept = read_snapshots(spark, str(path), mode="PERMISSIVE", corrupt_column="_corrupt").cache()
    assert kept.count() == 2
    bad = kept.where(F.col("_corrupt").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]["_id"] is None
    assert flatten_snapshots(kept.drop("_corrupt")).count() == 1


def test_missing_or_empty_stations_give_no_rows(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"_id": "h1"}\n{"_id": "h2", "stations": []}\n{"_id": "h3", "stations": [{"name": "A"}]}\n')
    flat = flatten_snapshots(read_snapshots(spark, str(path)))
    assert rows(flat, "_id", "name") == [("h3", "A")]


def test_naive_timestamps_ignore_session_zone(spark):
    t = spark.createDataFrame([("2021-06-19T23:30:00Z",)], "unplug_hourTime string")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = TR.with_trip_time(TR.with_trip_date(t)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert (r["trip_date"], r["trip_time"]) == ("2021-06-19", "23:30:00")


def test_time_label_keeps_microseconds(spark):
    t = spark.createDataFrame([("2021-06-19T08:05:09.250000Z",), ("2021-06-19T08:05:09X",)], "s string")
    got = [r[0] for r in t.select(C.iso_time(C.unplug_timestamp("s"))).collect()]
    assert got == ["08:05:09.250000", "08:05:09"]


def test_half_even_bins_python(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("v"))
    got = df.select("v", C.half_even_bin("v", 100).alias("b")).where(
        F.col("b") != F.bround(F.col("v"), -2) / 100
    )
    assert got.count() == 0
    sample = [50, 150, 250, 4050, 4051, 19999, 149, 151]
    res = {r["v"]: r["b"] for r in df.where(F.col("v").isin(sample)).select("v", C.half_even_bin("v", 100).alias("b")).collect()}
    assert res == {v: round(v, -2) / 100 for v in sample}


def test_settings_for_shuffle():
    from dockwise.session import settings_for_shuffle

    big = settings_for_shuffle(10**12)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-(10**12) // (256 << 20))
    assert settings_for_shuffle(10**6)["spark.sql.shuffle.partitions"] == "200"


def test_counting_parses_every_line(spark, tmp_path):
    from dockwise.operators.core import count_rows
    from dockwise.sources.json_lines import read_trip_lines

    good = tmp_path / "good.json"
    good.write_text('{"user_type": 1, "travel_time": 5}\n\n{"user_type": 2}\n')
    assert count_rows(read_trip_lines(spark, str(good))).first()["n"] == 2  # blank lines give no row
    bad = tmp_path / "bad.json"
    bad.write_text('{"user_type": 1, "travel_time": 5}\n{"user_type": 1, "trav\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        count_rows(read_trip_lines(spark, str(bad))).collect()


def test_checkpoint_folder_must_be_named(spark):
    from types import SimpleNamespace

    from dockwise.session import checkpoint_dir

    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError):
        checkpoint_dir(unset)


def test_labels_match_python_isoformat(spark):
    import random
    from datetime import datetime, timedelta

    rng = random.Random(7)
    base = datetime(1999, 12, 31, 23, 0, 0)
    stamps = [base + timedelta(seconds=rng.randint(0, 10**7), microseconds=rng.choice([0, 0, 1, 250000, 999999]))
              for _ in range(300)]
    raw = [(s.isoformat() + "Z",) for s in stamps]
    df = spark.createDataFrame(raw, "s string")
    ts = C.unplug_timestamp("s")
    got = [(r[0], r[1]) for r in df.select(C.iso_date(ts), C.iso_time(ts)).collect()]
    assert got == [(s.date().isoformat(), s.time().isoformat()) for s in stamps]


def test_half_even_bins_other_widths(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("v"))
    for width in (60, 250):
        got = {r["v"]: r["b"] for r in df.select("v", C.half_even_bin("v", width).alias("b")).collect()}
        assert got == {v: float(round(v / width)) for v in range(5000)}
