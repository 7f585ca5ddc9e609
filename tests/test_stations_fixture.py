"""Station reports on the hand-worked snapshot table, read back from JSON Lines."""

import json

import pytest
from pyspark.sql import functions as F

from dockwise.operators import stations as ST
from dockwise.sources import flatten_snapshots, read_snapshot_lines, read_snapshots
from fixtures import SNAPSHOTS, nested_snapshots_df, station_dict
from support import as_dict, rows


def write_snapshot_lines(path, data=SNAPSHOTS):
    with open(path, "w") as f:
        for hour, stations in data:
            f.write(json.dumps({"_id": hour, "stations": [station_dict(*s) for s in stations]}) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def snap(spark, tmp_path_factory):
    path = write_snapshot_lines(tmp_path_factory.mktemp("snap") / "snap.json")
    return flatten_snapshots(read_snapshots(spark, path)).cache()


def names(df):
    return sorted(r["name"] for r in df.collect())


def test_both_readers_and_in_memory_agree(spark, snap, tmp_path):
    path = write_snapshot_lines(tmp_path / "s.json")
    cols = ["_id", "name", "activate", "total_bases", "free_bases", "reservations_count", "dock_bikes"]
    by_text = flatten_snapshots(read_snapshot_lines(spark, path)).select(*cols)
    in_memory = flatten_snapshots(nested_snapshots_df(spark)).select(*cols)
    assert rows(by_text) == rows(snap.select(*cols)) == rows(in_memory)


def test_rows_per_hour(snap):
    assert snap.count() == 9  # h3 has no stations, so no rows
    assert as_dict(ST.stations_per_hour(snap), "_id") == {"h1": 3, "h2": 3, "h4": 3}
    assert ST.avg_stations_per_hour(snap).first()["avg_stations"] == 3.0


def test_activation(snap):
    assert as_dict(ST.activation_counts(snap), "activate") == {1: 8, 0: 1}
    assert rows(ST.inactive_stations(snap)) == [("h4", "B")]


def test_one_station(snap):
    assert rows(ST.station_capacity(snap)) == [("Miguel Moya", 24)]
    assert rows(ST.station_dock_series(snap)) == [("h1", 3), ("h2", 0), ("h4", 24)]
    assert rows(ST.station_empty_hours(snap)) == [("h2",)]


def test_broken(snap):
    assert names(ST.broken_stations(snap)) == ["B"]
    assert ST.broken_station_count(snap).first()["n"] == 1
    assert names(ST.never_broken_stations(snap)) == ["A", "Miguel Moya"]
    assert rows(ST.broken_log(snap)) == [("B", "h2", 1)]


def test_occupancy_range(snap):
    assert names(ST.occupancy_range_stations(snap, 1, 2)) == ["A"]
    assert ST.occupancy_range_count(snap, 1, 2).first()["n"] == 1
    assert rows(ST.occupancy_range_log(snap, 1, 2)) == [("A", "h1", 2), ("A", "h4", 1)]
    assert names(ST.never_in_range_stations(snap, 1, 2)) == ["B", "Miguel Moya"]


def test_empty(snap):
    assert names(ST.empty_stations(snap)) == ["A", "Miguel Moya"]
    assert ST.empty_station_count(snap).first()["n"] == 2
    assert names(ST.never_empty_stations(snap)) == ["B"]
    assert rows(ST.empty_log(snap)) == [("A", "h2", 0), ("Miguel Moya", "h2", 0)]
    # as the reference's code is written, this step repeats the range filter
    assert rows(ST.empty_log(snap, as_written=True)) == rows(ST.occupancy_range_log(snap))


def test_reservations(snap):
    assert as_dict(ST.reservation_value_counts(snap), "reservations_count") == {0: 6, 1: 2, 2: 1}
    assert names(ST.reserved_stations(snap)) == ["A", "B", "Miguel Moya"]
    assert ST.reserved_station_count(snap).first()["n"] == 3
    assert rows(ST.reservation_log(snap)) == [("A", "h4", 2), ("B", "h2", 1), ("Miguel Moya", "h1", 1)]
    assert ST.reserved_station_pct(snap).first()["pct"] == 100.0
    assert ST.reserved_station_pct(snap, total=264).first()["pct"] == pytest.approx(300 / 264)


def test_full(snap):
    assert names(ST.full_stations(snap)) == ["B", "Miguel Moya"]
    assert ST.full_station_count(snap).first()["n"] == 2
    assert rows(ST.full_log(snap)) == [("B", "h1"), ("B", "h4"), ("Miguel Moya", "h4")]
    assert as_dict(ST.full_hours_per_station(snap), "name") == {"B": 2, "Miguel Moya": 1}


def test_heavy_use(snap):
    assert names(ST.heavy_use_stations(snap)) == ["A", "Miguel Moya"]
    assert ST.heavy_use_count(snap).first()["n"] == 2
    assert rows(ST.heavy_use_log(snap)) == [
        ("A", "h1", 0.8),
        ("A", "h2", 1.0),
        ("Miguel Moya", "h1", 0.8333333333333334),
        ("Miguel Moya", "h2", 1.0),
    ]
    strict = rows(ST.heavy_use_log(snap, inclusive=False))
    assert strict == [("A", "h2", 1.0), ("Miguel Moya", "h1", 0.8333333333333334), ("Miguel Moya", "h2", 1.0)]
    assert rows(ST.heavy_use_full_hours(snap)) == [("Miguel Moya", "h4")]


def test_dock_histogram(snap):
    assert as_dict(ST.dock_histogram(snap), "dock_bikes") == {0: 2, 1: 1, 2: 1, 3: 1, 7: 1, 10: 2, 24: 1}


def test_zero_capacity_station(spark):
    data = [(h, s + [("Z", 0, 0, 0, 0, 1)]) if h == "h1" else (h, s) for h, s in SNAPSHOTS]
    snap = flatten_snapshots(nested_snapshots_df(spark, data))
    assert "Z" in names(ST.empty_stations(snap))
    assert "Z" in names(ST.full_stations(snap))
    assert "Z" in names(ST.heavy_use_stations(snap))
    z = ST.heavy_use_log(snap).where(F.col("name") == "Z").collect()
    assert [(r["_id"], r["free_ratio"]) for r in z] == [("h1", None)]


def test_grouped_logs_match_long(snap):
    grouped = ST.full_log(snap, grouped=True)
    assert grouped.columns == ["name", "page", "log"]
    got = {}
    for r in sorted(grouped.collect(), key=lambda r: (r["name"], r["page"])):
        got.setdefault(r["name"], []).extend(e["_id"] for e in r["log"])
    assert got == {"B": ["h1", "h4"], "Miguel Moya": ["h4"]}


def _hot_log(spark, n=5000):
    # One station holds 90% of the rows; a few rows have no station name.
    return spark.range(0, n).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("S"), (F.col("id") % 7).cast("string")))
        .when(F.col("id") == 7, F.lit(None))
        .otherwise(F.lit("HOT"))
        .alias("name"),
        F.format_string("h%05d", F.col("id") % 1700).alias("_id"),
        (F.col("id") % 3).alias("dock_bikes"),
    )


def test_pages_match_row_number_and_are_bounded(spark):
    from pyspark.sql import Window
    from dockwise.operators.core import log_pages

    long = _hot_log(spark)
    collected = log_pages(long, "name", page_size=100).collect()
    sizes = [len(r["log"]) for r in collected]
    assert max(sizes) <= 100 and sum(sizes) == 5000
    got = sorted(
        (r["name"] or "", r["page"], i, e["_id"], e["dock_bikes"])
        for r in collected
        for i, e in enumerate(r["log"])
    )
    w = Window.partitionBy("name").orderBy("_id", "dock_bikes")
    truth = long.select("*", (F.row_number().over(w) - 1).alias("rn"))
    want = sorted(
        (r["name"] or "", r["rn"] // 100, r["rn"] % 100, r["_id"], r["dock_bikes"]) for r in truth.collect()
    )
    assert got == want
    assert sum(1 for r in collected if r["name"] == "HOT") == 45  # 4499 entries, pages of 100


def test_pages_do_not_depend_on_partitions_or_exchange_reuse(spark):
    from dockwise.operators.core import log_pages

    def pages(**conf):
        before = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            got = log_pages(_hot_log(spark, 3000), "name", page_size=64).collect()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        return sorted((r["name"] or "", r["page"], tuple(tuple(e) for e in r["log"])) for r in got)

    want = pages()
    assert pages(**{"spark.sql.shuffle.partitions": "3"}) == want
    assert pages(**{"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.enabled": "false"}) == want


def test_pages_shuffle_the_log_once(spark):
    from dockwise.operators.core import log_pages

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = log_pages(_hot_log(spark, 2000), "name")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "rangepartitioning" not in plan
    # Rows of the log move by (key, day) only; counts and finished arrays are other exchanges.
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_day" in line for line in moves) == 2  # the log, and its counts
    assert len(moves) == 4  # those, the counts by key, and the arrays by page


def test_snapshot_preview_is_ordered(snap):
    got = ST.snapshot_preview(snap, 4).collect()
    assert [(r["_id"], r["name"]) for r in got] == [("h1", "A"), ("h1", "B"), ("h1", "Miguel Moya"), ("h2", "A")]
