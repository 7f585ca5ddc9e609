"""Shape of the physical plans of every registered query."""

import pytest

from dockwise.plans import catalog
from support import SF_SMALL, rows

# lineitem columns no report derives anything from
UNUSED = ("l_discount", "l_tax", "l_returnflag", "l_linestatus")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.REGISTRY))
def test_plan_shape(spark, name):
    df = catalog.REGISTRY[name].build(spark, SF_SMALL)
    plan = plan_text(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad} in plan"
    read = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert read, name
    for col in UNUSED:
        assert col not in "\n".join(read), f"{name} reads {col}"


def test_explicit_broadcast_is_one_row_aggregate(spark):
    # The only broadcast hint in the library is on a global min: exactly one row.
    df = catalog.REGISTRY["least_departures_station"].build(spark, SF_SMALL)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("strategy=broadcast") == 1
    lines = logical.splitlines()
    assert "rightHint=(strategy=broadcast)" in lines[0]
    right = next(i for i, line in enumerate(lines) if line.startswith("+- "))
    first_aggregate = next(line for line in lines[right:] if "Aggregate" in line)
    assert "Aggregate [min(" in first_aggregate  # no grouping keys: one row


def test_filters_reach_the_scan(spark, tmp_path):
    # On a stored flat table, report predicates become Parquet pushed filters.
    from dockwise.operators import trips as TR
    from dockwise.sources.flat_table import read_flat_trips, write_flat_trips
    from fixtures import trips_df

    path = str(tmp_path / "trips")
    write_flat_trips(trips_df(spark), path)
    flat = read_flat_trips(spark, path)
    plan = plan_text(TR.long_trip_count(flat))
    assert "GreaterThanOrEqual(travel_time,1800)" in plan
    assert "ReadSchema: struct<travel_time:bigint>" in plan


@pytest.mark.parametrize("name", list(catalog.REGISTRY))
def test_aggregates_combine_map_side(spark, name):
    # Every count/sum/avg/min/max is split into a partial (map-side) and a final
    # step, so a key with a large share of the rows is reduced before the shuffle.
    plan = plan_text(catalog.REGISTRY[name].build(spark, SF_SMALL))
    for fn in ("count", "sum", "avg", "min", "max"):
        finals = plan.count(f"functions=[{fn}(")
        if finals:
            assert f"partial_{fn}(" in plan, f"{name}: {fn} without a partial step"


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.1"])
def test_no_query_repartitions_its_scan(spark, sf_dir):
    # The same source plan at every size.
    for name, q in catalog.REGISTRY.items():
        plan = plan_text(q.build(spark, sf_dir))
        assert "REPARTITION" not in plan, name


@pytest.mark.parametrize("name", ["trip_rows", "snapshot_rows"])
def test_row_counts_parse(spark, name):
    assert "from_json" in plan_text(catalog.REGISTRY[name].build(spark, SF_SMALL))


def test_trips_without_origin_count_as_a_station(spark):
    from dockwise.operators import trips as TR
    from fixtures import trips_df

    data = [(1, "a", 10, 20, 60, "2021-06-19T08:00:00Z")] * 2 + [(1, "b", None, 20, 61, "2021-06-19T08:00:00Z")]
    t = trips_df(spark, data)
    assert rows(TR.least_departures_station(t)) == [(None, 1)]
    assert rows(TR.trips_from_least_station(t)) == [("b", 20, 61)]


def test_least_station_join_reuses_the_counts(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_text(catalog.REGISTRY["trips_from_least_station"].build(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "ReusedExchange" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_semi_joins_with_a_hot_key(spark):
    from pyspark.sql import functions as F

    from dockwise.operators import core

    hot = spark.range(30000).select(F.when(F.col("id") % 10 < 9, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    keys = hot.select("k").distinct().where("k % 2 = 1")
    want = hot.where("k % 2 = 1").count()
    few = core.semi_join(hot, keys, "k")
    assert "BroadcastExchange" in plan_text(few) and few.count() == want
    # More keys than the bound: no hint; the shuffled join gives the same rows.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = core.semi_join(hot, keys, "k", broadcast_rows=10)
        assert "BroadcastExchange" not in plan_text(many) and many.count() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_and_time_labels_agree_on_derived_and_flat_trips(spark, tmp_path):
    import datetime

    from dockwise.operators import trips as TR
    from dockwise.sources.flat_table import read_flat_trips, write_flat_trips
    from fixtures import trips_df

    stored, flat = str(tmp_path / "stored"), str(tmp_path / "flat")
    trips_df(spark).write.parquet(stored)
    write_flat_trips(trips_df(spark), flat)
    plain, flat = spark.read.parquet(stored), read_flat_trips(spark, flat)
    for date in ("2021-06-19", datetime.date(2021, 6, 19), "2021-06", "nonsense"):
        assert rows(TR.trips_on_date(plain, date)) == rows(TR.trips_on_date(flat, date)), date
    assert TR.trip_count_on_date(plain, datetime.date(2021, 6, 19)).first()["n"] == 4
    for times in (("15:00:00",), ("15:00:00.000000",), (datetime.time(15),), ("15",)):
        assert rows(TR.trips_in_hours(plain, times)) == rows(TR.trips_in_hours(flat, times)), times
    assert "StringStartsWith(unplug_hourTime,2021-06-19)" in plan_text(TR.trips_on_date(plain, "2021-06-19"))


def test_flat_files_are_sorted(spark, tmp_path):
    import pyarrow.parquet as pq

    from dockwise.sources import derived
    from dockwise.sources.flat_table import write_flat_trips

    path = tmp_path / "trips"
    write_flat_trips(derived.trips_from_lineitem(derived.load_lineitem(spark, SF_SMALL)), str(path))
    files = list(path.glob("*/*.parquet"))
    assert files
    for f in files:
        dates = pq.read_table(f, columns=["trip_date"], partitioning=None).column(0).to_pylist()
        assert dates == sorted(dates)
