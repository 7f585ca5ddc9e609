"""Staged files, quarantine, inference, sketches, rollups and hour bitmaps on small hand-made data."""

import datetime
import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dockwise.operators import core
from dockwise.operators import hour_bitmaps as HB
from dockwise.operators import sketches as SK
from dockwise.operators import stations as ST
from dockwise.plans import catalog
from dockwise.schemas import SNAPSHOT, SNAPSHOT_REPORT_COLUMNS, TRIP, TRIP_COLUMNS
from dockwise.session import input_version, scratch_path, staged_once
from dockwise.sources import derived, inference, quarantine, rollup_table, staged_lines
from support import SF_SMALL, as_dict, rows

# ---------------------------------------------------------------- staged files


def test_lines_are_staged_once_per_version(spark, tmp_path):
    table, calls = str(tmp_path / "t"), []
    spark.range(5).write.parquet(table)

    def write(path):
        calls.append(path)
        spark.read.parquet(table).write.parquet(path)

    first = staged_once(spark, "test-once", table, write)
    assert staged_once(spark, "test-once", table, write) == first and len(calls) == 1
    before = input_version(spark, table)
    spark.range(5).write.mode("append").parquet(table)
    assert input_version(spark, table) != before
    second = staged_once(spark, "test-once", table, write)
    assert second != first and spark.read.parquet(second).count() == 10


def test_staged_file_is_read_by_byte_ranges(spark):
    path = staged_lines.trip_file(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    n = spark.read.text(path).count()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        split = spark.read.text(path)
        # One text file, as lineitem is one row group, and many tasks.
        assert split.rdd.getNumPartitions() > 4 and split.count() == n
        assert split.select(F.from_json("value", TRIP, {"mode": "FAILFAST"}).alias("r")).where("r.user_type IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_long_feeds_are_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    lines = derived.faulty_trip_lines(derived.load_lineitem(spark, SF_SMALL))
    n = lines.count()
    monkeypatch.setattr(staged_lines, "PLAIN_LINES", n - 1)
    monkeypatch.setattr(staged_lines, "LINES_PER_FILE", 1000)
    path = tmp_path / "lines"
    staged_lines.write_lines(lines, str(path), n)
    files = list(path.glob("part-*.txt.gz"))
    assert len(files) >= n // 1000 and all(spark.read.text(str(f)).count() <= 1000 for f in files)
    assert rows(spark.read.text(str(path))) == rows(lines)
    assert sum(f.stat().st_size for f in files) * 4 < lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]


# ---------------------------------------------------------------- quarantine

GOOD = '{"user_type":1,"user_day_code":"a","idunplug_station":2,"idplug_station":3,"travel_time":60,"unplug_hourTime":"2021-06-19T08:00:00Z"}'


@pytest.mark.parametrize("partitions", [1, 3])
def test_quarantine_sets_each_kind_of_line_aside(spark, partitions):
    lines = [GOOD, GOOD, '{"user_type":1,', "", " \t", "[" + GOOD + "]", "null", "12", '{"user_type":"x"}', '{"user_type":2}', "{}", "no json", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(partitions)
    out = quarantine.split_lines(df, TRIP, scratch_path(spark, f"test-quarantine-{random.random()}"))
    assert out.counts == {"lines": 12, "blank": 2, "good": 4, "broken": 6}
    assert out.good.count() == 4 and out.good.columns == list(TRIP_COLUMNS)
    assert Counter(r["user_type"] for r in out.good.collect()) == Counter([1, 1, 2, None])
    assert as_dict(out.broken, "broken_line", "reason") == {
        '{"user_type":1,': "malformed", "no json": "malformed", "[" + GOOD + "]": "not an object",
        "null": "not an object", "12": "not an object", '{"user_type":"x"}': "field type",
    }


def test_quarantine_without_broken_lines_and_of_nothing(spark):
    for lines, good in (([GOOD] * 3, 3), ([], 0)):
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        out = quarantine.split_lines(df, TRIP, scratch_path(spark, f"test-quarantine-{random.random()}"))
        assert out.counts == {"lines": good, "blank": 0, "good": good, "broken": 0}
        assert out.good.count() == good and out.broken.count() == 0


def test_reading_one_output_prunes_the_other(spark):
    df = spark.createDataFrame([(GOOD,), ("{",)], "value string")
    out = quarantine.split_lines(df, TRIP, scratch_path(spark, f"test-quarantine-{random.random()}"))
    plan = out.broken._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(broken" in plan


# ---------------------------------------------------------------- inference


def plain_report(lines, depth=6):
    """Counts per (path, kind) and objects per path, value by value."""
    import decimal

    kinds, parents = Counter(), {}

    def kind(v):
        if v is None:
            return "VOID"
        for t, name in ((bool, "BOOLEAN"), (int, "BIGINT"), (decimal.Decimal, "DECIMAL"), (str, "STRING"), (dict, "OBJECT"), (list, "ARRAY")):
            if isinstance(v, t):
                return name

    def walk(path, parent, v, left):
        kinds[path, kind(v)] += 1
        parents[path] = parent
        if left and isinstance(v, dict):
            for k, x in v.items():
                walk(f"{path}.{k}", path, x, left - 1)
        elif left and isinstance(v, list):
            for x in v:
                walk(f"{path}[]", None, x, left - 1)

    for line in lines:
        if line is None or not line.strip():
            continue
        try:
            walk("$", None, json.loads(line, parse_float=decimal.Decimal), depth)
        except ValueError:
            kinds["$", "INVALID"] += 1
            parents["$"] = None
    out = {}
    for path in parents:
        n = sum(c for (p, _), c in kinds.items() if p == path)
        parent = parents[path]
        missing = kinds[parent, "OBJECT"] - n if parent else 0
        out[path] = (n, kinds[path, "VOID"], missing, ",".join(sorted(k for p, k in kinds if p == path)))
    return out


def test_field_report_equals_walking_every_value(spark):
    rng = random.Random(4)

    def value(level):
        pick = rng.random()
        if pick < 0.25 and level:
            return {k: value(level - 1) for k in rng.sample(["a", "b", "c.d"], rng.randint(0, 3))}
        if pick < 0.4 and level:
            return [value(level - 1) for _ in range(rng.randint(0, 3))]
        return rng.choice([None, 1, 2.5, "x", True, ""])

    lines = [json.dumps({k: value(3) for k in rng.sample(["u", "v", "w"], rng.randint(0, 3))}) for _ in range(300)]
    lines += ["{", "", "  ", None, "7", "null", '[{"u":1}]']
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(4)
    for depth in (1, 6):
        got = inference.field_report(df, TRIP, depth=depth).where("n > 0").collect()
        assert {r["path"]: (r["n"], r["nulls"], r["missing"], r["kinds"]) for r in got} == plain_report(lines, depth)
        assert len(got) == len({r["path"] for r in got})


def test_drift_against_the_declared_schema(spark):
    lines = [
        '{"user_type":1,"user_day_code":"a","travel_time":null,"idplug_station":1}',
        '{"user_type":2.5,"user_day_code":3,"idplug_station":1e3,"extra":[1,"x"]}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["path"]: r for r in inference.field_report(df, TRIP).collect()}
    drift = {p: r["drift"] for p, r in got.items()}
    assert drift == {
        "$": "", "$.user_type": "type", "$.user_day_code": "", "$.travel_time": "", "$.idplug_station": "type",
        "$.extra": "undeclared", "$.extra[]": "undeclared", "$.idunplug_station": "absent", "$.unplug_hourTime": "absent",
    }
    assert got["$.user_type"]["inferred"] == "DECIMAL" and got["$.extra[]"]["inferred"] == "STRING"
    assert got["$.user_day_code"]["kinds"] == "BIGINT,STRING" and got["$.travel_time"]["missing"] == 1
    empty = inference.field_report(df.limit(0), SNAPSHOT).collect()
    assert {r["drift"] for r in empty} == {"absent"} and len(empty) == len(inference.declared_paths(SNAPSHOT))


# ---------------------------------------------------------------- sketches


def test_distinct_sketches_answer_any_period(spark):
    df = spark.range(60_000).select(
        F.concat(F.lit("2021-06-"), F.lpad((F.col("id") % 30 + 1).cast("string"), 2, "0")).alias("day"),
        F.when(F.col("id") % 1000 == 7, None).otherwise(F.col("id") % 9000).alias("user"),
    )
    sketches = SK.distinct_sketches(df, "day", "user")
    assert sketches.count() == 30
    for first, last in ((None, None), ("2021-06-03", "2021-06-11"), ("2021-06-30", None), (None, "2021-06-01")):
        part = df.where(F.col("day").between(first or "", last or "z"))
        exact = core.count_distinct_where(part, F.lit(True), "user").first()["n"]
        got = SK.distinct_between(sketches, first, last).first()["n"]
        assert abs(got - exact) <= 4 * SK.distinct_error() * exact + 1, (first, last)
    assert SK.distinct_between(sketches, "2022-01-01", None).first()["n"] == 0
    by_half = as_dict(SK.distinct_by_period(sketches, F.col("day") < "2021-06-16"), "period")
    assert set(by_half) == {True, False}


@pytest.mark.parametrize("slots", [8, 50, 10_000])
def test_top_values_are_exact_however_small_the_sketch(spark, slots):
    rng = random.Random(slots)
    data = [(f"d{rng.randint(0, 3)}", rng.choice([1, 1, 1, 2, 2, None]) if rng.random() < 0.5 else rng.randint(3, 400)) for _ in range(4000)]
    df = spark.createDataFrame(data, "day string, item long").repartition(5)
    sketches = SK.frequent_sketches(df, "day", "item", slots)
    counts = Counter(x for _, x in data)
    for k in (1, 3, 40):
        want = sorted(counts.items(), key=lambda c: (-c[1], c[0] is not None, c[0] or 0))[:k]
        assert [(r["item"], r["n"]) for r in SK.top_values(df, sketches, "item", k, slots).collect()] == want
    none = df.limit(0)
    assert SK.top_values(none, SK.frequent_sketches(none, "day", "item", slots), "item", 3, slots).collect() == []


# ---------------------------------------------------------------- rollups


def trip_rows(seed, months=("2021-05", "2021-06", "2021-07"), n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        when = None if rng.random() < 0.02 else f"{rng.choice(months)}-{rng.randint(1, 28):02d}T{rng.randint(0, 23):02d}:00:00Z"
        out.append((rng.randint(1, 3), f"u{i}", 1, 2, None if rng.random() < 0.05 else rng.randint(10, 900), when))
    return out


def test_rollup_counts_replaced_and_repeated_months_once(spark, tmp_path):
    path, schema = str(tmp_path / "rollup"), TRIP
    may_june, july = trip_rows(1, ("2021-05", "2021-06")), trip_rows(2, ("2021-07",))
    june_again = trip_rows(3, ("2021-06",))
    frame = lambda r: spark.createDataFrame([x for x in r if x[5]], schema)
    for load in (may_june, july, may_june, june_again, june_again):
        rollup_table.replace_months(rollup_table.partials(frame(load)), path)
    final = [x for x in may_june + july + june_again if x[5]]
    final = [x for x in final if x[5][:7] != "2021-06"] + [x for x in june_again if x[5]]
    rollup = rollup_table.read_rollup(spark, path)
    assert as_dict(rollup_table.trips_per_day(rollup), "trip_date") == Counter(x[5][:10] for x in final)
    assert as_dict(rollup_table.trips_per_time(rollup), "trip_time") == Counter(x[5][11:19] for x in final)
    timed = defaultdict(list)
    for x in final:
        timed[x[5][:7]] += [] if x[4] is None else [x[4]]
    got = {r["trip_month"]: (r["mean_s"], r["min_s"], r["max_s"]) for r in rollup_table.trips_per_month(rollup).collect()}
    assert got == {m: (sum(v) / len(v), min(v), max(v)) for m, v in timed.items()}


def test_rollup_of_trips_without_a_time(spark, tmp_path):
    path = str(tmp_path / "rollup")
    trips = spark.createDataFrame(trip_rows(5), TRIP)
    rollup_table.replace_months(rollup_table.partials(trips), path)
    rollup = rollup_table.read_rollup(spark, path)
    direct = Counter(x[5][:10] if x[5] else None for x in trip_rows(5))
    assert as_dict(rollup_table.trips_per_day(rollup), "trip_date") == direct
    assert rollup.agg(F.sum("n")).first()[0] == 300


# ---------------------------------------------------------------- bitmaps


def snapshot_rows(seed=3):
    rng, out = random.Random(seed), []
    start = datetime.datetime(1999, 12, 30)
    for _ in range(1500):
        at = start + datetime.timedelta(hours=rng.choice([0, 1, 2, 3, 47, 32767, 32768, 40000, 70000]) + rng.randint(0, 20))
        total = rng.randint(0, 4)
        docked = rng.randint(0, total)
        free = rng.randint(0, total - docked)
        name = rng.choice(["a", "b", "c", None])
        if name == "c" and docked == 0:
            docked = 1  # never empty
        out.append((at.strftime("%Y-%m-%dT%H:%M:%S"), name, 1, 1, total, free, 0, docked))
    return out


@pytest.mark.parametrize("interval", [(None, None), ("1999-12-30T01:00:00", "2003-09-27T00:00:00"), (None, "1999-12-30T00:00:00"), ("2007-01-01T00:00:00", None)])
def test_bitmaps_equal_sets_of_hours(spark, interval):
    data = snapshot_rows()
    snap = spark.createDataFrame(data, ", ".join(f"{c} {'string' if c in ('_id', 'name') else 'long'}" for c in SNAPSHOT_REPORT_COLUMNS))
    maps = HB.hour_bitmaps(snap.repartition(5))
    first, last = interval
    inside = [r for r in data if (first or "") <= r[0] <= (last or "z")]
    tests = {
        "seen": lambda r: True, "broken": lambda r: r[4] > r[5] + r[6] + r[7], "empty": lambda r: r[7] == 0, "in_range": lambda r: 1 <= r[7] <= 2,
        "full": lambda r: r[7] == r[4], "reserved": lambda r: r[6] > 0, "heavy": lambda r: r[5] >= 0.8 * r[4],
    }
    want = {n: tuple(len({r[0] for r in inside if r[1] == n and t(r)}) for t in tests.values()) for n in {r[1] for r in inside}}
    got = {r["name"]: tuple(r[k] for k in tests) for r in HB.hours_where(maps, first, last).collect()}
    assert got == want
    never = {r["name"] for r in HB.never(maps, "empty", first, last).collect()}
    assert never == {n for n, c in want.items() if c[2] == 0}
    assert as_dict(HB.complement_hours(maps, "full", first, last), "name") == {n: c[0] - c[4] for n, c in want.items()}
    if interval == (None, None):
        assert rows(HB.never(maps, "broken")) == rows(ST.never_broken_stations(snap))


def test_bitmaps_of_nothing(spark):
    snap = catalog.snapshots(spark, SF_SMALL).limit(0)
    maps = HB.hour_bitmaps(snap)
    assert maps.collect() == [] and HB.never(maps, "empty").collect() == [] and HB.hours_where(maps, "1990-01-01T00:00:00").collect() == []


def test_bitmaps_of_many_stations_take_rows_of_longs(spark):
    """A station seen once costs one narrow row, hashed: no bitmap of years per station, task and condition."""
    data = [(f"2000-01-0{1 + i % 3}T{i % 24:02d}:00:00", f"s{i % 2000}", 1, 1, 4, 1, 0, i % 5) for i in range(4000)]
    snap = spark.createDataFrame(data, ", ".join(f"{c} {'string' if c in ('_id', 'name') else 'long'}" for c in SNAPSHOT_REPORT_COLUMNS))
    maps = HB.hour_bitmaps(snap)
    assert {t for n, t in maps.dtypes if n != "name"} == {"bigint"} and maps.count() <= len(data)
    assert rows(HB.hour_bitmaps(snap, partitions=5)) == rows(maps)
    for made in (maps, HB.hours_where(maps, "2000-01-01T05:00:00", "2000-01-02T23:00:00")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Sort [" not in plan
    assert HB.hours_where(maps, "2000-01-03T05:00:00", "2000-01-03T05:00:00").agg(F.sum("seen")).first()[0] == len({r[1] for r in data if r[0] == "2000-01-03T05:00:00"}) > 0


# ---------------------------------------------------------------- pages


def test_pages_scan_the_log_once(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.REGISTRY["broken_log_pages"].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_faulty_and_drifting_lines_follow_their_rules(spark):
    items = derived.load_lineitem(spark, SF_SMALL)
    n = items.count()
    assert derived.faulty_trip_lines(items).count() == n
    parsed = derived.drifting_trip_lines(items).select(F.from_json("value", "plan struct<name:string,price:double>, zip_code string", {"mode": "FAILFAST"}).alias("r"))
    assert parsed.where("r.plan IS NOT NULL").count() == items.where("l_orderkey % 13 = 0").count()
    assert parsed.where("r.zip_code IS NULL").count() == items.where("l_orderkey % 7 = 0").count()
