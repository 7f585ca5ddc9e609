"""Queries on what the library stores: JSON Lines files, quarantined lines, sketches, rollups and
hour bitmaps, each derived from the folder's `lineitem` and written to the shared folder.

Files and states are staged once per application and input version (`session.staged_once`), as a
warehouse would keep them; queries read them. Quarantine writes its two outputs on every call.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.operators import hour_bitmaps as HB
from dockwise.operators import sketches as SK
from dockwise.operators.trips import with_trip_date
from dockwise.plans.oracle import TRIP_COLS, on_snap, on_trips
from dockwise.schemas import SNAPSHOT, SNAPSHOT_REPORT_COLUMNS, TRIP
from dockwise.session import scratch_path, staged_once
from dockwise.sources import derived, inference, quarantine, rollup_table, staged_lines
from dockwise.sources.json_lines import (
    flatten_snapshots,
    read_snapshot_lines,
    read_snapshots,
    read_trip_lines,
    read_trips,
    trip_fields,
)

Register = Callable[[str, str, str | None, Callable[[SparkSession, str], DataFrame]], None]

INTERVAL = ("1994-03-01T00:00:00", "1997-08-31T23:00:00")
REPLACED = ("1995-05", "1996-11")  # months that are loaded wrongly at first


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    return derived.load_lineitem(spark, d)


def _trips(spark: SparkSession, d: str) -> DataFrame:
    return derived.trips_from_lineitem(_lineitem(spark, d))


def _stored(spark: SparkSession, d: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table made once from the folder's `lineitem` and read back."""
    path = staged_once(spark, name, f"{d.rstrip('/')}/lineitem.parquet", lambda p: make().write.parquet(p))
    return spark.read.parquet(path)


# ---------------------------------------------------------------- quarantine


def _split(spark: SparkSession, d: str) -> quarantine.SplitLines:
    path = scratch_path(spark, f"quarantine-{uuid.uuid4().hex}")
    return quarantine.split_lines(spark.read.text(staged_lines.faulty_trip_file(spark, d)), TRIP, path)


def quarantine_counts(spark: SparkSession, d: str) -> DataFrame:
    """Observed counts beside the rows of both outputs: `lines, blank, good, broken, good_rows, broken_rows`."""
    out = _split(spark, d)
    seen = [F.lit(out.counts[k]).cast("bigint").alias(k) for k in ("lines", "blank", "good", "broken")]
    rows = out.good.agg(F.count(F.lit(1)).alias("good_rows"), F.lit(0).cast("bigint").alias("broken_rows")).unionByName(
        out.broken.agg(F.lit(0).cast("bigint").alias("good_rows"), F.count(F.lit(1)).alias("broken_rows"))
    )
    return rows.agg(F.sum("good_rows").alias("good_rows"), F.sum("broken_rows").alias("broken_rows")).select(*seen, "good_rows", "broken_rows")


# `line` is the trip as JSON text, written independently of the Spark side.
_LINE_CTE = """raw AS (
  SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS user_type, CAST(l_orderkey AS VARCHAR) AS user_day_code,
         CAST(l_suppkey + 1 AS BIGINT) AS idunplug_station,
         CAST(CASE WHEN l_partkey % 10 = 0 THEN l_suppkey + 1 ELSE l_partkey % 100 + 1 END AS BIGINT) AS idplug_station,
         CASE WHEN l_orderkey % 50 = 0 THEN CAST(floor(l_extendedprice) AS BIGINT)
              ELSE CAST(floor(l_extendedprice) AS BIGINT) % 4500 END AS travel_time,
         strftime(l_shipdate, '%Y-%m-%d') || 'T' || lpad(CAST(CAST(trunc(l_quantity) AS BIGINT) % 24 AS VARCHAR), 2, '0') || ':00:00Z' AS unplug_hourTime,
         l_partkey % 7 AS age, lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0') AS zip, l_partkey % 30 + 1 AS pb, l_suppkey % 30 + 1 AS ub, l_linenumber AS ln
  FROM lineitem),
lined AS (
  SELECT *, '{"user_type":' || user_type || ',"user_day_code":"' || user_day_code || '","idunplug_station":' || idunplug_station
         || ',"idplug_station":' || idplug_station || ',"travel_time":' AS head,
         ',"unplug_hourTime":"' || unplug_hourTime || '","_id":"' || k || '-' || ln || '","ageRange":' || age || ',"zip_code":"' || zip
         || '","idplug_base":' || pb || ',"idunplug_base":' || ub || '}' AS tail,
         CASE WHEN k % 31 = 0 THEN 'malformed' WHEN k % 37 = 0 THEN 'field type' WHEN k % 41 = 0 THEN 'blank'
              WHEN k % 43 = 0 THEN 'not an object' ELSE '' END AS fault
  FROM raw),
faulty AS (
  SELECT *, CASE fault WHEN 'malformed' THEN left(head || travel_time || tail, length(head || travel_time || tail) // 2)
                       WHEN 'field type' THEN head || '"soon"' || tail
                       WHEN 'not an object' THEN '[' || head || travel_time || tail || ']' END AS broken_line
  FROM lined)"""

# Counts of the drifting feed by field, from its rule.
_FIELD_SQL = """WITH k AS (SELECT l_orderkey AS k, CASE WHEN l_orderkey % 50 = 0 THEN floor(l_extendedprice) ELSE 1 END AS t FROM lineitem),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE k % 7 = 0) AS z, count(*) FILTER (WHERE k % 11 = 0) AS a,
             count(*) FILTER (WHERE k % 13 = 0) AS p, count(*) FILTER (WHERE k % 26 = 0) AS whole, count(*) FILTER (WHERE k % 17 = 0) AS v FROM k),
f(path, n, nulls, missing, kinds, inferred, declared) AS (
  SELECT '$', n, 0, 0, 'OBJECT', 'OBJECT', 'OBJECT' FROM c
  UNION ALL SELECT '$.' || x, n, 0, 0, y, y, y FROM c, (VALUES ('user_type', 'BIGINT'), ('user_day_code', 'STRING'), ('idunplug_station', 'BIGINT'),
                                                              ('idplug_station', 'BIGINT'), ('unplug_hourTime', 'STRING')) s(x, y)
  UNION ALL SELECT '$.travel_time', n, v, 0, CASE WHEN v > 0 THEN 'BIGINT,VOID' ELSE 'BIGINT' END, 'BIGINT', 'BIGINT' FROM c
  UNION ALL SELECT '$.zip_code', n - z, 0, z, 'STRING', 'STRING', NULL FROM c
  UNION ALL SELECT '$.ageRange', n, 0, 0, 'BIGINT,STRING', 'STRING', NULL FROM c
  UNION ALL SELECT '$.plan', p, 0, n - p, 'OBJECT', 'OBJECT', NULL FROM c
  UNION ALL SELECT '$.plan.name', p, 0, 0, 'STRING', 'STRING', NULL FROM c
  UNION ALL SELECT '$.plan.price', p, 0, 0, CASE WHEN whole = 0 THEN 'DECIMAL' ELSE 'BIGINT,DECIMAL' END, 'DECIMAL', NULL FROM c)
SELECT path, CAST(n AS BIGINT) AS n, CAST(nulls AS BIGINT) AS nulls, CAST(missing AS BIGINT) AS missing, kinds, inferred, declared,
       CASE WHEN declared IS NULL THEN 'undeclared' ELSE '' END AS drift FROM f"""

_STATION_PATHS = "'activate', 'name', 'reservations_count', 'total_bases', 'free_bases', 'dock_bikes', 'id'"
_ABSENT_PATHS = "'light', 'number', 'longitude', 'no_available', 'address', 'latitude'"
_SNAPSHOT_FIELD_SQL = f"""WITH c AS (SELECT count(*) AS n FROM lineitem),
f AS (
  SELECT '$' AS path, n, 'OBJECT' AS kind FROM c UNION ALL SELECT '$._id', n, 'STRING' FROM c
  UNION ALL SELECT '$.stations', n, 'ARRAY' FROM c UNION ALL SELECT '$.stations[]', n, 'OBJECT' FROM c
  UNION ALL SELECT '$.stations[].' || x, n, CASE WHEN x = 'name' THEN 'STRING' ELSE 'BIGINT' END FROM c, (SELECT unnest([{_STATION_PATHS}]) AS x))
SELECT path, n, CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS missing, kind AS kinds, kind AS inferred, kind AS declared, '' AS drift FROM f
UNION ALL
SELECT '$.stations[].' || x, 0, 0, n, '', NULL, CASE WHEN x IN ('light', 'no_available') THEN 'BIGINT' ELSE 'STRING' END, 'absent'
FROM c, (SELECT unnest([{_ABSENT_PATHS}]) AS x)"""


# ---------------------------------------------------------------- sketches, rollups, bitmaps


def _distinct_sketches(spark: SparkSession, d: str) -> DataFrame:
    make = lambda: SK.distinct_sketches(with_trip_date(_trips(spark, d)), "trip_date", "user_day_code")
    return _stored(spark, d, "distinct-users", make)


def distinct_users_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Users per month from daily sketches, held against the exact count: `trip_month, n` (exact),
    and whether the estimate is within four standard errors of it."""
    month = F.substring("trip_date", 1, 7)
    exact = with_trip_date(_trips(spark, d)).select(month.alias("period"), "user_day_code").distinct()
    exact = exact.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    sketched = SK.distinct_by_period(_distinct_sketches(spark, d), F.substring("day", 1, 7)).withColumnRenamed("n", "estimate")
    close = F.abs(F.col("estimate") - F.col("n")) <= F.greatest(F.lit(1.0), F.col("n") * 4 * SK.distinct_error())
    return exact.join(sketched, "period", "full").select(F.col("period").alias("trip_month"), "n", close.alias("within_error"))


def distinct_users_in_interval(spark: SparkSession, d: str) -> DataFrame:
    """The same for one interval of days."""
    first, last = (x[:10] for x in INTERVAL)
    exact = with_trip_date(_trips(spark, d)).where(F.col("trip_date").between(first, last)).agg(F.count_distinct("user_day_code").alias("n"))
    sketched = SK.distinct_between(_distinct_sketches(spark, d), first, last).withColumnRenamed("n", "estimate")
    close = F.abs(F.max("estimate") - F.max("n")) <= F.greatest(F.lit(1.0), F.max("n") * 4 * SK.distinct_error())
    return exact.unionByName(sketched, allowMissingColumns=True).agg(F.max("n").alias("n"), close.alias("within_error"))


def _busiest(column: str) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark: SparkSession, d: str) -> DataFrame:
        trips = _trips(spark, d)
        make = lambda: SK.frequent_sketches(with_trip_date(trips), "trip_date", column)
        return SK.top_values(trips, _stored(spark, d, f"frequent-{column}", make), column, 3)

    return build


def _rollup(spark: SparkSession, d: str) -> DataFrame:
    """All months, of which two are first loaded with a part of their trips, then replaced; the last
    year is appended, and one month written twice."""
    month = F.substring("unplug_hourTime", 1, 7)

    def write(path: str) -> None:
        trips = _trips(spark, d)
        part = trips.where(month.isin(*REPLACED) & (F.col("user_type") % 2 == 0))
        early, late = trips.where((month < "1998") & ~month.isin(*REPLACED)), trips.where((month >= "1998") | month.isNull())
        rollup_table.replace_months(rollup_table.partials(early.unionByName(part)), path)
        rollup_table.replace_months(rollup_table.partials(late), path)
        for again in (REPLACED, REPLACED[:1]):
            rollup_table.replace_months(rollup_table.partials(trips.where(month.isin(*again))), path)

    return rollup_table.read_rollup(spark, staged_once(spark, "trip-rollup", f"{d.rstrip('/')}/lineitem.parquet", write))


def _bitmaps(spark: SparkSession, d: str) -> DataFrame:
    def make() -> DataFrame:
        items = _lineitem(spark, d)
        return HB.hour_bitmaps(derived.snapshots_from_lineitem(items), partitions=items.count() // HB.ROWS_PER_TASK + 1)

    return _stored(spark, d, "hour-bitmaps", make)


_BITS = {
    "broken": "total_bases > free_bases + reservations_count + dock_bikes",
    "empty": "dock_bikes = 0",
    "in_range": "dock_bikes BETWEEN 1 AND 2",
    "full": "dock_bikes = total_bases",
    "reserved": "reservations_count > 0",
    "heavy": "free_bases >= total_bases * CAST(0.8 AS DOUBLE)",
}
_IN_INTERVAL = f"_id BETWEEN '{INTERVAL[0]}' AND '{INTERVAL[1]}'"


def _hours_sql(where: str) -> str:
    counts = ", ".join(f"count(DISTINCT CASE WHEN {p} THEN _id END) AS {n}" for n, p in _BITS.items())
    return on_snap(f"SELECT name, count(DISTINCT _id) AS seen, {counts} FROM snap WHERE {where} GROUP BY name")


def _never_sql(condition: str, where: str) -> str:
    return on_snap(f"SELECT name FROM snap WHERE {where} GROUP BY name HAVING max(CASE WHEN {_BITS[condition]} THEN 1 ELSE 0 END) = 0")


def register(add: Register) -> None:
    snap_cols = ", ".join(SNAPSHOT_REPORT_COLUMNS)
    add(
        "snapshot_json_file", "SRC-1, PRJ-1", on_snap(f"SELECT {snap_cols} FROM snap"),
        lambda s, d: flatten_snapshots(read_snapshots(s, staged_lines.snapshot_file(s, d))).select(*SNAPSHOT_REPORT_COLUMNS),
    )
    add(
        "trip_json_file", "SRC-2, PRJ-2", on_trips(f"SELECT {TRIP_COLS} FROM trips"),
        lambda s, d: trip_fields(read_trips(s, staged_lines.trip_file(s, d))),
    )
    add(
        "snapshot_text_file", "SRC-3", on_snap("SELECT _id, CAST(1 AS INTEGER) AS stations, dock_bikes AS docked FROM snap"),
        lambda s, d: read_snapshot_lines(s, staged_lines.snapshot_file(s, d)).select(
            "_id", F.size("stations").alias("stations"),
            F.aggregate("stations", F.lit(0).cast("bigint"), lambda n, x: n + x["dock_bikes"]).alias("docked"),
        ),
    )
    add(
        "trip_text_file", "SRC-4", on_trips("SELECT user_day_code, travel_time, unplug_hourTime FROM trips"),
        lambda s, d: read_trip_lines(s, staged_lines.trip_file(s, d)).select("user_day_code", "travel_time", "unplug_hourTime"),
    )
    add(
        "trip_quarantine_counts", "SRC-4, SRC-5",
        f"WITH {_LINE_CTE} SELECT count(*) AS lines, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = '') AS good, "
        "count(*) FILTER (WHERE broken_line IS NOT NULL) AS broken, count(*) FILTER (WHERE fault = '') AS good_rows, "
        "count(*) FILTER (WHERE broken_line IS NOT NULL) AS broken_rows FROM faulty",
        quarantine_counts,
    )
    add(
        "trip_quarantine_good", "SRC-4", f"WITH {_LINE_CTE} SELECT {TRIP_COLS} FROM faulty WHERE fault = ''",
        lambda s, d: _split(s, d).good,
    )
    add(
        "trip_quarantine_broken", "SRC-4", f"WITH {_LINE_CTE} SELECT broken_line, fault AS reason FROM faulty WHERE broken_line IS NOT NULL",
        lambda s, d: _split(s, d).broken,
    )
    add(
        "trip_field_report", "SRC-2", _FIELD_SQL,
        lambda s, d: inference.field_report(s.read.text(staged_lines.drifting_trip_file(s, d)), TRIP),
    )
    add(
        "snapshot_field_report", "SRC-1", _SNAPSHOT_FIELD_SQL,
        lambda s, d: inference.field_report(s.read.text(staged_lines.snapshot_file(s, d)), SNAPSHOT),
    )
    add(
        "distinct_users_by_month", "AGG-5",
        on_trips("SELECT left(trip_date, 7) AS trip_month, count(DISTINCT user_day_code) AS n, TRUE AS within_error FROM trips_dt GROUP BY ALL"),
        distinct_users_by_month,
    )
    add(
        "distinct_users_in_interval", "AGG-5",
        on_trips(f"SELECT count(DISTINCT user_day_code) AS n, TRUE AS within_error FROM trips_dt WHERE trip_date BETWEEN '{INTERVAL[0][:10]}' AND '{INTERVAL[1][:10]}'"),
        distinct_users_in_interval,
    )
    add(
        "rollup_trips_per_day", "AGG-1, TR-4", on_trips("SELECT trip_date, count(*) AS n FROM trips_dt GROUP BY trip_date"),
        lambda s, d: rollup_table.trips_per_day(_rollup(s, d)),
    )
    add(
        "rollup_trips_per_time", "AGG-1, TR-8", on_trips("SELECT trip_time, count(*) AS n FROM trips_dt GROUP BY trip_time"),
        lambda s, d: rollup_table.trips_per_time(_rollup(s, d)),
    )
    add(
        "rollup_trips_per_month", "AGG-1, AGG-11",
        on_trips("SELECT left(trip_date, 7) AS trip_month, count(*) AS n, CAST(sum(travel_time) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_s, "
                 "min(travel_time) AS min_s, max(travel_time) AS max_s FROM trips_dt GROUP BY ALL"),
        lambda s, d: rollup_table.trips_per_month(_rollup(s, d)),
    )
    for condition, survey in (("empty", "ST-17"), ("broken", "ST-10"), ("in_range", "ST-30")):
        add(
            f"bitmap_never_{condition}", f"SET-2, {survey}", _never_sql(condition, "TRUE"),
            lambda s, d, c=condition: HB.never(_bitmaps(s, d), c),
        )
        add(
            f"bitmap_never_{condition}_in_interval", f"SET-2, {survey}", _never_sql(condition, _IN_INTERVAL),
            lambda s, d, c=condition: HB.never(_bitmaps(s, d), c, *INTERVAL),
        )
    add("bitmap_hours", "SET-1, SET-2", _hours_sql("TRUE"), lambda s, d: HB.hours_where(_bitmaps(s, d)))
    add("bitmap_hours_in_interval", "SET-1, SET-2", _hours_sql(_IN_INTERVAL), lambda s, d: HB.hours_where(_bitmaps(s, d), *INTERVAL))
    add(
        "bitmap_hours_not_full_in_interval", "SET-2",
        on_snap(f"SELECT name, count(DISTINCT _id) - count(DISTINCT CASE WHEN {_BITS['full']} THEN _id END) AS n FROM snap WHERE {_IN_INTERVAL} GROUP BY name"),
        lambda s, d: HB.complement_hours(_bitmaps(s, d), "full", *INTERVAL),
    )
    for name, column in (("sketched_busiest_origins", "idunplug_station"), ("sketched_busiest_destinations", "idplug_station"), ("sketched_busiest_users", "user_day_code")):
        add(
            name, "TOP-3, TR-27",
            on_trips(f"SELECT {column}, count(*) AS n FROM trips GROUP BY {column} ORDER BY n DESC, {column} NULLS FIRST LIMIT 3"),
            _busiest(column),
        )
