"""Registry of every report as a runnable query over a TPC-H style data folder.

Each entry pairs a DataFrame builder `(spark, sf_dir) -> DataFrame` with the DuckDB
SQL that computes the same table independently. Station reports run on snapshots,
trip reports on trips, both derived by Spark from the folder's `lineitem` table, so
every query reads the whole table and its work grows with it.

Parameters differ from the reference's literals only where the derived data has no
such value (station name, date, station id); see ``DERIVED_*`` below.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dockwise.operators import core
from dockwise.operators import stations as ST
from dockwise.operators import trips as TR
from dockwise.plans.oracle import TRIP_COLS, on_snap, on_trips
from dockwise.schemas import SNAPSHOT_REPORT_COLUMNS, TRIP
from dockwise.plans import stored
from dockwise.sources import derived, staged_lines
from dockwise.sources.json_lines import (
    drop_unused_trip_columns,
    flatten_snapshots,
    parse_json_lines,
    read_snapshot_lines,
    trip_fields,
)

# Parameters that select non-empty results in the derived data.
DERIVED_STATION = "Station 3"
DERIVED_STATION_ID = 4  # origin id of "Station 3" (supplier key + 1)
DERIVED_DATE = "1997-06-19"
DERIVED_TIMES = ("15:00:00", "16:00:00", "17:00:00")

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    survey: str


REGISTRY: dict[str, Query] = {}


def _register(name: str, survey: str, sql: str | None, build: Builder) -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(name, build, sql, survey)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.snapshots_from_lineitem(derived.load_lineitem(spark, sf_dir))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.trips_from_lineitem(derived.load_lineitem(spark, sf_dir))


def _st(name: str, survey: str, sql_body: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _register(name, survey, on_snap(sql_body), lambda spark, d: fn(snapshots(spark, d)))


def _tr(name: str, survey: str, sql_body: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _register(name, survey, on_trips(sql_body), lambda spark, d: fn(trips(spark, d)))


# Trip lines as the source file has them: the six report fields plus unused ones.
RAW_TRIP = StructType(
    TRIP.fields
    + [
        StructField("_id", StringType()),
        StructField("ageRange", LongType()),
        StructField("zip_code", StringType()),
        StructField("idplug_base", LongType()),
        StructField("idunplug_base", LongType()),
    ]
)

# ------------------------------------------------------------------ sources, reshaping


def _snapshot_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the staged snapshot file, parsed with the snapshot schema."""
    return read_snapshot_lines(spark, staged_lines.snapshot_file(spark, d))


def _trip_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the staged trip file, parsed with all their fields."""
    return parse_json_lines(spark.read.text(staged_lines.trip_file(spark, d)), RAW_TRIP)


_register(
    "snapshot_rows",
    "SRC-5",
    "SELECT count(*) AS n FROM lineitem",
    lambda spark, d: core.count_rows(_snapshot_lines(spark, d)),
)
_register(
    "trip_rows",
    "SRC-5",
    "SELECT count(*) AS n FROM lineitem",
    lambda spark, d: core.count_rows(_trip_lines(spark, d)),
)
_tr(
    "trip_preview",
    "SRC-6, TOP-4",
    f"SELECT {TRIP_COLS} FROM trips ORDER BY "
    + ", ".join(f"{c.strip()} NULLS FIRST" for c in TRIP_COLS.split(","))
    + " LIMIT 20",
    lambda t: TR.trip_preview(t, 20),
)
_register(
    "station_flat",
    "SRC-3, PRJ-1",
    on_snap(f"SELECT {', '.join(SNAPSHOT_REPORT_COLUMNS)} FROM snap"),
    lambda spark, d: flatten_snapshots(_snapshot_lines(spark, d)).select(*SNAPSHOT_REPORT_COLUMNS),
)
_register(
    "trip_fields",
    "SRC-4, PRJ-2",
    on_trips(f"SELECT {TRIP_COLS} FROM trips"),
    lambda spark, d: trip_fields(_trip_lines(spark, d)),
)
_register(
    "trip_drop",
    "PRJ-5",
    on_trips(f"SELECT {TRIP_COLS} FROM trips"),
    lambda spark, d: drop_unused_trip_columns(_trip_lines(spark, d)),
)
_tr("trip_dates", "PRJ-3", f"SELECT trip_date, {TRIP_COLS} FROM trips_dt", TR.trip_dates)
_tr("trip_times", "PRJ-4", f"SELECT trip_time, {TRIP_COLS} FROM trips_dt", TR.trip_times)

# ------------------------------------------------------------------ stations

BROKEN = "total_bases > free_bases + reservations_count + dock_bikes"
IN_RANGE = "dock_bikes BETWEEN 1 AND 2"
EMPTY = "dock_bikes = 0"
RESERVED = "reservations_count > 0"
FULL = "dock_bikes = total_bases"
HEAVY = "free_bases >= total_bases * CAST(0.8 AS DOUBLE)"
HEAVY_STRICT = "free_bases > total_bases * CAST(0.8 AS DOUBLE)"


def _distinct(pred: str) -> str:
    return f"SELECT DISTINCT name FROM snap WHERE {pred}"


def _count_distinct(pred: str) -> str:
    return f"SELECT count(*) AS n FROM ({_distinct(pred)})"


def _never(pred: str) -> str:
    return f"SELECT name FROM snap GROUP BY name HAVING max(CASE WHEN {pred} THEN 1 ELSE 0 END) = 0"


_st(
    "snapshot_preview",
    "SRC-6, TOP-4",
    f"SELECT {', '.join(SNAPSHOT_REPORT_COLUMNS)} FROM snap ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in SNAPSHOT_REPORT_COLUMNS)
    + " LIMIT 20",
    lambda s: ST.snapshot_preview(s, 20),
)
_st("stations_per_hour", "ST-1", "SELECT _id, count(*) AS n FROM snap GROUP BY _id", ST.stations_per_hour)
_st(
    "avg_stations_per_hour",
    "ST-2",
    "SELECT avg(n) AS avg_stations FROM (SELECT _id, count(*) AS n FROM snap GROUP BY _id)",
    ST.avg_stations_per_hour,
)
_st("activation_counts", "ST-3", "SELECT activate, count(*) AS n FROM snap GROUP BY activate", ST.activation_counts)
_st("inactive_stations", "ST-4", "SELECT _id, name FROM snap WHERE activate = 0", ST.inactive_stations)
_st(
    "station_capacity",
    "ST-5",
    f"SELECT DISTINCT name, total_bases FROM snap WHERE name = '{DERIVED_STATION}'",
    lambda s: ST.station_capacity(s, DERIVED_STATION),
)
_st(
    "station_dock_series",
    "ST-6",
    f"SELECT _id, dock_bikes FROM snap WHERE name = '{DERIVED_STATION}'",
    lambda s: ST.station_dock_series(s, DERIVED_STATION),
)
_st(
    "station_empty_hours",
    "ST-7",
    f"SELECT _id FROM snap WHERE name = '{DERIVED_STATION}' AND {EMPTY}",
    lambda s: ST.station_empty_hours(s, DERIVED_STATION),
)
_st("broken_stations", "ST-8", _distinct(BROKEN), ST.broken_stations)
_st("broken_station_count", "ST-9", _count_distinct(BROKEN), ST.broken_station_count)
_st("never_broken_stations", "ST-10", _never(BROKEN), ST.never_broken_stations)
_st(
    "broken_log",
    "ST-11",
    f"SELECT name, _id, total_bases - free_bases - reservations_count - dock_bikes AS broken_bases "
    f"FROM snap WHERE {BROKEN}",
    ST.broken_log,
)
_st("occupancy_range_stations", "ST-12", _distinct(IN_RANGE), ST.occupancy_range_stations)
_st("occupancy_range_count", "ST-13", _count_distinct(IN_RANGE), ST.occupancy_range_count)
_st(
    "occupancy_range_log",
    "ST-14",
    f"SELECT name, _id, dock_bikes FROM snap WHERE {IN_RANGE}",
    ST.occupancy_range_log,
)
_st("empty_stations", "ST-15", _distinct(EMPTY), ST.empty_stations)
_st("empty_station_count", "ST-16", _count_distinct(EMPTY), ST.empty_station_count)
_st("never_empty_stations", "ST-17", _never(EMPTY), ST.never_empty_stations)
_st("empty_log", "ST-18", f"SELECT name, _id, dock_bikes FROM snap WHERE {EMPTY}", ST.empty_log)
_st(
    "empty_log_as_written",
    "ST-18",
    f"SELECT name, _id, dock_bikes FROM snap WHERE {IN_RANGE}",
    lambda s: ST.empty_log(s, as_written=True),
)
_st(
    "reservation_value_counts",
    "ST-19",
    "SELECT reservations_count, count(*) AS n FROM snap GROUP BY reservations_count",
    ST.reservation_value_counts,
)
_st("reserved_stations", "ST-20", _distinct(RESERVED), ST.reserved_stations)
_st("reserved_station_count", "ST-20", _count_distinct(RESERVED), ST.reserved_station_count)
_st(
    "reserved_station_pct",
    "ST-21",
    f"SELECT CAST(sum(hit) * 100 AS DOUBLE) / count(*) AS pct FROM "
    f"(SELECT name, max(CASE WHEN {RESERVED} THEN 1 ELSE 0 END) AS hit FROM snap GROUP BY name)",
    ST.reserved_station_pct,
)
_st(
    "reserved_station_pct_of_264",
    "ST-21",
    f"SELECT CAST(count(*) * 100 AS DOUBLE) / 264 AS pct FROM ({_distinct(RESERVED)})",
    lambda s: ST.reserved_station_pct(s, total=264),
)
_st(
    "reservation_log",
    "ST-22",
    f"SELECT name, _id, reservations_count FROM snap WHERE {RESERVED}",
    ST.reservation_log,
)
_st("full_stations", "ST-23", _distinct(FULL), ST.full_stations)
_st("full_station_count", "ST-23", _count_distinct(FULL), ST.full_station_count)
_st("full_log", "ST-24", f"SELECT name, _id FROM snap WHERE {FULL}", ST.full_log)
_st(
    "full_hours_per_station",
    "ST-25",
    f"SELECT name, count(*) AS n FROM snap WHERE {FULL} GROUP BY name",
    ST.full_hours_per_station,
)
_st("heavy_use_stations", "ST-26", _distinct(HEAVY), ST.heavy_use_stations)
_st("heavy_use_count", "ST-26", _count_distinct(HEAVY), ST.heavy_use_count)
_st(
    "heavy_use_count_strict",
    "ST-26",
    _count_distinct(HEAVY_STRICT),
    lambda s: ST.heavy_use_count(s, 0.8, inclusive=False),
)
_st(
    "heavy_use_log",
    "ST-27",
    f"SELECT name, _id, CAST(free_bases AS DOUBLE) / CAST(total_bases AS DOUBLE) AS free_ratio "
    f"FROM snap WHERE {HEAVY}",
    ST.heavy_use_log,
)
_st(
    "heavy_use_full_hours",
    "ST-28",
    f"SELECT name, _id FROM snap WHERE {FULL} AND name IN ({_distinct(HEAVY)})",
    ST.heavy_use_full_hours,
)
_st(
    "never_in_range_stations",
    "ST-30",
    _never(IN_RANGE),
    ST.never_in_range_stations,
)
_st("dock_histogram", "ST-29", "SELECT dock_bikes, count(*) AS n FROM snap GROUP BY dock_bikes", ST.dock_histogram)

# Per-station logs grouped into pages (the grouped form of ST-11, 14, 18, 22, 24).
# The page array is rendered as `f1,f2;f1,f2;...` so both engines give one string.


def _log_text(pages: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    entry = lambda e: F.concat_ws(",", *[e[f].cast("string") for f in fields])
    return pages.select("name", "page", F.array_join(F.transform("log", entry), ";").alias("log"))


def _log_pages_sql(pred: str, fields: tuple[str, ...], exprs: tuple[str, ...] | None = None) -> str:
    exprs = exprs or fields
    select = ", ".join(f"{e} AS {f}" for e, f in zip(exprs, fields))
    order = ", ".join(fields)
    text = " || ',' || ".join(f"CAST({f} AS VARCHAR)" for f in fields)
    size = ST.PAGE_SIZE
    return (
        f"SELECT name, CAST((rn - 1) // {size} AS BIGINT) AS page, "
        f"string_agg({text}, ';' ORDER BY {order}) AS log FROM ("
        f"SELECT name, {order}, row_number() OVER (PARTITION BY name ORDER BY {order}) AS rn FROM ("
        f"SELECT name, {select} FROM snap WHERE {pred})) GROUP BY name, page"
    )


for _name, _survey, _pred, _fields, _exprs, _fn in (
    (
        "broken_log_pages", "ST-11", BROKEN, ("_id", "broken_bases"),
        ("_id", "total_bases - free_bases - reservations_count - dock_bikes"), ST.broken_log,
    ),
    ("occupancy_range_log_pages", "ST-14", IN_RANGE, ("_id", "dock_bikes"), None, ST.occupancy_range_log),
    ("empty_log_pages", "ST-18", EMPTY, ("_id", "dock_bikes"), None, ST.empty_log),
    ("reservation_log_pages", "ST-22", RESERVED, ("_id", "reservations_count"), None, ST.reservation_log),
    ("full_log_pages", "ST-24", FULL, ("_id",), None, ST.full_log),
):
    _st(
        _name,
        _survey,
        _log_pages_sql(_pred, _fields, _exprs),
        lambda s, fn=_fn, fields=_fields: _log_text(fn(s, grouped=True), fields),
    )


def _heavy_use_pages(snap: DataFrame) -> DataFrame:
    """Grouped heavy-use log; the share is rendered in whole ten-thousandths."""
    pages = ST.heavy_use_log(snap, grouped=True)
    entry = lambda e: F.concat_ws(",", e["_id"], F.round(e["free_ratio"] * 10000).cast("bigint"))
    return pages.select("name", "page", F.array_join(F.transform("log", entry), ";").alias("log"))


_st(
    "heavy_use_log_pages",
    "ST-27",
    _log_pages_sql(
        HEAVY,
        ("_id", "share"),
        ("_id", "CAST(round(CAST(free_bases AS DOUBLE) / CAST(total_bases AS DOUBLE) * 10000) AS BIGINT)"),
    ),
    _heavy_use_pages,
)

# ------------------------------------------------------------------ trips

ON_DATE = f"trip_date = '{DERIVED_DATE}'"
IN_TIMES = "trip_time IN (" + ", ".join(f"'{t}'" for t in DERIVED_TIMES) + ")"
REST = "user_day_code, user_type, idunplug_station, idplug_station, travel_time"
DEPARTURES = "SELECT idunplug_station, count(*) AS n FROM trips GROUP BY idunplug_station"
LEAST = f"SELECT idunplug_station, n FROM ({DEPARTURES}) WHERE n = (SELECT min(n) FROM ({DEPARTURES}))"
ROUND = "idunplug_station = idplug_station"

_tr("trips_by_user_type", "TR-1", "SELECT user_type, count(*) AS n FROM trips GROUP BY user_type", TR.trips_by_user_type)
_tr(
    "trips_of_user_type",
    "TR-2",
    "SELECT user_day_code, idunplug_station, idplug_station, travel_time, unplug_hourTime "
    "FROM trips WHERE user_type = 1",
    lambda t: TR.trips_of_user_type(t, 1),
)
_tr(
    "trip_count_of_user_type",
    "TR-3",
    "SELECT count(*) AS n FROM trips WHERE user_type = 1",
    lambda t: TR.trip_count_of_user_type(t, 1),
)
_tr(
    "trip_counts_of_user_types",
    "TR-3",
    " UNION ALL ".join(
        f"SELECT CAST({u} AS BIGINT) AS user_type, count(*) AS n FROM trips WHERE user_type = {u}"
        for u in TR.USER_TYPES
    ),
    TR.trip_counts_of_user_types,
)
_tr("trips_per_day", "TR-4", "SELECT trip_date, count(*) AS n FROM trips_dt GROUP BY trip_date", TR.trips_per_day)
_tr(
    "trips_on_date",
    "TR-5",
    f"SELECT {REST} FROM trips_dt WHERE {ON_DATE}",
    lambda t: TR.trips_on_date(t, DERIVED_DATE),
)
_tr(
    "trip_count_on_date",
    "TR-6",
    f"SELECT count(*) AS n FROM trips_dt WHERE {ON_DATE}",
    lambda t: TR.trip_count_on_date(t, DERIVED_DATE),
)
_tr(
    "trips_on_date_by_user_type",
    "TR-7",
    f"SELECT user_type, count(*) AS n FROM trips_dt WHERE {ON_DATE} GROUP BY user_type",
    lambda t: TR.trips_on_date_by_user_type(t, DERIVED_DATE),
)
_tr("trips_per_time", "TR-8", "SELECT trip_time, count(*) AS n FROM trips_dt GROUP BY trip_time", TR.trips_per_time)
_tr(
    "trips_in_hours",
    "TR-9",
    f"SELECT {REST} FROM trips_dt WHERE {IN_TIMES}",
    lambda t: TR.trips_in_hours(t, DERIVED_TIMES),
)
_tr(
    "trip_count_in_hours",
    "TR-10",
    f"SELECT count(*) AS n FROM trips_dt WHERE {IN_TIMES}",
    lambda t: TR.trip_count_in_hours(t, DERIVED_TIMES),
)
_tr(
    "durations_in_hours",
    "TR-11",
    f"SELECT user_day_code, travel_time FROM trips_dt WHERE {IN_TIMES}",
    lambda t: TR.durations_in_hours(t, DERIVED_TIMES),
)
_tr(
    "durations_in_hours_between",
    "TR-12",
    f"SELECT user_day_code, travel_time FROM trips_dt WHERE {IN_TIMES} AND travel_time BETWEEN 1200 AND 1800",
    lambda t: TR.durations_in_hours_between(t, DERIVED_TIMES, 1200, 1800),
)
_tr(
    "duration_range_count",
    "TR-13",
    " UNION ALL ".join(
        f"SELECT CAST({lo} AS BIGINT) AS min_s, CAST({hi} AS BIGINT) AS max_s, count(*) AS n "
        f"FROM trips_dt WHERE {IN_TIMES} AND travel_time BETWEEN {lo} AND {hi}"
        for lo, hi in TR.DEFAULT_RANGES
    ),
    lambda t: TR.duration_range_count(t, DERIVED_TIMES, TR.DEFAULT_RANGES),
)
_tr("long_trip_count", "TR-14", "SELECT count(*) AS n FROM trips WHERE travel_time >= 1800", TR.long_trip_count)
_tr(
    "long_trip_count_strict",
    "TR-14",
    "SELECT count(*) AS n FROM trips WHERE travel_time > 1800",
    lambda t: TR.long_trip_count(t, 1800, inclusive=False),
)
_tr(
    "long_trip_mean_minutes",
    "TR-15",
    "SELECT CAST(sum(travel_time) AS BIGINT) AS total_s, "
    "CAST(sum(travel_time) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 60.0 AS mean_minutes "
    "FROM trips WHERE travel_time >= 1800",
    TR.long_trip_mean_minutes,
)
_tr(
    "duration_histogram",
    "TR-16",
    "SELECT travel_time, count(*) AS n FROM trips GROUP BY travel_time",
    TR.duration_histogram,
)
BINS = "SELECT round_even(CAST(travel_time AS DOUBLE) / 100.0, 0) AS bin FROM trips WHERE travel_time < 20000"
_tr("duration_bins", "TR-17", f"SELECT bin, count(*) AS n FROM ({BINS}) GROUP BY bin", TR.duration_bins)
_tr(
    "duration_bins_trimmed",
    "TR-18",
    f"SELECT bin, count(*) AS n FROM ({BINS}) WHERE bin <= 40 GROUP BY bin",
    TR.duration_bins_trimmed,
)
_tr("departures_per_station", "TR-19", DEPARTURES, TR.departures_per_station)
_tr("min_departures", "TR-20", f"SELECT min(n) AS n FROM ({DEPARTURES})", TR.min_departures)
_tr("least_departures_station", "TR-21", LEAST, TR.least_departures_station)
_tr(
    "trips_from_station",
    "TR-22",
    f"SELECT user_day_code, idplug_station, travel_time FROM trips WHERE idunplug_station = {DERIVED_STATION_ID}",
    lambda t: TR.trips_from_station(t, DERIVED_STATION_ID),
)
_tr(
    "trips_from_least_station",
    "TR-21, TR-22",
    f"SELECT user_day_code, idplug_station, travel_time FROM trips t "
    f"WHERE EXISTS (SELECT 1 FROM ({LEAST}) l WHERE l.idunplug_station IS NOT DISTINCT FROM t.idunplug_station)",
    TR.trips_from_least_station,
)
_tr(
    "round_trips",
    "TR-23",
    f"SELECT idunplug_station, user_day_code, idplug_station, travel_time FROM trips WHERE {ROUND}",
    TR.round_trips,
)
_tr("round_trip_count", "TR-24", f"SELECT count(*) AS n FROM trips WHERE {ROUND}", TR.round_trip_count)
_tr(
    "round_trip_user_count",
    "TR-24",
    f"SELECT count(*) AS n FROM (SELECT DISTINCT user_day_code FROM trips WHERE {ROUND})",
    lambda t: TR.round_trip_count(t, distinct_users=True),
)
_tr(
    "round_trips_per_station",
    "TR-25",
    f"SELECT idunplug_station, count(*) AS n FROM trips WHERE {ROUND} GROUP BY idunplug_station",
    TR.round_trips_per_station,
)
_tr(
    "round_trip_mean_per_station",
    "TR-26",
    f"SELECT idunplug_station, avg(travel_time) AS mean_s FROM trips WHERE {ROUND} GROUP BY idunplug_station",
    TR.round_trip_mean_per_station,
)
_tr(
    "arrivals_per_station",
    "TR-27",
    "SELECT idplug_station, count(*) AS n FROM trips GROUP BY idplug_station",
    TR.arrivals_per_station,
)
_tr(
    "busiest_origins",
    "TR-27",
    f"{DEPARTURES} ORDER BY n DESC, idunplug_station NULLS FIRST LIMIT 3",
    TR.busiest_origins,
)
_tr(
    "busiest_destinations",
    "TR-27",
    "SELECT idplug_station, count(*) AS n FROM trips GROUP BY idplug_station "
    "ORDER BY n DESC, idplug_station NULLS FIRST LIMIT 3",
    TR.busiest_destinations,
)
_tr(
    "round_trips_per_user",
    "TR-28",
    f"SELECT user_day_code, count(*) AS n FROM trips WHERE {ROUND} GROUP BY user_day_code",
    TR.round_trips_per_user,
)

stored.register(_register)


def queries() -> dict[str, Builder]:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
