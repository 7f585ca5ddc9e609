"""Station snapshots and trips derived row by row from a TPC-H style `lineitem` table.

The real snapshot and trip files are not available, so every registered query runs
on tables that Spark derives from `lineitem` with integer arithmetic only. The
derivation is a narrow projection: it never shuffles, only the lineitem columns it
names are read from Parquet, and the derived tables grow linearly with `lineitem`.

`day` below is the ship date as `yyyy-MM-dd`; `%` is the remainder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.schemas import SNAPSHOT_REPORT_COLUMNS, STATION, TRIP_COLUMNS

def load_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder's `lineitem` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")


def _day() -> F.Column:
    # DATE -> STRING is `yyyy-MM-dd` for four-digit years, without a formatter per row.
    return F.to_date("l_shipdate").cast("string")


def _mod(col: str | F.Column, n: int) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return c % F.lit(n)


def snapshots_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Flat snapshots `(_id, name, id, activate, total_bases, free_bases,
    reservations_count, dock_bikes)`, one row per lineitem row.

    Unlike a real feed a station can appear more than once in an hour.
    """
    supp = F.col("l_suppkey")
    zero = F.lit(0).cast("bigint")
    total = (F.lit(12) + _mod(supp, 19)).cast("bigint")
    lo = (
        F.when(_mod(supp, 5) == 0, F.floor(total / 2))
        .when(_mod(supp, 4) == 0, F.lit(3))
        .otherwise(F.lit(0))
        .cast("bigint")
    )
    hi = F.when(_mod(supp, 3) == 0, total - 1).otherwise(total).cast("bigint")
    seq = F.col("l_orderkey") * 7 + F.col("l_linenumber").cast("bigint") * 3 + F.col("l_partkey")
    # Reservation and broken-base caps before clipping to the room left.
    r_cap = F.when(_mod(supp, 10) == 0, zero).otherwise(F.greatest(zero, _mod("l_partkey", 8) - 4))
    b_cap = (
        F.when(_mod(supp, 20) == 7, zero)
        .when(_mod("l_orderkey", 5) == 0, 1 + _mod("l_partkey", 2))
        .otherwise(zero)
    )
    step1 = lineitem.select(
        F.concat(_day(), F.lit("T00:00:00")).alias("_id"),
        F.concat(F.lit("Station "), supp.cast("string")).alias("name"),
        supp.alias("id"),
        F.when(_mod("l_orderkey", 997) == 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("activate"),
        total.alias("total_bases"),
        (lo + seq % (hi - lo + 1)).alias("dock_bikes"),
        r_cap.alias("_r_cap"),
        b_cap.alias("_b_cap"),
    )
    # With room = total - docked >= 0 and caps >= 0:
    #   reserved = least(room, r_cap);  left = room - reserved = greatest(room - r_cap, 0)
    #   broken = least(left, b_cap);    free = left - broken = greatest(left - b_cap, 0)
    # Each column then refers to the docked count once, so the optimizer's inlining
    # of these projections into pushed-down filters stays linear in size.
    room = F.col("total_bases") - F.col("dock_bikes")
    step2 = step1.select(
        "*",
        F.least(room, F.col("_r_cap")).alias("reservations_count"),
        F.greatest(room - F.col("_r_cap"), zero).alias("_left"),
    )
    flat = step2.select(
        "*",
        F.greatest(F.col("_left") - F.col("_b_cap"), zero).alias("free_bases"),
    )
    return flat.select(*SNAPSHOT_REPORT_COLUMNS)


def nested_snapshots_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Snapshot lines `(_id, stations)` in the shape of the hourly feed.

    Each `lineitem` row gives one line with a one-element array, so nesting needs no
    shuffle. Several lines can share an `_id`; the flat table does not depend on how rows
    are grouped into lines. Station fields the derivation does not produce are null.
    """
    flat = snapshots_from_lineitem(lineitem)
    station = F.struct(
        *[
            (F.col(f.name) if f.name in flat.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in STATION.fields
        ]
    )
    return flat.select("_id", F.array(station).alias("stations"))


def snapshot_json_lines(lineitem: DataFrame) -> DataFrame:
    """The nested snapshots serialised as JSON text, one line per row (`value`)."""
    nested = nested_snapshots_from_lineitem(lineitem)
    return nested.select(F.to_json(F.struct("_id", "stations")).alias("value"))


def trip_json_lines(lineitem: DataFrame) -> DataFrame:
    """The derived trips, with the unused fields, as JSON text (`value`)."""
    trips = trips_from_lineitem(lineitem, with_unused=True)
    return trips.select(F.to_json(F.struct(*trips.columns)).alias("value"))


def trips_from_lineitem(lineitem: DataFrame, with_unused: bool = False) -> DataFrame:
    """Trips `(user_type, user_day_code, idunplug_station, idplug_station, travel_time,
    unplug_hourTime)`, one per lineitem row.

    With ``with_unused`` the five fields that the source file carries but no report
    reads are added too, so that dropping them can be exercised.
    """
    price = F.floor("l_extendedprice").cast("bigint")
    hour = F.lpad((F.col("l_quantity").cast("bigint") % 24).cast("string"), 2, "0")
    cols = [
        F.col("l_linenumber").cast("bigint").alias("user_type"),
        F.col("l_orderkey").cast("string").alias("user_day_code"),
        (F.col("l_suppkey") + 1).alias("idunplug_station"),
        F.when(_mod("l_partkey", 10) == 0, F.col("l_suppkey") + 1)
        .otherwise(_mod("l_partkey", 100) + 1)
        .alias("idplug_station"),
        F.when(_mod("l_orderkey", 50) == 0, price).otherwise(price % 4500).alias("travel_time"),
        F.concat(_day(), F.lit("T"), hour, F.lit(":00:00Z")).alias("unplug_hourTime"),
    ]
    if with_unused:
        cols += [
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
            .alias("_id"),
            (_mod("l_partkey", 7)).cast("bigint").alias("ageRange"),
            F.lpad(_mod("l_suppkey", 100000).cast("string"), 5, "0").alias("zip_code"),
            (_mod("l_partkey", 30) + 1).cast("bigint").alias("idplug_base"),
            (_mod("l_suppkey", 30) + 1).cast("bigint").alias("idunplug_base"),
        ]
    out = lineitem.select(*cols)
    return out if with_unused else out.select(*TRIP_COLUMNS)


def faulty_trip_lines(lineitem: DataFrame) -> DataFrame:
    """Trip lines of which some are broken, as a feed cut off or written by hand would be.

    By `l_orderkey`: multiples of 31 are cut in half, of 37 have text for the duration, of 41 are
    blank, of 43 are lists (the first that applies).
    """
    trips = trips_from_lineitem(lineitem, with_unused=True)
    key = F.col("user_day_code").cast("bigint")
    rows = trips.select(key.alias("k"), "travel_time", F.to_json(F.struct(*trips.columns)).alias("line"))
    seconds = F.concat(F.lit('"travel_time":'), F.col("travel_time").cast("string"), F.lit(","))
    value = (
        F.when(_mod("k", 31) == 0, F.expr("substring(line, 1, int(length(line) / 2))"))
        .when(_mod("k", 37) == 0, F.replace("line", seconds, F.lit('"travel_time":"soon",')))
        .when(_mod("k", 41) == 0, F.lit("  "))
        .when(_mod("k", 43) == 0, F.concat(F.lit("["), "line", F.lit("]")))
        .otherwise(F.col("line"))
    )
    return rows.select(value.alias("value"))


def drifting_trip_lines(lineitem: DataFrame) -> DataFrame:
    """Trip lines whose fields change over time, as a feed's do over the years.

    By `l_orderkey`: multiples of 7 lack `zip_code`, of 11 have `ageRange` as text, of 13 have a
    new object `plan` with `name` and `price`, of 17 a null duration.
    """
    trips = trips_from_lineitem(lineitem, with_unused=True)
    key = F.col("user_day_code").cast("bigint")
    plan = F.concat(F.lit(',"plan":{"name":"day","price":'), F.when(_mod(key, 2) == 0, F.lit("2")).otherwise(F.lit("2.5")), F.lit("}"))
    parts = [
        F.lit("{"),
        F.concat(F.lit('"user_type":'), F.col("user_type").cast("string")),
        F.concat(F.lit(',"user_day_code":"'), F.col("user_day_code"), F.lit('"')),
        F.concat(F.lit(',"idunplug_station":'), F.col("idunplug_station").cast("string")),
        F.concat(F.lit(',"idplug_station":'), F.col("idplug_station").cast("string")),
        F.concat(F.lit(',"travel_time":'), F.when(_mod(key, 17) == 0, F.lit("null")).otherwise(F.col("travel_time").cast("string"))),
        F.concat(F.lit(',"unplug_hourTime":"'), F.col("unplug_hourTime"), F.lit('"')),
        F.when(_mod(key, 7) == 0, F.lit("")).otherwise(F.concat(F.lit(',"zip_code":"'), F.col("zip_code"), F.lit('"'))),
        F.when(_mod(key, 11) == 0, F.concat(F.lit(',"ageRange":"'), F.col("ageRange").cast("string"), F.lit('"'))).otherwise(
            F.concat(F.lit(',"ageRange":'), F.col("ageRange").cast("string"))
        ),
        F.when(_mod(key, 13) == 0, plan).otherwise(F.lit("")),
        F.lit("}"),
    ]
    return trips.select(F.concat(*parts).alias("value"))
