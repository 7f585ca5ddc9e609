"""Read schemas for the two input datasets and the flat tables built from them.

Declaring the schema up front avoids the inference pass over the JSON files and
fixes the column types (every integer is BIGINT, labels stay STRING).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# One station record inside an hourly snapshot. Only name, activate and the four
# base/bike counts are used by the reports; the rest are carried through untouched.
STATION = StructType(
    [
        StructField("activate", LongType()),
        StructField("name", StringType()),
        StructField("reservations_count", LongType()),
        StructField("light", LongType()),
        StructField("total_bases", LongType()),
        StructField("free_bases", LongType()),
        StructField("number", StringType()),
        StructField("longitude", StringType()),
        StructField("no_available", LongType()),
        StructField("address", StringType()),
        StructField("latitude", StringType()),
        StructField("dock_bikes", LongType()),
        StructField("id", LongType()),
    ]
)

# One JSON line of the snapshot file: the hour label and every station at that hour.
SNAPSHOT = StructType(
    [
        StructField("_id", StringType()),
        StructField("stations", ArrayType(STATION)),
    ]
)

# One JSON line of the trips file, restricted to the fields the reports read.
TRIP = StructType(
    [
        StructField("user_type", LongType()),
        StructField("user_day_code", StringType()),
        StructField("idunplug_station", LongType()),
        StructField("idplug_station", LongType()),
        StructField("travel_time", LongType()),
        StructField("unplug_hourTime", StringType()),
    ]
)

# Trip fields present in the source file that no report uses.
UNUSED_TRIP_COLUMNS = ("_id", "ageRange", "zip_code", "idplug_base", "idunplug_base")

# Columns of the flat snapshot table: one row per (hour, station).
FLAT_SNAPSHOT_COLUMNS = ("_id",) + tuple(f.name for f in STATION.fields)

# Columns read by the station reports.
SNAPSHOT_REPORT_COLUMNS = (
    "_id",
    "name",
    "id",
    "activate",
    "total_bases",
    "free_bases",
    "reservations_count",
    "dock_bikes",
)

TRIP_COLUMNS = tuple(f.name for f in TRIP.fields)
