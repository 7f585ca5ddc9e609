"""JSON Lines sources for hourly station snapshots and trips.

Two ways in, both ending in the same DataFrame:

* ``read_snapshots`` / ``read_trips``: Spark's JSON reader with a declared schema.
* ``read_snapshot_lines`` / ``read_trip_lines``: read the file as text and parse each
  line with ``from_json``; useful when the lines come from somewhere other than a
  file (a text column, a Kafka value) and the same parse must apply.

Bad lines fail the job by default (``mode="FAILFAST"``). With ``mode="PERMISSIVE"`` a
bad line is kept, all fields null, and its raw text goes to ``corrupt_column``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dockwise.schemas import SNAPSHOT, TRIP, TRIP_COLUMNS, UNUSED_TRIP_COLUMNS


def _reader(spark: SparkSession, schema: StructType | None, mode: str, corrupt_column: str | None):
    reader = spark.read.option("mode", mode)
    if corrupt_column is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        if schema is not None:
            schema = StructType(schema.fields + [StructField(corrupt_column, StringType())])
    if schema is not None:
        reader = reader.schema(schema)
    return reader


def read_snapshots(
    spark: SparkSession,
    path: str,
    schema: StructType | None = SNAPSHOT,
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Nested snapshot lines `(_id, stations)`. ``schema=None`` infers it (one extra pass)."""
    return _reader(spark, schema, mode, corrupt_column).json(path)


def read_trips(
    spark: SparkSession,
    path: str,
    schema: StructType | None = TRIP,
    mode: str = "FAILFAST",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Trip lines. The declared schema reads only the six fields the reports use."""
    return _reader(spark, schema, mode, corrupt_column).json(path)


def parse_json_lines(
    lines: DataFrame,
    schema: StructType,
    mode: str = "FAILFAST",
    value: str | Column = "value",
) -> DataFrame:
    """Parse a text column of JSON objects into the top-level fields of `schema`.

    Blank and null lines give no row, as with the JSON reader. That test also ties every
    row to its parse: a plan that uses no field (a count) still parses, and fails on, each
    line.
    """
    v = F.col(value) if isinstance(value, str) else value
    parsed = F.from_json(v, schema, {"mode": mode}).alias("r")
    return lines.select(parsed).where(F.col("r").isNotNull()).select("r.*")


def read_snapshot_lines(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Snapshot file read as text lines, each parsed with `from_json`."""
    return parse_json_lines(spark.read.text(path), SNAPSHOT, mode)


def read_trip_lines(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Trip file read as text lines, each parsed with `from_json`."""
    return parse_json_lines(spark.read.text(path), TRIP, mode)


def flatten_snapshots(nested: DataFrame) -> DataFrame:
    """One row per (hour, station): `_id` plus every station field.

    A snapshot whose `stations` array is empty or null yields no rows.
    """
    return nested.select("_id", F.explode("stations").alias("s")).select("_id", "s.*")


def trip_fields(trips: DataFrame) -> DataFrame:
    """The six trip fields the reports read, in a fixed order."""
    return trips.select(*TRIP_COLUMNS)


def drop_unused_trip_columns(trips: DataFrame) -> DataFrame:
    """Drop the trip fields no report uses (names absent from the frame are ignored)."""
    return trips.drop(*UNUSED_TRIP_COLUMNS)
