"""Trip rollups: mergeable partial counts per month, with idempotent replacement.

A rollup holds one row per month, date, time of day and user type: the number of trips, those with
a duration, and sum, least and largest duration. Any report on those keys is a sum over rollup
rows, a few thousand a month whatever the number of trips. Months are folders: writing a month again
replaces it as a whole, so a load that is repeated, or corrected later, counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.operators.trips import with_trip_date, with_trip_time

MONTH = "trip_month"
KEYS = ("trip_date", "trip_time", "user_type")


def partials(trips: DataFrame) -> DataFrame:
    """Partial counts of `trips`: `trip_date, trip_time, user_type, n, timed, total_s, min_s,
    max_s, trip_month`. Trips without a readable time have the month `none`."""
    labelled = with_trip_time(with_trip_date(trips))
    rows = labelled.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("travel_time").alias("timed"),
        F.sum("travel_time").alias("total_s"),
        F.min("travel_time").alias("min_s"),
        F.max("travel_time").alias("max_s"),
    )
    return rows.withColumn(MONTH, F.coalesce(F.substring("trip_date", 1, 7), F.lit("none")))


def replace_months(rollup: DataFrame, path: str) -> None:
    """Write the months that `rollup` (from `partials`) has, each as a whole; others stay.

    Call it with all trips of those months. Writing the same months again changes nothing.
    """
    # A month has a few thousand rows, so its folder gets one file.
    writer = rollup.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH).parquet(path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The rollup of all months; a filter on `trip_month` reads only their folders."""
    table = spark.read.option("basePath", path).parquet(path)
    return table.withColumn(MONTH, F.col(MONTH).cast("string"))


def merged(rollup: DataFrame, *keys: str | Column) -> DataFrame:
    """Sums over the rollup: the keys, `n, timed, total_s, mean_s, min_s, max_s`."""
    rows = rollup.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n", "timed", "total_s")], F.min("min_s").alias("min_s"), F.max("max_s").alias("max_s")
    )
    return rows.withColumn("mean_s", F.try_divide(F.col("total_s").cast("double"), F.col("timed").cast("double")))


def trips_per_day(rollup: DataFrame) -> DataFrame:
    """Trips per date: `trip_date, n`."""
    return merged(rollup, "trip_date").select("trip_date", "n")


def trips_per_time(rollup: DataFrame) -> DataFrame:
    """Trips per time of day: `trip_time, n`."""
    return merged(rollup, "trip_time").select("trip_time", "n")


def trips_per_month(rollup: DataFrame) -> DataFrame:
    """`trip_month, n, mean_s, min_s, max_s`."""
    return merged(rollup, MONTH).select(MONTH, "n", "mean_s", "min_s", "max_s")
