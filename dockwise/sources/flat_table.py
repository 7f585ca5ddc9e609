"""Flat Parquet tables: the snapshot and trip files parsed once, stored columnar.

Reading JSON text costs a full parse per query and reads every field; the flat
tables are read vectorised, with only the columns a report needs, and are
partitioned by period (month by default, or day) so a date filter skips whole
folders:

* snapshots: one row per (hour, station), partitioned by `snapshot_period`, a
  prefix of the hour label `_id`;
* trips: the six trip fields plus `trip_date` and `trip_time`, partitioned by
  `trip_period`, a prefix of `trip_date`. The trip reports use the stored columns
  instead of deriving them, and add the matching period to date filters.

Rows are range-partitioned on (period, date, ...) before writing, so each file
holds a sorted run of dates and Parquet min/max statistics skip row groups inside a
period. Month folders keep files large when a day holds little data; day folders
suit a few high-volume months.

The location is chosen by the caller (a shared folder on a cluster);
``dockwise.session.staging_path`` gives one under `spark.checkpoint.dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.operators.trips import with_trip_date, with_trip_time
from dockwise.schemas import TRIP_COLUMNS

SNAPSHOT_PARTITION = "snapshot_period"
TRIP_PARTITION = "trip_period"
PERIODS = {"month": 7, "day": 10}  # label prefix length of `yyyy-MM-dd...`


def _period(label: str, period: str) -> F.Column:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {sorted(PERIODS)}, not {period!r}")
    return F.substring(label, 1, PERIODS[period])


def with_snapshot_period(flat: DataFrame, period: str = "month") -> DataFrame:
    """Add `snapshot_period`: the month (or day) prefix of the hour label."""
    return flat.withColumn(SNAPSHOT_PARTITION, _period("_id", period))


def flat_trips(trips: DataFrame, period: str = "month") -> DataFrame:
    """Trip fields plus `trip_time`, `trip_date` and the `trip_period` they fall in."""
    labelled = with_trip_time(with_trip_date(trips))
    return labelled.select(*TRIP_COLUMNS, "trip_time", "trip_date", _period("trip_date", period).alias(TRIP_PARTITION))


def _write(df: DataFrame, path: str, order: tuple[str, ...], mode: str) -> None:
    # Range-partition on the period and finer columns: each task gets a contiguous
    # slice, so it writes into few folders, and a period holding a large share of
    # the rows is split over many tasks rather than landing in one.
    # Sorted files let row groups skip by date. (Range bounds are sampled, so the input
    # is evaluated twice.)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(order[0]).parquet(path)


def write_flat_snapshots(flat: DataFrame, path: str, mode: str = "overwrite", period: str = "month") -> None:
    """Write flat snapshots (`flatten_snapshots` output) partitioned by period."""
    _write(with_snapshot_period(flat, period), path, (SNAPSHOT_PARTITION, "_id", "name"), mode)


def write_flat_trips(trips: DataFrame, path: str, mode: str = "overwrite", period: str = "month") -> None:
    """Write trips with their date and time labels, partitioned by period."""
    order = (TRIP_PARTITION, "trip_date", "trip_time", "idunplug_station", "user_day_code")
    _write(flat_trips(trips, period), path, order, mode)


def _read(spark: SparkSession, path: str, partition: str) -> DataFrame:
    # Day folders would be read back as DATE by partition type inference; keep labels.
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn(partition, F.col(partition).cast("string"))


def read_flat_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Flat snapshots with a STRING `snapshot_period` partition column."""
    return _read(spark, path, SNAPSHOT_PARTITION)


def read_flat_trips(spark: SparkSession, path: str) -> DataFrame:
    """Flat trips with a STRING `trip_period` partition column."""
    return _read(spark, path, TRIP_PARTITION)
