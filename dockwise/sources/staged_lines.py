"""JSON Lines files staged on the cluster, and read back in parts.

Lines are written once, by tasks, below the shared folder. A feed of few lines is plain text, which
can be read from any byte on (`spark.sql.files.maxPartitionBytes`). A larger one is compressed, as
JSON text repeats its field names in every line; compressed text cannot be split, so its files
hold a bounded number of lines, and the number of reading tasks follows the number of files,
whatever the row groups or the number of files of the table the lines come from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockwise.session import staged_once
from dockwise.sources import derived


PLAIN_LINES = 100_000  # a feed of at most so many lines is less than a reading task's share
LINES_PER_FILE = 250_000


def write_lines(lines: DataFrame, path: str, count: int) -> None:
    """`count` lines as text: plain if they are few, else in compressed files of bounded length."""
    writer = lines.select("value").write.mode("overwrite")
    if count > PLAIN_LINES:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    else:
        writer = writer.option("compression", "none")
    writer.text(path)


def _lineitem_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/lineitem.parquet"


def _staged_lines(spark: SparkSession, sf_dir: str, name: str, derive: Callable[[DataFrame], DataFrame]) -> str:
    """The file of the lines that `derive` makes, one for each row of the folder's `lineitem`."""

    def make(path: str) -> None:
        items = derived.load_lineitem(spark, sf_dir)
        write_lines(derive(items), path, items.count())

    return staged_once(spark, name, _lineitem_path(sf_dir), make)


def snapshot_file(spark: SparkSession, sf_dir: str) -> str:
    """The staged snapshot feed derived from the folder's `lineitem`: one JSON object a line."""
    return _staged_lines(spark, sf_dir, "snapshot-lines", derived.snapshot_json_lines)


def trip_file(spark: SparkSession, sf_dir: str) -> str:
    """The staged trip file derived from the folder's `lineitem`, unused fields included."""
    return _staged_lines(spark, sf_dir, "trip-lines", derived.trip_json_lines)


def drifting_trip_file(spark: SparkSession, sf_dir: str) -> str:
    """The staged trip file with fields that change over time."""
    return _staged_lines(spark, sf_dir, "drifting-trip-lines", derived.drifting_trip_lines)


def faulty_trip_file(spark: SparkSession, sf_dir: str) -> str:
    """The staged trip file with broken and blank lines."""
    return _staged_lines(spark, sf_dir, "faulty-trip-lines", derived.faulty_trip_lines)
