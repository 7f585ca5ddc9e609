"""Session settings the reports rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings applied by `build_session`. AQE re-plans from measured sizes: it merges
# small shuffle partitions, splits skewed ones in joins, and turns a sort-merge join
# into a broadcast join only when the measured side is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "dockwise",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with `SETTINGS` (and `extra`) applied.

    On a cluster leave `master` unset and let the launcher decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SETTINGS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def settings_for_shuffle(shuffle_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle partitions for a job whose largest shuffle moves about `shuffle_bytes`.

    Size by what is shuffled, not by what is read: the reports aggregate on the map side,
    so 100 TB of input shuffles a few rows per map task and needs no more than the default
    200 partitions, whereas writing flat tables shuffles all rows. Every map task keeps an
    entry per shuffle partition, so partitions are never set beyond need. AQE merges what
    turns out small. Pass the result as `extra` to `build_session`.
    """
    partitions = max(200, -(-int(shuffle_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for staged tables that `spark.checkpoint.dir` names.

    It must be shared by the driver and all executors, so there is no default: an unset
    setting is an error, locally as on a cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return current


def staging_path(spark: SparkSession, name: str) -> str:
    """A location under the checkpoint folder for a written intermediate table."""
    return os.path.join(checkpoint_dir(spark), name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location for a table the library stages by itself: the checkpoint folder, or where that
    is unset a folder below the warehouse, which executors share too."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}"


_STAGED: dict[tuple[str, str, int], str] = {}


def input_version(spark: SparkSession, path: str) -> int:
    """A number that changes when files of an input are added, removed or rewritten.

    Paths, sizes and times of the files are listed and hashed on the cluster; no content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Sums in decimal, so that many hashes cannot overflow.
    mark = F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)"))
    return int(files.agg(mark.alias("v")).first()["v"] or 0)


def staged_once(spark: SparkSession, name: str, input_path: str, write: Callable[[str], None]) -> str:
    """The folder of a table derived from `input_path`, written by `write(folder)` on first use.

    One table per application, name and version of the input; later uses read it. Writers are
    Spark jobs into the shared folder, so the table survives lost executors.
    """
    key = (spark.sparkContext.applicationId, f"{name}:{input_path}", input_version(spark, input_path))
    if key not in _STAGED:
        path = scratch_path(spark, f"{name}-{key[0]}-{abs(hash(key)):x}")
        write(path)
        _STAGED[key] = path
    return _STAGED[key]
