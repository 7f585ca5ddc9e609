"""Helpers shared by the operators of this subpackage.

* ``shared_folder``: scratch place visible to every executor (`spark.checkpoint.dir`).
* ``stage``: cut a plan by writing a table there and reading it back; the table survives
  the loss of executors, unlike a local checkpoint.
* ``with_row_key``: a non-null 128-bit key of a document row, so that joins back to the
  text need no null-safe comparison and fully repeated rows (same id, same text) share a
  key and therefore a result.
* ``attach_group_facts``: give each row the facts of its group without putting a hot
  group's rows in one task.
* ``connected_components``: smallest member of each component, by joins only.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = ("_k1", "_k2")
EDGES_PER_TASK = 50_000


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers, as `--py-files` does.

    Does nothing where it has been shipped already; the archive is served by the driver.
    """
    context = spark.sparkContext
    if any(f.endswith("dockwise-package.zip") for f in context.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="dockwise-"), "dockwise-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("dockwise", os.path.relpath(path, root)))
    context.addPyFile(archive)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under `spark.checkpoint.dir`; nothing is created yet.

    Where the setting is unset (tests), the folder is put below the warehouse, which a
    cluster shares as well; a machine-local temporary folder is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again, and let go of the shuffle files of
    plans that are out of use (Spark removes them when their plans are collected)."""
    for df in staged:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    gc.collect()
    if staged:
        staged[0].sparkSession._jvm.System.gc()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a folder URI (file, hdfs, s3, gs) and the path in it."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        uri = f"file://{uri}"
    return pafs.FileSystem.from_uri(uri)


def with_row_key(df: DataFrame, *cols: str) -> DataFrame:
    """Add the 128-bit row key `_k1, _k2` hashed from `cols`."""
    return df.withColumns(
        {"_k1": F.xxhash64(*cols), "_k2": F.xxhash64(F.lit("second"), *reversed([F.col(c) for c in cols]))}
    )


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, one document at a time (null: empty)."""
    for v in batch.column(name):
        b = v.as_buffer() if v.is_valid else None
        yield b.to_pybytes() if b is not None else b""


def attach_group_facts(rows: DataFrame, facts: DataFrame, key: list[str], count: str, row_id: str, total: int | None = None) -> DataFrame:
    """Left-join `facts` (one row per `key`, `count` = rows of the group) to `rows`.

    Groups holding over a thousandth of all rows number fewer than a thousand, whatever
    the input, so their facts are broadcast. Rows of those groups then enter the shuffled
    join under a key of their own (which matches nothing), so no task receives a hot group.
    `row_id` names a column that spreads such rows; `total` is the number of all rows, if known.
    """
    values = [c for c in facts.columns if c not in key]
    if total is None:
        total = facts.agg(F.sum(count)).first()[0] or 0
    hot = facts.where(F.col(count) > max(total // 1000, 1))
    cold = facts.where(F.col(count) <= max(total // 1000, 1))
    marked = rows.join(
        F.broadcast(hot.select(*key, *[F.col(v).alias(f"_h_{v}") for v in values], F.lit(True).alias("_hot"))),
        key,
        "left",
    )
    spread = F.when(F.col("_hot"), F.xxhash64(row_id)).otherwise(F.lit(0))
    joined = marked.withColumn("_salt", spread).join(
        cold.select(*key, *[F.col(v).alias(f"_c_{v}") for v in values], F.lit(0).cast("bigint").alias("_salt")),
        [*key, "_salt"],
        "left",
    )
    return joined.select(*rows.columns, *[F.coalesce(f"_h_{v}", f"_c_{v}").alias(v) for v in values])


def connected_components(edges: DataFrame, src: str, dst: str, name: str) -> DataFrame:
    """`(node, component)` for every node of an undirected edge list; the component is its
    smallest node.

    Each round takes, for every node, the smallest label among itself and its neighbours
    (one aggregate with a map-side step), then jumps to that label's own label. Labels fall to
    the minimum in about log2(diameter) rounds. Labels reach the edges of a hub, and the nodes
    of a large component, as group facts: neither is gathered under one join key. Rounds are
    written tables; the loop ends when no label changes.
    """
    one = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = stage(one.select(F.inline(ways)).distinct(), f"{name}-edges")
    # As many tasks as the graph needs, whatever the session's number of partitions.
    n_edges = both.count()
    tasks = n_edges // EDGES_PER_TASK + 1
    first = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("label"), F.count(F.lit(1)).alias("degree"))
    labels = stage(first.coalesce(tasks), f"{name}-labels")
    n_nodes = labels.count()
    while True:
        told = labels.select(F.col("node").alias("v"), "degree", "label")
        heard = attach_group_facts(both, told, ["v"], "degree", "u", n_edges).groupBy("u").agg(F.min("label").alias("heard"))
        low = labels.join(heard, labels.node == heard.u).select("node", "degree", F.col("label").alias("old"), F.least("label", "heard").alias("low"))
        low = stage(low.coalesce(tasks), f"{name}-low")
        # A label that is a node has that node's label; sizes are those of the groups by label.
        sizes = low.groupBy("low").agg(F.count(F.lit(1)).alias("size"))
        jump = sizes.join(low.select(F.col("node").alias("low"), F.col("low").alias("far")), "low")
        near = attach_group_facts(low, jump, ["low"], "size", "node", n_nodes)
        new = stage(
            near.select("node", "degree", "old", F.least("low", F.coalesce("far", "low")).alias("label")).coalesce(tasks), f"{name}-labels"
        )
        if new.where("label <> old").limit(1).count() == 0:
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "degree", "label")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, which at its end gives freed memory back to the system: workers serve many stages,
    and what one has freed would count against the next."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return wrapped


def running_offsets(totals: DataFrame, order: list[str], value: str, partition: list[str] | None = None) -> DataFrame:
    """Sum of `value` over the earlier rows of a small totals table (one row per part)."""
    w = Window.partitionBy(*(partition or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("before", F.coalesce(F.sum(value).over(w), F.lit(0)))
