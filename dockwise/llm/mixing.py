"""Mixing sources to target weights by weighted fair queueing.

1. Sizes are counted natively; one row per source holds its total, its weight (sources in
   code point order, null last, take `weights` in turn) and its target: the budget shared
   by weight, no source above `repeat` times its size, the excess shared among the rest.
   With sources ordered by total / weight, the sources at their cap are a prefix, so one
   running sum over the source table finds the water level.
2. Documents of a source queue in a shuffled order (a seeded hash of the row) and wrap
   around for further epochs. A document's virtual finish time is the source's tokens up to
   and including it, divided by the target. Running sums are two-level: the hash order is
   cut into ranges, range totals are summed per source, and rows are summed within a
   range, so a source holding a third of all rows spreads over many tasks. How many ranges
   there are does not change the order, and so not the mix.
   As a link sends packets, a document is queued in pieces of at most `packet` words, each
   with its own finish time, so that one very long document at the cut cannot leave its
   source far from the target.
3. All pieces are range-sorted by finish time into a written table; part totals give every
   piece its global position, and the mix is cut at the budget: pieces are taken while
   they end within it. Text never moves: only ids, sizes and times do.

Ties of the hash order are broken by id and row key; identical rows share their key, and
their order does not change what is taken of such a group of rows, so reruns agree.

Defined cases: null and blank texts have size 0 and are never taken; a null source is a
source of its own, last in order; an empty table gives an empty result; fully repeated rows
queue separately and share equally what their group takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwise.llm.common import KEY, running_offsets, stage, with_row_key

WORD = "[^\\x20\\x09-\\x0D]+"
SEED = "mix-1"


def sized(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Id, source, size in words and row key of every document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    keyed = with_row_key(docs.select(F.col(id_col).alias("_id"), F.col("source").cast("string").alias("source"), "text"), "_id", "source", "text")
    return keyed.select("_id", "source", *KEY, size.alias("size"), _place().alias("_o"))


def _place() -> Column:
    """The row's place in its source's queue: the first 60 bits of a seeded digest of the row."""
    parts = [F.lit(SEED), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.coalesce("source", F.lit(""))]
    digest = F.md5(F.concat_ws(":", *parts, F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget_share: float = 1.5, repeat: int = 2) -> DataFrame:
    """`(source, source_size, weight, target)`, one row per source.

    The windows here run over the source table, a row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Spark compares strings by their UTF-8 bytes, which is code point order.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighted = totals.withColumn("weight", weight)
    everything = Window.partitionBy(F.lit(0))
    level_order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = level_order.rowsBetween(Window.unboundedPreceding, -1)
    capped = weighted.select(
        "*",
        (F.sum("source_size").over(everything) * budget_share).alias("_budget"),
        F.coalesce(F.sum("source_size").over(before) * repeat, F.lit(0)).alias("_capped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_open"),
    )
    # The level if this source were the first that is not at its cap. The true level is the
    # first that its own cap does not contradict; the later ones are lower.
    level = (F.col("_budget") - F.col("_capped")) / F.col("_open")
    leveled = capped.withColumn("_level", level).withColumn(
        "_fits", F.col("_level") * F.col("weight") <= F.col("source_size") * float(repeat)
    )
    water = F.max(F.when(F.col("_fits"), F.col("_level"))).over(everything)
    target = F.least(F.col("source_size") * float(repeat), F.coalesce(water, F.lit(float("inf"))) * F.col("weight"))
    return leveled.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget_share: float = 1.5, repeat: int = 2, id_col: str = "doc_id", bucket_rows: int = 2000, packet: int = 256) -> DataFrame:
    """One row per document: `_id, source, _k1, _k2, size, source_size, target, taken`.

    `bucket_rows` is the number of rows one running-sum bucket should hold.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = stage(sized(docs, id_col), "mix-sizes")
    targets = stage(source_targets(sizes, weights, budget_share, repeat), "mix-targets")
    n_rows, n_sources = sizes.count(), targets.count()
    budget = (targets.agg(F.sum("target")).first()[0]) or 0.0
    # One row per source; past that bound the join is left to shuffle.
    facts = F.broadcast(targets) if n_sources <= 100_000 else targets
    facts = facts.withColumnRenamed("source", "_s")
    buckets = max(256, n_rows // bucket_rows)
    # Ranges of the 60-bit places, in their order.
    bucket = F.shiftright(F.shiftright("_o", 30) * F.lit(buckets).cast("bigint"), 30)
    queued = sizes.join(facts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_b", bucket)
    within = Window.partitionBy("source", "_b").orderBy("_o", "_id", *KEY).rowsBetween(Window.unboundedPreceding, 0)
    in_bucket = stage(queued.withColumn("_within", F.sum("size").over(within)), "mix-queue")
    offsets = running_offsets(in_bucket.groupBy("source", "_b").agg(F.sum("size").alias("_t")), ["_b"], "_t", ["source"])
    offsets = offsets.select(F.col("source").alias("_s"), F.col("_b").alias("_sb"), "before")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb"))
    ended = in_bucket.join(offsets, same).withColumn("_end", F.col("before") + F.col("_within"))
    copies = ended.where("size > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
    pieces = copies.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(packet).cast("bigint"))))
    until = F.least(F.col("_from") + packet, F.col("size"))
    finish = (F.col("_epoch") * F.col("source_size") + F.col("_end") - F.col("size") + until) / F.col("target")
    order_by = ["_finish", "source", "_id", *KEY, "_epoch"]
    timed = pieces.withColumns({"_finish": finish, "_words": until - F.col("_from")}).select(*order_by, "_words")
    ranged = timed.repartitionByRange(parts, *order_by)
    line = stage(ranged.withColumn("_part", F.spark_partition_id()), "mix-line")
    totals = running_offsets(line.groupBy("_part").agg(F.sum("_words").alias("_t")), ["_part"], "_t")
    # A row per range partition.
    placed = line.join(F.broadcast(totals.select("_part", "before")), "_part")
    along = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    mixed = placed.withColumn("_at", F.col("before") + F.sum("_words").over(along))
    taken = mixed.where(F.col("_at") <= F.lit(float(budget))).groupBy(*KEY).agg(F.sum("_words").alias("_sum"))
    # Repeated rows share a key and, equally, what their group takes.
    repeats = sizes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    per_key = taken.join(repeats, list(KEY)).select(*KEY, "_sum", "_n")
    rowed = sizes.join(facts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").join(per_key, list(KEY), "left")
    share = F.floor(F.coalesce("_sum", F.lit(0)) / F.coalesce("_n", F.lit(1)))
    return rowed.select("_id", "source", *KEY, "size", "source_size", "target", share.cast("bigint").alias("taken"))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return mix(docs).select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each as many times as the mix takes it.

    A document that the cut falls into counts as taken when at least half of it is.
    """
    taken = mix(docs, **settings).where("taken > 0").select(
        *KEY, F.round(F.col("taken") / F.col("size")).cast("int").alias("_copies")
    ).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("source").cast("string").alias("source"), "text")
    keyed = with_row_key(rows, "_id", "source", "text").select("_row", *KEY)
    joined = keyed.join(taken.where("_copies > 0"), list(KEY))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
