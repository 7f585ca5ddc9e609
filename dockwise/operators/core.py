"""Generic report operators: a DataFrame in, a DataFrame out, a Column where a
predicate is needed. Nearly every station and trip report is one call to one of these.

Shape of each at scale:

* counts, distincts, flags and means are hash aggregates with a map-side partial
  step, so a hot key costs one row per input partition in the shuffle, not all its rows;
* nothing is collected to the driver and no group is gathered whole into one task:
  per-key logs come as long tables, or as bounded pages (``log_pages``);
* the only explicit broadcast is of a global aggregate, which is exactly one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """Global row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows per key (a null key is a group of its own)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def distinct_where(df: DataFrame, pred: Column, *cols: str | Column) -> DataFrame:
    """Distinct values of `cols` among rows satisfying `pred`."""
    return df.where(pred).select(*_cols(cols)).distinct()


def count_distinct_where(
    df: DataFrame, pred: Column, *cols: str | Column, name: str = "n", approx: bool = False
) -> DataFrame:
    """How many distinct values of `cols` satisfy `pred` (a null value counts once).

    ``approx=True`` uses a HyperLogLog++ sketch instead (`approx_count_distinct`,
    about 5% relative error, nulls ignored): no shuffle of the distinct values.
    """
    if approx:
        where = df.where(pred)
        value = _cols(cols)[0] if len(cols) == 1 else F.struct(*_cols(cols))
        return where.agg(F.approx_count_distinct(value).alias(name))
    return count_rows(distinct_where(df, pred, *cols), name)


def flag_by(df: DataFrame, pred: Column, key: str, flag: str = "hit") -> DataFrame:
    """One row per key: 1 if any of its rows satisfies `pred`, else 0."""
    hit = F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0)))
    return df.groupBy(key).agg(hit.alias(flag))


def never_where(df: DataFrame, pred: Column, key: str) -> DataFrame:
    """Keys none of whose rows satisfy `pred` (the complement of `distinct_where`).

    One aggregation pass; no anti-join against the full key list.
    """
    return flag_by(df, pred, key).where(F.col("hit") == 0).select(key)


def share_where(
    df: DataFrame, pred: Column, key: str, total: int | None = None, name: str = "pct"
) -> DataFrame:
    """Percent of keys with at least one row satisfying `pred`.

    The denominator is the number of distinct keys, or `total` when given.
    """
    flags = flag_by(df, pred, key)
    denom = F.lit(int(total)) if total is not None else F.count(F.lit(1))
    return flags.agg(F.try_divide(F.sum("hit") * F.lit(100), denom).alias(name))


def mean_by(df: DataFrame, key: str | Column, value: str | Column, name: str = "mean") -> DataFrame:
    """Mean of `value` per key (partial sums and counts are combined map-side)."""
    return df.groupBy(*_cols([key])).agg(F.avg(value).alias(name))


def rows_at_min(df: DataFrame, col: str) -> DataFrame:
    """Rows of `df` whose `col` equals the minimum of `col`; ties are all kept.

    The minimum is a global aggregate, a single row, so broadcasting it is safe at
    any scale; `df` itself is never shuffled for this.
    """
    lowest = df.agg(F.min(col).alias(col))
    return df.join(F.broadcast(lowest), on=col, how="left_semi")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First `k` rows in `order` (planned as a per-partition top-k and a final merge)."""
    return df.orderBy(*order).limit(int(k))


def semi_join(df: DataFrame, keys: DataFrame, key: str, broadcast_rows: int = 100_000) -> DataFrame:
    """Rows of `df` whose `key` is among `keys` (null matches null).

    The key list is broadcast if it has at most `broadcast_rows` rows, which is counted
    first; a longer list is joined by shuffle.
    """
    listed = keys.select(F.col(key).alias("_key"))
    if listed.limit(broadcast_rows + 1).count() <= broadcast_rows:
        listed = F.broadcast(listed)
    return df.join(listed, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def log_pages(
    long: DataFrame,
    key: str,
    page_size: int = 1024,
    name: str = "log",
) -> DataFrame:
    """Group a long log `(key, f1, f2, ...)` into sorted arrays of at most `page_size`
    entries: `(key, page, log)`, `log` an `ARRAY<STRUCT<f1, f2, ...>>`.

    Page `p` of a key holds entries `p * page_size` to `(p + 1) * page_size - 1` of
    its log sorted by `(f1, f2, ...)`, so a key with at most `page_size` entries has
    exactly one page, and the result does not depend on partitioning.

    `f1` is an hour label (`yyyy-MM-dd...`). The log is shuffled once, by (key, day), and ranked
    there; the ranks' maxima are the counts per (key, day), so ranking and counting read the same
    exchange and the log is computed once. Entries of a key's earlier days come from a running
    sum over that small table. A task holds whole days of a key, never more of it than one day
    at a time. The rows of a day are gathered into pages there, and only those move on.
    """
    fields = [c for c in long.columns if c != key]
    # Non-null stand-ins, so that null keys and labels group and join like any other. The key
    # itself is made from them again: both uses of the exchange then need the same columns.
    key_type = long.schema[key].dataType
    day = [
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_k"),
        F.col(key).isNull().alias("_no_key"),
        F.coalesce(F.substring(F.col(fields[0]).cast("string"), 1, 10), F.lit("")).alias("_day"),
    ]
    group = ["_k", "_no_key", "_day"]
    within = Window.partitionBy(*group).orderBy("_e")
    ranked = long.select(*day, F.struct(*fields).alias("_e")).withColumn("_rank", F.row_number().over(within))
    per_day = ranked.groupBy(*group).agg(F.max("_rank").cast("bigint").alias("_n"))
    earlier = Window.partitionBy("_k", "_no_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_rank") - 1
    paged = ranked.join(offsets, group).withColumn("page", F.floor(place / int(page_size)).cast("bigint"))
    runs = paged.groupBy(*group, "page").agg(F.collect_list("_e").alias("_run"))
    pages = runs.groupBy("_k", "_no_key", "page").agg(F.sort_array(F.flatten(F.collect_list("_run"))).alias(name))
    named = F.when(~F.col("_no_key"), F.col("_k").cast(key_type))
    return pages.select(named.alias(key), "page", name)
