"""Mergeable sketches: distinct counts and most frequent values from small daily states.

A sketch of a day is built once, with a map-side step; the answer for any period merges the
sketches of its days and reads no trips. Distinct counts are HyperLogLog sketches (an estimate
with a known standard error). Most frequent values are frequent-items sketches whose candidates
are counted exactly in a second pass, so their answer is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwise.operators import core

LOG_BUCKETS = 12


def distinct_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Relative standard error of an estimate from merged sketches of 2**log_buckets registers."""
    return 1.04 / math.sqrt(1 << log_buckets)


# ---------------------------------------------------------------- distinct counts


def distinct_sketches(df: DataFrame, day: str | Column, value: str, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """One row per day: `day, rows, nulls, sketch` of the distinct values of `value`."""
    label = F.col(day) if isinstance(day, str) else day
    return df.groupBy(label.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(value).isNull(), 1)).alias("nulls"),
        F.hll_sketch_agg(F.col(value).cast("string"), F.lit(log_buckets)).alias("sketch"),
    )


def distinct_between(sketches: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Estimated distinct values of the days from `first` to `last` (inclusive; none: open): `n`.

    A null value counts as one, as in the exact count. No day in the period gives 0.
    """
    return _merged(_between(sketches, first, last))


def distinct_by_period(sketches: DataFrame, period: Column) -> DataFrame:
    """Estimated distinct values of each period of days: `period, n`."""
    return _merged(sketches.groupBy(period.alias("period")))


def _between(sketches: DataFrame, first: str | None, last: str | None) -> DataFrame:
    for bound, test in ((first, F.col("day") >= F.lit(first)), (last, F.col("day") <= F.lit(last))):
        sketches = sketches.where(test) if bound is not None else sketches
    return sketches


def _merged(sketches) -> DataFrame:
    estimate = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0))
    one_null = F.when(F.sum("nulls") > 0, 1).otherwise(0)
    return sketches.agg((estimate + one_null).cast("bigint").alias("n"))


# ---------------------------------------------------------------- most frequent values

ERROR_SHARE = 3.5  # of all rows, divided by the slots: how far a sketch may undercount a value


def frequent_sketches(df: DataFrame, day: str | Column, value: str, slots: int = 10_000) -> DataFrame:
    """One row per day: `day, rows, sketch` of the most frequent non-null values of `value`.

    A sketch tracks at most `slots` values (a power of two at least as large as four thirds of that is
    kept), whatever the number of distinct ones.
    """
    label = F.col(day) if isinstance(day, str) else day
    some = df.where(F.col(value).isNotNull())
    state = F.expr(f"approx_top_k_accumulate(`{value}`, {int(slots)})")
    return some.groupBy(label.alias("day")).agg(F.count(F.lit(1)).alias("rows"), state.alias("sketch"))


def candidates(sketches: DataFrame, slots: int = 10_000) -> DataFrame:
    """Values that the merged sketches track, and how many rows any other value may have:
    `value, missed` (no more than `slots` rows)."""
    # Grouped by a constant: no sketches give no row (a global merge of none would fail).
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(sketch, {int(slots)})").alias("sketch"))
    bound = F.floor(F.col("rows") * ERROR_SHARE / float(slots)).cast("bigint")
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {int(slots)})").alias("items"), bound.alias("missed"))
    return found.select(F.explode("items").alias("i"), "missed").select(F.col("i.item").alias("value"), "missed")


def top_values(df: DataFrame, sketches: DataFrame, value: str, k: int, slots: int = 10_000) -> DataFrame:
    """The `k` most frequent values of `df` (`value, n`; ties by smaller value, null first), exactly.

    `sketches` are those of `df`. A second pass counts only the candidates, and nulls. A value that is
    no candidate has at most `missed` rows: if the k-th count is larger, the answer is that of the
    full count. Otherwise (many values about as frequent as the k-th) all values are counted. The
    test needs the counts, so this runs a job before it returns.
    """
    order = [F.col("n").desc(), F.col(value).asc_nulls_first()]
    listed = candidates(sketches, slots)
    missed = listed.agg(F.max("missed")).first()[0]
    if missed is None:
        return core.top_k(core.count_by(df, value), order, k)
    tracked = listed.select(F.col("value").alias(value))
    # At most `slots` candidates; the null group is counted beside them.
    some = df.join(F.broadcast(tracked), value, "left_semi").select(value).unionByName(df.where(F.col(value).isNull()).select(value))
    best = core.top_k(core.count_by(some, value), order, k)
    counts = [r["n"] for r in best.collect()]
    if len(counts) == k and counts[-1] > missed:
        return best
    return core.top_k(core.count_by(df, value), order, k)
