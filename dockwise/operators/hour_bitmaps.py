"""Hours per station as bitmaps: membership, complements and counts over any interval.

`hour_bitmaps` turns the snapshots into one row per station and bucket of 64 hours, with a bitmap,
one long, of the hours seen and one per condition. Reports over an interval then read these rows
only: bits are counted, in the buckets at the interval's ends after a bitwise AND with the
interval's hours; the complement (hours seen without the condition) is a difference of bit counts.
A repeated hour of a station sets its bit once.

Building it takes one hash aggregate over rows of fixed width, never more rows than snapshots: a
station seen once costs one row of longs, not a bitmap of years. By default a map-side step goes
before the shuffle. With `partitions`, as many as the rows need, rows are spread by station and
bucket first, so that what a task holds does not depend on the size of a split or on the session;
a station holding a third of all rows is spread by its buckets.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwise.functions import columns as C

HOUR = 3600
BITS = 64  # hours of a bucket, as a long holds; buckets and hours count from 1
ROWS_PER_TASK = 500_000
CONDITIONS = ("broken", "empty", "in_range", "full", "reserved", "heavy")


def default_conditions(a: int = 1, b: int = 2, threshold: float = 0.8) -> dict[str, Column]:
    """The station reports' conditions by name."""
    made = (C.has_broken_base(), C.is_empty(), C.docked_between(a, b), C.is_full(), C.has_reservation(), C.heavy_use(threshold))
    return dict(zip(CONDITIONS, made, strict=True))


def hour_number(label: Column) -> Column:
    """Hours since 1970 plus one, of an hour label without a time zone (years from 1970 on)."""
    seconds = F.unix_seconds(F.to_timestamp_ntz(label).cast("timestamp"))
    return F.floor(seconds / HOUR).cast("bigint") + 1


def hour_bitmaps(snap: DataFrame, conditions: Mapping[str, Column] | None = None, partitions: int | None = None) -> DataFrame:
    """`name, bucket, seen` and a bitmap column per condition (0: no hour of the bucket)."""
    found = dict(conditions or default_conditions())
    hours = snap.select("name", hour_number(F.col("_id")).alias("h"), *[p.alias(n) for n, p in found.items()]).where("h IS NOT NULL")
    bit = F.expr(f"shiftleft(1L, CAST(pmod(h - 1, {BITS}) AS INT))")
    bucket = F.floor((F.col("h") - 1) / BITS).cast("bigint") + 1
    bits = [F.when(F.col(n), bit).otherwise(F.lit(0).cast("bigint")).alias(n) for n in found]
    rows = hours.select("name", bucket.alias("bucket"), bit.alias("seen"), *bits)
    if partitions is not None:
        rows = rows.repartition(partitions, "name", "bucket")
    return rows.groupBy("name", "bucket").agg(*[F.bit_or(c).alias(c) for c in ("seen", *found)])


def _hour_of(label: str) -> int:
    since = datetime.datetime.fromisoformat(label) - datetime.datetime(1970, 1, 1)
    return since // datetime.timedelta(hours=1) + 1


def _bucket_of(hour: int) -> int:
    return (hour - 1) // BITS + 1


def _as_long(bits: int) -> int:
    """The low 64 bits as a signed long."""
    bits &= (1 << BITS) - 1
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def interval_mask(first: int, last: int) -> Column:
    """The interval's hours in a row's `bucket`: all of them but in the buckets of its ends."""
    low, high = _as_long(-1 << (first - 1) % BITS), _as_long((2 << (last - 1) % BITS) - 1)
    every = F.lit(-1).cast("bigint")
    after = F.when(F.col("bucket") == _bucket_of(first), F.lit(low).cast("bigint")).otherwise(every)
    until = F.when(F.col("bucket") == _bucket_of(last), F.lit(high).cast("bigint")).otherwise(every)
    return after.bitwiseAND(until)


def hours_where(bitmaps: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Hours per station from `first` to `last` (labels, inclusive; none: open): `name, seen` and
    a count per condition. Stations not seen in the interval are left out.
    """
    kinds = [c for c in bitmaps.columns if c not in ("name", "bucket")]
    if first is not None or last is not None:
        a = 1 if first is None else max(1, _hour_of(first))
        b = _hour_of("9999-12-31T23:00:00") if last is None else max(0, _hour_of(last))
        if a > b:
            bitmaps = bitmaps.limit(0)
        else:
            inside = bitmaps.where(F.col("bucket").between(_bucket_of(a), _bucket_of(b)))
            mask = interval_mask(a, b)
            bitmaps = inside.select("name", *[F.col(c).bitwiseAND(mask).alias(c) for c in kinds])
    counts = bitmaps.groupBy("name").agg(*[F.sum(F.bit_count(c)).cast("bigint").alias(c) for c in kinds])
    return counts.where("seen > 0")


def never(bitmaps: DataFrame, condition: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stations seen in the interval, in none of whose hours the condition held: `name`."""
    return hours_where(bitmaps.select("name", "bucket", "seen", condition), first, last).where(F.col(condition) == 0).select("name")


def complement_hours(bitmaps: DataFrame, condition: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Hours in the interval in which the condition did not hold: `name, n`."""
    hours = hours_where(bitmaps.select("name", "bucket", "seen", condition), first, last)
    return hours.select("name", (F.col("seen") - F.col(condition)).alias("n"))
