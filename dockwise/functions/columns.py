"""Column expressions shared by the station and trip reports.

Everything here is a native Catalyst expression, so it stays inside whole-stage
codegen and can be pushed into scans where Spark allows it. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- stations


def broken_bases() -> Column:
    """Bases neither free, reserved nor holding a bike: total - free - reserved - docked."""
    return (
        F.col("total_bases")
        - F.col("free_bases")
        - F.col("reservations_count")
        - F.col("dock_bikes")
    )


def has_broken_base() -> Column:
    """total_bases > free_bases + reservations_count + dock_bikes."""
    return F.col("total_bases") > (
        F.col("free_bases") + F.col("reservations_count") + F.col("dock_bikes")
    )


def docked_between(a: int, b: int) -> Column:
    """a <= dock_bikes <= b (closed range)."""
    return F.col("dock_bikes").between(F.lit(a), F.lit(b))


def is_empty() -> Column:
    return F.col("dock_bikes") == F.lit(0)


def is_full() -> Column:
    """dock_bikes = total_bases. Null on either side is not full (plain SQL equality)."""
    return F.col("dock_bikes") == F.col("total_bases")


def has_reservation() -> Column:
    return F.col("reservations_count") > F.lit(0)


def heavy_use(threshold: float = 0.8, inclusive: bool = True) -> Column:
    """free_bases >= threshold * total_bases, in double arithmetic (`>` if not inclusive)."""
    bound = F.col("total_bases") * F.lit(float(threshold))
    return F.col("free_bases") >= bound if inclusive else F.col("free_bases") > bound


def free_ratio() -> Column:
    """free_bases / total_bases as double; null when the station has no bases."""
    return F.try_divide(
        F.col("free_bases").cast("double"), F.col("total_bases").cast("double")
    )


# ---------------------------------------------------------------- trips


def unplug_timestamp(col: str | Column = "unplug_hourTime") -> Column:
    """Naive timestamp of the unplug time: the ISO string without its last character.

    Parsed as TIMESTAMP_NTZ so the session time zone never shifts it.
    """
    c = F.col(col) if isinstance(col, str) else col
    # One reference to `c`: filters get no common-subexpression elimination, and a
    # computed input would otherwise be evaluated once per reference.
    return F.to_timestamp_ntz(F.regexp_replace(c, F.lit("(?s).$"), F.lit("")))


def iso_date(ts: Column) -> Column:
    """`YYYY-MM-DD` label of a naive timestamp (DATE -> STRING, no formatter per row)."""
    return ts.cast("date").cast("string")


def full_time(ts: Column) -> Column:
    """`HH:MM:SS.ffffff` label of a naive timestamp (always six fraction digits)."""
    return F.date_format(ts, "HH:mm:ss.SSSSSS")


def trim_zero_micros(label: Column) -> Column:
    """Drop a `.000000` fraction: `full_time` becomes the `isoformat` time label."""
    return F.regexp_replace(label, F.lit(r"\.000000$"), F.lit(""))


def iso_time(ts: Column) -> Column:
    """`HH:MM:SS` label, with `.ffffff` appended only when there are microseconds."""
    return trim_zero_micros(full_time(ts))


def half_even_bin(col: str | Column, width: int = 100) -> Column:
    """Bin number of `col` at `width`: col / width rounded half to even, as double.

    For width 100 this equals round(col, -2) / 100 with banker's rounding.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.bround(c.cast("double") / F.lit(float(width)), 0)
