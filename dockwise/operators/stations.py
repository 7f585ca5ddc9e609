"""Station availability reports over the flat snapshot table.

Input: one row per (hour, station) with at least `_id, name, activate, total_bases,
free_bases, reservations_count, dock_bikes` (see ``dockwise.sources.flatten_snapshots``
or ``dockwise.sources.derived.snapshots_from_lineitem``).

Per-station logs come in two forms. ``grouped=False`` (default) is the long table
`(name, _id, value)`: one row per logged hour, fully parallel. ``grouped=True``
turns it into `(name, page, log)` with sorted arrays of bounded size
(``core.log_pages``); for a month of hourly data every station fits on one page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise import fixed_values as FV
from dockwise.functions import columns as C
from dockwise.operators import core
from dockwise.schemas import SNAPSHOT_REPORT_COLUMNS

DEFAULT_STATION = FV.STATION_NAME
DEFAULT_LOW, DEFAULT_HIGH = FV.OCCUPANCY_RANGE
DEFAULT_SHARE = FV.HEAVY_USE_SHARE


# Entries per page of a grouped log; a month of hourly snapshots (720) fits on one.
PAGE_SIZE = 1024


def _log(long: DataFrame, grouped: bool, page_size: int) -> DataFrame:
    return core.log_pages(long, "name", page_size=page_size) if grouped else long


def snapshot_preview(snap: DataFrame, n: int = FV.PREVIEW_ROWS) -> DataFrame:
    """The first `n` station rows in a total order over the report columns."""
    cols = [c for c in SNAPSHOT_REPORT_COLUMNS if c in snap.columns]
    return core.top_k(snap.select(*cols), [F.col(c).asc_nulls_first() for c in cols], n)


# ---------------------------------------------------------------- 1. stations per hour


def stations_per_hour(snap: DataFrame) -> DataFrame:
    """Station rows per snapshot hour: `_id, n`."""
    return core.count_by(snap, "_id")


def avg_stations_per_hour(snap: DataFrame) -> DataFrame:
    """Mean station rows per hour: `avg_stations` (null for no data)."""
    return stations_per_hour(snap).agg(F.avg("n").alias("avg_stations"))


def activation_counts(snap: DataFrame) -> DataFrame:
    """Rows per `activate` value: `activate, n`."""
    return core.count_by(snap, "activate")


def inactive_stations(snap: DataFrame) -> DataFrame:
    """(hour, station) rows with `activate = 0`: `_id, name`."""
    return snap.where(F.col("activate") == 0).select("_id", "name")


# ---------------------------------------------------------------- 2. one station


def station_capacity(snap: DataFrame, name: str = DEFAULT_STATION) -> DataFrame:
    """Capacity of one station: `name, total_bases` (one row per distinct capacity)."""
    return snap.where(F.col("name") == F.lit(name)).select("name", "total_bases").distinct()


def station_dock_series(snap: DataFrame, name: str = DEFAULT_STATION) -> DataFrame:
    """Docked bikes of one station per hour: `_id, dock_bikes`."""
    return snap.where(F.col("name") == F.lit(name)).select("_id", "dock_bikes")


def station_empty_hours(snap: DataFrame, name: str = DEFAULT_STATION) -> DataFrame:
    """Hours at which one station held no bike: `_id`."""
    return snap.where((F.col("name") == F.lit(name)) & C.is_empty()).select("_id")


# ---------------------------------------------------------------- 3. broken bases


def broken_stations(snap: DataFrame) -> DataFrame:
    """Stations that ever had a broken base: `name`."""
    return core.distinct_where(snap, C.has_broken_base(), "name")


def broken_station_count(snap: DataFrame, approx: bool = False) -> DataFrame:
    return core.count_distinct_where(snap, C.has_broken_base(), "name", approx=approx)


def never_broken_stations(snap: DataFrame) -> DataFrame:
    return core.never_where(snap, C.has_broken_base(), "name")


def broken_log(snap: DataFrame, grouped: bool = False, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per station, the hours with broken bases and how many: `name, _id, broken_bases`."""
    long = snap.where(C.has_broken_base()).select(
        "name", "_id", C.broken_bases().alias("broken_bases")
    )
    return _log(long, grouped, page_size)


# ---------------------------------------------------------------- 4. occupancy range


def occupancy_range_stations(snap: DataFrame, a: int = DEFAULT_LOW, b: int = DEFAULT_HIGH) -> DataFrame:
    """Stations that ever held between `a` and `b` bikes (inclusive): `name`."""
    return core.distinct_where(snap, C.docked_between(a, b), "name")


def occupancy_range_count(
    snap: DataFrame, a: int = DEFAULT_LOW, b: int = DEFAULT_HIGH, approx: bool = False
) -> DataFrame:
    return core.count_distinct_where(snap, C.docked_between(a, b), "name", approx=approx)


def never_in_range_stations(snap: DataFrame, a: int = DEFAULT_LOW, b: int = DEFAULT_HIGH) -> DataFrame:
    return core.never_where(snap, C.docked_between(a, b), "name")


def occupancy_range_log(
    snap: DataFrame,
    a: int = DEFAULT_LOW,
    b: int = DEFAULT_HIGH,
    grouped: bool = False,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Per station, hours holding between `a` and `b` bikes: `name, _id, dock_bikes`."""
    long = snap.where(C.docked_between(a, b)).select("name", "_id", "dock_bikes")
    return _log(long, grouped, page_size)


# ---------------------------------------------------------------- 4b. empty


def empty_stations(snap: DataFrame) -> DataFrame:
    """Stations that were ever empty: `name`."""
    return core.distinct_where(snap, C.is_empty(), "name")


def empty_station_count(snap: DataFrame, approx: bool = False) -> DataFrame:
    return core.count_distinct_where(snap, C.is_empty(), "name", approx=approx)


def never_empty_stations(snap: DataFrame) -> DataFrame:
    return core.never_where(snap, C.is_empty(), "name")


def empty_log(
    snap: DataFrame,
    grouped: bool = False,
    page_size: int = PAGE_SIZE,
    as_written: bool = False,
    a: int = DEFAULT_LOW,
    b: int = DEFAULT_HIGH,
) -> DataFrame:
    """Per station, the hours it was empty: `name, _id, dock_bikes`.

    ``as_written=True`` gives what the reference's code computes at this step, which
    repeats the occupancy-range filter (`a`, `b`) instead of testing for zero bikes.
    """
    lo, hi = (a, b) if as_written else (0, 0)
    return occupancy_range_log(snap, lo, hi, grouped, page_size)


# ---------------------------------------------------------------- 5. reservations


def reservation_value_counts(snap: DataFrame) -> DataFrame:
    """Rows per `reservations_count` value: `reservations_count, n`."""
    return core.count_by(snap, "reservations_count")


def reserved_stations(snap: DataFrame) -> DataFrame:
    """Stations with a reservation at some hour: `name`."""
    return core.distinct_where(snap, C.has_reservation(), "name")


def reserved_station_count(snap: DataFrame, approx: bool = False) -> DataFrame:
    return core.count_distinct_where(snap, C.has_reservation(), "name", approx=approx)


def reserved_station_pct(snap: DataFrame, total: int | None = None) -> DataFrame:
    """Percent of stations with a reservation: `pct`.

    The denominator is the number of distinct stations seen, or `total` if given
    (``fixed_values.STATION_COUNT`` reproduces the original fixed denominator).
    """
    return core.share_where(snap, C.has_reservation(), "name", total=total)


def reservation_log(snap: DataFrame, grouped: bool = False, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per station, hours with reservations and how many: `name, _id, reservations_count`."""
    long = snap.where(C.has_reservation()).select("name", "_id", "reservations_count")
    return _log(long, grouped, page_size)


# ---------------------------------------------------------------- 6. full


def full_stations(snap: DataFrame) -> DataFrame:
    """Stations that were ever full (`dock_bikes = total_bases`): `name`."""
    return core.distinct_where(snap, C.is_full(), "name")


def full_station_count(snap: DataFrame, approx: bool = False) -> DataFrame:
    return core.count_distinct_where(snap, C.is_full(), "name", approx=approx)


def full_log(snap: DataFrame, grouped: bool = False, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per station, the hours it was full: `name, _id`."""
    long = snap.where(C.is_full()).select("name", "_id")
    return _log(long, grouped, page_size)


def full_hours_per_station(snap: DataFrame) -> DataFrame:
    """Number of full (hour, station) rows per station: `name, n`."""
    return core.count_by(snap.where(C.is_full()), "name")


# ---------------------------------------------------------------- 7. heavy use


def heavy_use_stations(
    snap: DataFrame, threshold: float = DEFAULT_SHARE, inclusive: bool = True
) -> DataFrame:
    """Stations with at some hour `free_bases >= threshold * total_bases`: `name`."""
    return core.distinct_where(snap, C.heavy_use(threshold, inclusive), "name")


def heavy_use_count(
    snap: DataFrame, threshold: float = DEFAULT_SHARE, inclusive: bool = True, approx: bool = False
) -> DataFrame:
    return core.count_distinct_where(snap, C.heavy_use(threshold, inclusive), "name", approx=approx)


def heavy_use_log(
    snap: DataFrame,
    threshold: float = DEFAULT_SHARE,
    inclusive: bool = True,
    grouped: bool = False,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Per station, heavy-use hours and the free share: `name, _id, free_ratio`.

    `free_ratio` is null for a station without bases (it still passes the test).
    """
    long = snap.where(C.heavy_use(threshold, inclusive)).select(
        "name", "_id", C.free_ratio().alias("free_ratio")
    )
    return _log(long, grouped, page_size)


def heavy_use_full_hours(
    snap: DataFrame, threshold: float = DEFAULT_SHARE, inclusive: bool = True
) -> DataFrame:
    """For stations with heavy use, the hours at which they were full: `name, _id`.

    A semi-join of the full rows to the heavy-use station names, which are broadcast if
    they are counted to be few.
    """
    heavy = heavy_use_stations(snap, threshold, inclusive)
    full = snap.where(C.is_full()).select("name", "_id")
    return core.semi_join(full, heavy, "name")


# ---------------------------------------------------------------- 8. histogram


def dock_histogram(snap: DataFrame) -> DataFrame:
    """Rows per docked-bikes value: `dock_bikes, n`."""
    return core.count_by(snap, "dock_bikes")
