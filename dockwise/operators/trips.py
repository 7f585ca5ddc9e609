"""Trip reports.

Input: one row per trip with `user_type, user_day_code, idunplug_station (origin),
idplug_station (destination), travel_time (seconds), unplug_hourTime`. Reports by
day or time of day derive `trip_date` / `trip_time` from `unplug_hourTime` unless the
frame already has them (a flat table from ``sources.flat_table``, where a date filter
also prunes the month or day folders).
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise import fixed_values as FV
from dockwise.functions import columns as C
from dockwise.operators import core
from dockwise.schemas import TRIP_COLUMNS

DEFAULT_DATE = FV.TRIP_DATE
DEFAULT_TIMES = FV.TRIP_TIMES
DEFAULT_STATION_ID = FV.STATION_ID
DEFAULT_RANGES = FV.DURATION_RANGES
USER_TYPES = FV.USER_TYPES

TRIP_REST = ("user_day_code", "user_type", "idunplug_station", "idplug_station", "travel_time")


# ---------------------------------------------------------------- derived columns


def with_trip_date(trips: DataFrame) -> DataFrame:
    """Add `trip_date` (`YYYY-MM-DD` of the unplug time) unless present."""
    if "trip_date" in trips.columns:
        return trips
    return trips.withColumn("trip_date", C.iso_date(C.unplug_timestamp()))


def with_trip_time(trips: DataFrame) -> DataFrame:
    """Add `trip_time` (`HH:MM:SS` of the unplug time) unless present."""
    if "trip_time" in trips.columns:
        return trips
    return trips.withColumn("trip_time", C.iso_time(C.unplug_timestamp()))


def trip_dates(trips: DataFrame) -> DataFrame:
    """`trip_date` followed by the trip fields."""
    return with_trip_date(trips).select("trip_date", *TRIP_COLUMNS)


def trip_times(trips: DataFrame) -> DataFrame:
    """`trip_time` followed by the trip fields."""
    return with_trip_time(trips).select("trip_time", *TRIP_COLUMNS)


def trip_preview(trips: DataFrame, n: int = FV.PREVIEW_ROWS) -> DataFrame:
    """The first `n` trips in a total order over all fields (a deterministic `take`)."""
    return core.top_k(trips.select(*TRIP_COLUMNS), [F.col(c).asc_nulls_first() for c in TRIP_COLUMNS], n)


# ---------------------------------------------------------------- user types


def trips_by_user_type(trips: DataFrame) -> DataFrame:
    """Trips per user type: `user_type, n`."""
    return core.count_by(trips, "user_type")


def trips_of_user_type(trips: DataFrame, user_type: int = FV.USER_TYPES[0]) -> DataFrame:
    """Trips of one user type, without the type."""
    return trips.where(F.col("user_type") == F.lit(user_type)).select(
        "user_day_code", "idunplug_station", "idplug_station", "travel_time", "unplug_hourTime"
    )


def trip_count_of_user_type(trips: DataFrame, user_type: int = FV.USER_TYPES[0]) -> DataFrame:
    return core.count_rows(trips.where(F.col("user_type") == F.lit(user_type)))


def trip_counts_of_user_types(trips: DataFrame, user_types: Sequence[int] = USER_TYPES) -> DataFrame:
    """Trip count for each listed type, zero when absent: `user_type, n`. One scan."""
    counts = trips.agg(
        *[
            F.count(F.when(F.col("user_type") == F.lit(t), F.lit(1))).alias(f"n{i}")
            for i, t in enumerate(user_types)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(int(t)).cast("bigint").alias("user_type"), F.col(f"n{i}").alias("n"))
            for i, t in enumerate(user_types)
        ]
    )
    return counts.select(F.inline(rows))


# ---------------------------------------------------------------- days


def trips_per_day(trips: DataFrame) -> DataFrame:
    """Trips per date: `trip_date, n`."""
    if "trip_date" in trips.columns:
        return core.count_by(trips, "trip_date")
    # Group on the DATE and label each group once, not every row.
    day = C.unplug_timestamp().cast("date")
    counts = core.count_by(trips.select(day.alias("_day")), "_day")
    return counts.select(F.col("_day").cast("string").alias("trip_date"), "n")


def _on_date(trips: DataFrame, date: str | datetime.date) -> DataFrame:
    date = date.isoformat()[:10] if isinstance(date, datetime.date) else str(date)
    if "trip_date" not in trips.columns and re.fullmatch(r"\d{4}-\d\d-\d\d", date):
        # The time's text starts with its date; this test reaches the Parquet reader.
        trips = trips.where(F.col("unplug_hourTime").startswith(date))
    on = with_trip_date(trips).where(F.col("trip_date") == F.lit(date))
    if "trip_period" in trips.columns:
        # A flat table is partitioned by month or day: name both, so the folders of
        # other periods are skipped whichever was used.
        on = on.where(F.col("trip_period").isin(date[:7], date[:10]))
    return on


def trips_on_date(trips: DataFrame, date: str = DEFAULT_DATE) -> DataFrame:
    return _on_date(trips, date).select(*TRIP_REST)


def trip_count_on_date(trips: DataFrame, date: str = DEFAULT_DATE) -> DataFrame:
    return core.count_rows(_on_date(trips, date))


def trips_on_date_by_user_type(trips: DataFrame, date: str = DEFAULT_DATE) -> DataFrame:
    """Trips per user type on one date: `user_type, n`."""
    return core.count_by(_on_date(trips, date), "user_type")


# ---------------------------------------------------------------- times of day


def trips_per_time(trips: DataFrame) -> DataFrame:
    """Trips per time of day: `trip_time, n`."""
    if "trip_time" in trips.columns:
        return core.count_by(trips, "trip_time")
    # Group on the full-precision label (one-to-one with the trimmed one) and trim
    # once per group, not every row.
    counts = core.count_by(trips.select(C.full_time(C.unplug_timestamp()).alias("_t")), "_t")
    return counts.select(C.trim_zero_micros(F.col("_t")).alias("trip_time"), "n")


def _in_times(trips: DataFrame, times: Sequence[str | datetime.time]) -> DataFrame:
    # Labels as the reports write them: microseconds only where there are any.
    times = [(t.isoformat() if isinstance(t, datetime.time) else str(t)).removesuffix(".000000") for t in times]
    if "trip_time" in trips.columns:
        return trips.where(F.col("trip_time").isin(*times))
    # A label without microseconds is the full-precision label minus ".000000", so
    # pad the few listed labels instead of trimming a label on every row.
    full = [t if "." in t else f"{t}.000000" for t in times]
    return trips.where(C.full_time(C.unplug_timestamp()).isin(*full))


def trips_in_hours(trips: DataFrame, times: Sequence[str] = DEFAULT_TIMES) -> DataFrame:
    return _in_times(trips, times).select(*TRIP_REST)


def trip_count_in_hours(trips: DataFrame, times: Sequence[str] = DEFAULT_TIMES) -> DataFrame:
    return core.count_rows(_in_times(trips, times))


def durations_in_hours(trips: DataFrame, times: Sequence[str] = DEFAULT_TIMES) -> DataFrame:
    """`user_day_code, travel_time` of the trips started at the listed times."""
    return _in_times(trips, times).select("user_day_code", "travel_time")


def durations_in_hours_between(
    trips: DataFrame,
    times: Sequence[str] = DEFAULT_TIMES,
    min_s: int = FV.DURATION_RANGES[0][0],
    max_s: int = FV.DURATION_RANGES[0][1],
) -> DataFrame:
    return durations_in_hours(trips, times).where(
        F.col("travel_time").between(F.lit(min_s), F.lit(max_s))
    )


def duration_range_count(
    trips: DataFrame,
    times: Sequence[str] = DEFAULT_TIMES,
    ranges: Sequence[tuple[int, int]] = DEFAULT_RANGES,
) -> DataFrame:
    """For each closed range of seconds, how many of those trips fall in it:
    `min_s, max_s, n`. All ranges are counted in one scan."""
    tt = F.col("travel_time")
    counts = durations_in_hours(trips, times).agg(
        *[
            F.count(F.when(tt.between(F.lit(lo), F.lit(hi)), F.lit(1))).alias(f"n{i}")
            for i, (lo, hi) in enumerate(ranges)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(int(lo)).cast("bigint").alias("min_s"),
                F.lit(int(hi)).cast("bigint").alias("max_s"),
                F.col(f"n{i}").alias("n"),
            )
            for i, (lo, hi) in enumerate(ranges)
        ]
    )
    return counts.select(F.inline(rows))


# ---------------------------------------------------------------- durations


def _long(trips: DataFrame, min_s: int, inclusive: bool) -> DataFrame:
    tt = F.col("travel_time")
    return trips.where(tt >= F.lit(min_s) if inclusive else tt > F.lit(min_s))


def long_trip_count(trips: DataFrame, min_s: int = FV.LONG_TRIP_SECONDS, inclusive: bool = True) -> DataFrame:
    """Trips of at least `min_s` seconds (more than, if not inclusive): `n`."""
    return core.count_rows(_long(trips, min_s, inclusive))


def long_trip_mean_minutes(
    trips: DataFrame, min_s: int = FV.LONG_TRIP_SECONDS, inclusive: bool = True
) -> DataFrame:
    """Total seconds of those trips and their mean in minutes: `total_s, mean_minutes`."""
    total = F.sum("travel_time")
    mean = F.try_divide(total.cast("double"), F.count(F.lit(1)).cast("double")) / F.lit(60.0)
    return _long(trips, min_s, inclusive).agg(total.alias("total_s"), mean.alias("mean_minutes"))


def duration_histogram(trips: DataFrame) -> DataFrame:
    """Trips per exact travel time: `travel_time, n`."""
    return core.count_by(trips, "travel_time")


def duration_bins(
    trips: DataFrame,
    width: int = FV.BIN_WIDTH_SECONDS,
    cap: int = FV.BIN_CAP_SECONDS,
    max_bin: float | None = None,
) -> DataFrame:
    """Trips shorter than `cap` per half-even bin of `width` seconds: `bin, n`.

    With `max_bin`, only bins up to it are kept (filtered before aggregating).
    """
    binned = trips.where(F.col("travel_time") < F.lit(cap)).select(
        C.half_even_bin("travel_time", width).alias("bin")
    )
    if max_bin is not None:
        binned = binned.where(F.col("bin") <= F.lit(float(max_bin)))
    return core.count_by(binned, "bin")


def duration_bins_trimmed(
    trips: DataFrame,
    width: int = FV.BIN_WIDTH_SECONDS,
    cap: int = FV.BIN_CAP_SECONDS,
    max_bin: float = FV.MAX_BIN,
) -> DataFrame:
    return duration_bins(trips, width, cap, max_bin)


# ---------------------------------------------------------------- stations


def departures_per_station(trips: DataFrame) -> DataFrame:
    """Trips started per origin station: `idunplug_station, n`."""
    return core.count_by(trips, "idunplug_station")


def arrivals_per_station(trips: DataFrame) -> DataFrame:
    """Trips ended per destination station: `idplug_station, n`."""
    return core.count_by(trips, "idplug_station")


def min_departures(trips: DataFrame) -> DataFrame:
    """Smallest number of departures of any origin station: `n`."""
    return departures_per_station(trips).agg(F.min("n").alias("n"))


def least_departures_station(trips: DataFrame, ties: str = "all") -> DataFrame:
    """Origin station(s) with the fewest departures: `idunplug_station, n`.

    ``ties="all"`` keeps every station at the minimum; ``ties="first"`` keeps the one
    with the smallest id. Only stations seen as an origin take part.
    """
    counts = departures_per_station(trips)
    if ties == "first":
        return core.top_k(counts, [F.col("n").asc(), F.col("idunplug_station").asc_nulls_first()], 1)
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    return core.rows_at_min(counts, "n").select("idunplug_station", "n")


def trips_from_station(trips: DataFrame, station: int = DEFAULT_STATION_ID) -> DataFrame:
    """`user_day_code, idplug_station, travel_time` of trips leaving one station."""
    return trips.where(F.col("idunplug_station") == F.lit(station)).select(
        "user_day_code", "idplug_station", "travel_time"
    )


def trips_from_least_station(trips: DataFrame) -> DataFrame:
    """Trips leaving the station(s) with the fewest departures, found and used on the
    cluster (a semi-join; no station id goes through the driver). Trips without an origin
    count as one station, as in the station counts."""
    least = least_departures_station(trips)
    return core.semi_join(trips, least, "idunplug_station").select(
        "user_day_code", "idplug_station", "travel_time"
    )


def busiest_origins(trips: DataFrame, k: int = FV.TOP_K) -> DataFrame:
    """The `k` origins with most departures (ties broken by smaller id): `idunplug_station, n`."""
    counts = departures_per_station(trips)
    return core.top_k(counts, [F.col("n").desc(), F.col("idunplug_station").asc_nulls_first()], k)


def busiest_destinations(trips: DataFrame, k: int = FV.TOP_K) -> DataFrame:
    """The `k` destinations with most arrivals: `idplug_station, n`."""
    counts = arrivals_per_station(trips)
    return core.top_k(counts, [F.col("n").desc(), F.col("idplug_station").asc_nulls_first()], k)


# ---------------------------------------------------------------- round trips


def _round(trips: DataFrame) -> DataFrame:
    # Plain equality: a trip with both ends unknown is not a round trip.
    return trips.where(F.col("idunplug_station") == F.col("idplug_station"))


def round_trips(trips: DataFrame) -> DataFrame:
    """Trips ending where they started."""
    return _round(trips).select("idunplug_station", "user_day_code", "idplug_station", "travel_time")


def round_trip_count(trips: DataFrame, distinct_users: bool = False) -> DataFrame:
    """Number of round trips, or of distinct `user_day_code` among them: `n`."""
    r = _round(trips)
    if distinct_users:
        return core.count_rows(r.select("user_day_code").distinct())
    return core.count_rows(r)


def round_trips_per_station(trips: DataFrame) -> DataFrame:
    """Round trips per station: `idunplug_station, n`."""
    return core.count_by(_round(trips), "idunplug_station")


def round_trip_mean_per_station(trips: DataFrame) -> DataFrame:
    """Mean round-trip duration per station, in seconds: `idunplug_station, mean_s`."""
    return core.mean_by(_round(trips), "idunplug_station", "travel_time", name="mean_s")


def round_trips_per_user(trips: DataFrame) -> DataFrame:
    """Round trips per user code: `user_day_code, n`."""
    return core.count_by(_round(trips), "user_day_code")
