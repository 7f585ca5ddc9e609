"""ANSI SQL (DuckDB dialect) for the tables derived from `lineitem`, used as the
independent oracle of every registered query.

The derivation mirrors ``dockwise.sources.derived`` column for column; the two are
written separately on purpose, one as DataFrame expressions and one as SQL text.
"""

from __future__ import annotations

SNAP_CTE = """snap AS (
  SELECT _id, name, CAST(id AS BIGINT) AS id, CAST(activate AS BIGINT) AS activate,
         CAST(total_bases AS BIGINT) AS total_bases, CAST(free_bases AS BIGINT) AS free_bases,
         CAST(reservations_count AS BIGINT) AS reservations_count,
         CAST(dock_bikes AS BIGINT) AS dock_bikes, l_orderkey
  FROM (
    SELECT *, total_bases - dock_bikes - reservations_count - broken AS free_bases FROM (
      SELECT *, least(total_bases - dock_bikes - reservations_count,
                      CASE WHEN l_suppkey % 20 = 7 THEN 0
                           WHEN l_orderkey % 5 = 0 THEN 1 + l_partkey % 2
                           ELSE 0 END) AS broken FROM (
        SELECT *, least(total_bases - dock_bikes,
                        CASE WHEN l_suppkey % 10 = 0 THEN 0
                             ELSE greatest(0, l_partkey % 8 - 4) END) AS reservations_count FROM (
          SELECT *, lo + (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % (hi - lo + 1) AS dock_bikes FROM (
            SELECT *,
                   CAST(CASE WHEN l_suppkey % 5 = 0 THEN total_bases // 2
                             WHEN l_suppkey % 4 = 0 THEN 3 ELSE 0 END AS BIGINT) AS lo,
                   CAST(CASE WHEN l_suppkey % 3 = 0 THEN total_bases - 1
                             ELSE total_bases END AS BIGINT) AS hi FROM (
              SELECT strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00' AS _id,
                     'Station ' || CAST(l_suppkey AS VARCHAR) AS name,
                     l_suppkey AS id,
                     CASE WHEN l_orderkey % 997 = 0 THEN 0 ELSE 1 END AS activate,
                     CAST(12 + l_suppkey % 19 AS BIGINT) AS total_bases,
                     l_orderkey, l_partkey, l_suppkey,
                     CAST(l_linenumber AS BIGINT) AS l_linenumber
              FROM lineitem)))))))"""

TRIPS_CTE = """trips AS (
  SELECT CAST(l_linenumber AS BIGINT) AS user_type,
         CAST(l_orderkey AS VARCHAR) AS user_day_code,
         CAST(l_suppkey + 1 AS BIGINT) AS idunplug_station,
         CAST(CASE WHEN l_partkey % 10 = 0 THEN l_suppkey + 1
                   ELSE l_partkey % 100 + 1 END AS BIGINT) AS idplug_station,
         CASE WHEN l_orderkey % 50 = 0 THEN CAST(floor(l_extendedprice) AS BIGINT)
              ELSE CAST(floor(l_extendedprice) AS BIGINT) % 4500 END AS travel_time,
         strftime(l_shipdate, '%Y-%m-%d') || 'T'
           || lpad(CAST(CAST(trunc(l_quantity) AS BIGINT) % 24 AS VARCHAR), 2, '0')
           || ':00:00Z' AS unplug_hourTime
  FROM lineitem),
trips_dt AS (
  SELECT *,
         strftime(CAST(left(unplug_hourTime, length(unplug_hourTime) - 1) AS TIMESTAMP), '%Y-%m-%d') AS trip_date,
         strftime(CAST(left(unplug_hourTime, length(unplug_hourTime) - 1) AS TIMESTAMP), '%H:%M:%S') AS trip_time
  FROM trips)"""

TRIP_COLS = "user_type, user_day_code, idunplug_station, idplug_station, travel_time, unplug_hourTime"


def on_snap(body: str) -> str:
    return f"WITH {SNAP_CTE}\n{body}"


def on_trips(body: str) -> str:
    return f"WITH {TRIPS_CTE}\n{body}"
