"""Hand-worked input tables (see FIXTURES.md section 3)."""

from dockwise.schemas import SNAPSHOT, TRIP

# (user_type, user_day_code, origin, destination, travel_time, unplug_hourTime)
TRIPS = [
    (1, "u1", 10, 10, 50, "2021-06-19T15:00:00Z"),
    (1, "u1", 10, 20, 51, "2021-06-19T16:00:00Z"),
    (1, "u2", 20, 20, 150, "2021-06-19T17:00:00Z"),
    (2, "u3", 20, 10, 250, "2021-06-19T18:00:00Z"),
    (3, "u4", 10, 10, 1200, "2021-06-20T15:00:00Z"),
    (3, "u5", 30, 10, 1800, "2021-06-20T17:00:00Z"),
    (1, "u6", 20, 30, 1801, "2021-06-20T00:00:00Z"),
    (1, "u7", 10, 20, 4050, "2021-06-21T23:00:00Z"),
    (1, "u8", 20, 10, 4051, "2021-06-21T15:00:00Z"),
    (7, "u9", 30, 30, 19999, "2021-06-21T09:00:00Z"),
    (7, "u9", 10, 30, 20000, "2021-06-21T09:00:00Z"),
    (6, "u10", 20, 20, 600, "2021-06-21T16:00:00Z"),
]

# hour -> [(name, total, free, reserved, docked, activate)]
SNAPSHOTS = [
    ("h1", [("A", 10, 8, 0, 2, 1), ("B", 10, 0, 0, 10, 1), ("Miguel Moya", 24, 20, 1, 3, 1)]),
    ("h2", [("A", 10, 10, 0, 0, 1), ("B", 10, 1, 1, 7, 1), ("Miguel Moya", 24, 24, 0, 0, 1)]),
    ("h3", []),
    ("h4", [("A", 10, 7, 2, 1, 1), ("B", 10, 0, 0, 10, 0), ("Miguel Moya", 24, 0, 0, 24, 1)]),
]


def trips_df(spark, data=TRIPS):
    return spark.createDataFrame(data, TRIP)


def station_dict(name, total, free, reserved, docked, activate):
    return {
        "activate": activate,
        "name": name,
        "reservations_count": reserved,
        "total_bases": total,
        "free_bases": free,
        "dock_bikes": docked,
    }


def nested_snapshots_df(spark, data=SNAPSHOTS):
    fields = [f.name for f in SNAPSHOT["stations"].dataType.elementType.fields]
    rows = []
    for hour, stations in data:
        recs = []
        for s in stations:
            d = station_dict(*s)
            recs.append(tuple(d.get(f) for f in fields))
        rows.append((hour, recs))
    return spark.createDataFrame(rows, SNAPSHOT)
