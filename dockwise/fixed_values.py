"""The literals of the original analysis, used as parameter defaults.

They are stated here as given so that default calls reproduce the original reports.
Every one of them is a parameter of the function that uses it.
"""

# Fixed values (as given, in the order the analysis uses them).
STATION_NAME = "Miguel Moya"
OCCUPANCY_RANGE = (1, 2)
STATION_COUNT = 264
HEAVY_USE_SHARE = 0.8
USER_TYPES = (1, 2, 3, 6, 7)
TRIP_DATE = "2021-06-19"
TRIP_TIMES = ("15:00:00", "16:00:00", "17:00:00")
DURATION_RANGES = ((1200, 1800), (600, 900))
LONG_TRIP_SECONDS = 1800
BIN_WIDTH_SECONDS = 100
BIN_CAP_SECONDS = 20000
MAX_BIN = 40
STATION_ID = 2009
TOP_K = 3
PREVIEW_ROWS = 20
