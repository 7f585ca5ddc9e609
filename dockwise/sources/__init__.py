"""Sources: JSON Lines readers, the flat Parquet table, tables derived from lineitem."""

from dockwise.sources.json_lines import (  # noqa: F401
    drop_unused_trip_columns,
    flatten_snapshots,
    parse_json_lines,
    read_snapshot_lines,
    read_snapshots,
    read_trip_lines,
    read_trips,
    trip_fields,
)
