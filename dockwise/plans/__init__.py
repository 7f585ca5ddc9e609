"""The query registry: every report with its DuckDB oracle SQL."""

from dockwise.plans.catalog import REGISTRY, oracle_sql, queries  # noqa: F401
