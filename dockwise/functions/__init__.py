"""Column expressions used by the reports."""

from dockwise.functions.columns import *  # noqa: F401,F403
