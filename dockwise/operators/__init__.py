"""Report operators: generic (`core`), station (`stations`) and trip (`trips`)."""

from dockwise.operators import core, stations, trips  # noqa: F401
