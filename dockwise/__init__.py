"""dockwise: bike-share station and trip analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
