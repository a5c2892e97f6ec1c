"""daygrain: time-series feature tables from trip records on Spark."""

__version__ = "0.1.0"
