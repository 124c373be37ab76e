"""Spark-native warehouse loading, data quality and event analytics."""

__version__ = "0.1.0"
