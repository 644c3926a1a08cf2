"""Strataphon: Spark-native analytics for large music libraries."""

__version__ = "0.1.0"
