"""Cleaning, date resolution and record linkage for loan tables, as Spark DataFrame jobs."""

__version__ = "0.1.0"
