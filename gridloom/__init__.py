"""Hourly time-series analytics as composable PySpark DataFrame transformations."""
