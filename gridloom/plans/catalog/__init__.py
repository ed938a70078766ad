"""Every registered query with its DuckDB twin."""

from gridloom.plans.catalog import learning, measures, rows, series, storage, streams  # noqa: F401
from gridloom.plans.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
