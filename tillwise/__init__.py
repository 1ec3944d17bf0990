"""Retail analytics as Spark DataFrame jobs."""

from tillwise.sources.catalog import ParquetTables
from tillwise.session import configure, intermediates

__all__ = ["ParquetTables", "configure", "intermediates"]
