from tillwise.sources.catalog import ParquetTables
from tillwise.sources.layout import TablesByDay, write_by_day
from tillwise.sources.sinks import write_delimited

__all__ = ["ParquetTables", "TablesByDay", "write_by_day", "write_delimited"]
