"""Facts laid out by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.catalog import ParquetTables

#: The day that queries filter each fact by.
DAYS = {
    "store_sales": "ss_sold_date_sk",
    "web_sales": "ws_sold_date_sk",
    "store_returns": "sr_returned_date_sk",
    "web_returns": "wr_returned_date_sk",
    "web_clickstreams": "wcs_click_date_sk",
    "inventory": "inv_date_sk",
}


def write_by_day(tables, folder: str, names=tuple(DAYS), *, mode: str = "errorifexists") -> TablesByDay:
    """Write facts of ``tables`` under ``folder``, one parquet folder a day, and return the
    tables with those facts read from there.

    One shuffle a fact: rows are range-partitioned by day and a hash of the row, so that a
    task writes few days and a day of a third of all rows is written by many tasks. Rows
    without a day have a folder of their own. All columns are kept; the day comes last.
    ``mode`` overwrite replaces whole facts.
    """
    for name in names:
        fact, day = tables[name], DAYS[name]
        others = [F.col(f"`{c}`") for c in fact.columns if c != day]
        (
            fact.repartitionByRange(F.col(day), F.xxhash64(*others))
            .write.mode(mode).partitionBy(day).parquet(f"{folder.rstrip('/')}/{name}")
        )
    return TablesByDay(tables, folder, names)


class TablesByDay:
    """``tables`` with the facts ``names`` read from what ``write_by_day`` wrote.

    A join with filtered days of ``date_dim`` reads the folders of these days alone: Catalyst
    puts the day's partition filter, or the join's own days (dynamic pruning), on the scan.
    """

    def __init__(self, tables, folder: str, names=tuple(DAYS)):
        self.spark = tables.spark
        self._tables, self._names = tables, frozenset(names)
        self._facts = ParquetTables(tables.spark, folder)

    def __getitem__(self, name: str) -> DataFrame:
        return (self._facts if name in self._names else self._tables)[name]
