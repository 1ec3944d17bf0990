"""Retail tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwise.sources.schemas import SCHEMAS


class ParquetTables:
    """Parquet tables under one folder: ``tables["item"]`` reads ``<root>/item``.

    The files say which columns there are and of which type, read from one footer. Columns
    the queries need have their declared type, and are NULL where the files lack them; all
    other columns of the files are there too, for queries of your own.
    """

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.suffix = suffix

    def __getitem__(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}{self.suffix}"
        found = self.spark.read.parquet(path)
        if name not in SCHEMAS:
            return found
        declared = StructType.fromDDL(SCHEMAS[name])
        known = {f.name.lower() for f in declared}
        others = [f for f in found.schema if f.name.lower() not in known]
        return self.spark.read.schema(StructType([*declared, *others])).parquet(path)
