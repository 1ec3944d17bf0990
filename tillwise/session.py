"""Session settings and durable intermediates."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are designed for. None of them depends on the size
# of the cluster; spark.sql.shuffle.partitions stays whatever the cluster says.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs a later aggregate one shuffle more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Catalyst broadcasts a side only while its estimated size is below this. The estimate goes by
    # compressed files; what the driver holds of such a side is some ten times as much or more.
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    # Bounds what a task holds of long texts on their way to and from Python.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
    # The JVM does not compile longer methods; generated code beyond that runs slowly.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


CONFIGURED = "tillwise.configured"


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_SETTINGS once a session, leaving alone what the user set on the context
    or on the session (a value other than Spark's own default)."""
    chosen = spark.sparkContext.getConf()
    if spark.conf.get(CONFIGURED, None) is None:
        fresh = spark.newSession().conf
        for key, value in RUNTIME_SETTINGS.items():
            if not chosen.contains(key) and spark.conf.get(key, None) == fresh.get(key, None):
                spark.conf.set(key, value)
        spark.conf.set(CONFIGURED, "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


_OWNED: ContextVar[list[DataFrame] | None] = ContextVar("owned", default=None)


@contextmanager
def intermediates() -> Iterator[None]:
    """Owner of the tables that ``durable`` writes inside the block; they are deleted when it
    ends, also by an error. Read or write the results inside it::

        with intermediates():
            plans.q18(tables).write.parquet(...)
    """
    owned: list[DataFrame] = []
    outer = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(outer)
        for table in owned:
            release(table)


def durable(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it from there.

    Later steps neither recompute it nor lose it with an executor, and Catalyst knows
    its true size, so it broadcasts the table only if it is small. ``intermediates``
    deletes it; without it the table stays. With ``by`` each value of that column
    has a folder, and a filter on it reads only that.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.durable_path = path
    if (owned := _OWNED.get()) is not None:
        owned.append(table)
    return table


def release(table: DataFrame) -> None:
    """Delete the files of a table that ``durable`` wrote. Nothing may read it afterwards."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.durable_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let the driver forget what nothing refers to any more. Spark deletes the shuffle files of
    finished jobs only then, which many rounds of a job would pile up until the driver
    happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
