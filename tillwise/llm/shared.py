"""Steps that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.session import configure, durable

#: Bounds what a task holds of long texts at once: rows read together, and bytes on their way
#: to and from Python.
TEXT_SETTINGS = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4MB",
}

#: A row is held out from learning where the CRC-32 of its id as text leaves 0 by 5.
FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def configure_texts(spark: SparkSession) -> SparkSession:
    """``configure``, and TEXT_SETTINGS unless the context has its own values."""
    configure(spark)
    chosen = spark.sparkContext.getConf()
    for key, value in TEXT_SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_names(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` whose columns that begin with an underscore, as those that operators add, have
    other names, but for the ``needed`` ones; and the names now."""
    free = "x" * (1 + max(map(len, docs.columns)))
    names = [f"{free}{i}" if c.startswith("_") and c not in needed else c for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, shards: int) -> DataFrame:
    """At most ``max_rows`` labelled training texts: text, label (0 or 1), shard.

    Rows are taken by a hash of their id, so the choice does not depend on the order of
    rows. The ids number at most ``max_rows``, which bounds what is broadcast. Held-out
    rows never take part. A document with several labels counts with the highest;
    labels other than 0 and 1 and null ids are left out.
    """
    own = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (fold("_id") != 0))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .withColumn("_order", F.xxhash64("_id"))
    )
    total = own.count()
    if total > max_rows:
        # Thinned before the exact limit, so that the limit sorts few rows more than it keeps.
        share = min(1.0, 1.1 * max_rows / total)
        own = own.filter(F.pmod("_order", F.lit(1 << 20)) <= int(share * (1 << 20)))
    chosen = own.orderBy("_order", "_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).filter(
        F.col("_id").isNotNull() & F.col("_text").isNotNull()
    )
    joined = texts.join(F.broadcast(chosen), "_id")
    return durable(
        joined.select(
            F.col("_text").alias("text"),
            F.col("_label").alias("label"),
            F.pmod(F.xxhash64(F.col("_id"), F.lit(17)), F.lit(shards)).cast("int").alias("shard"),
        )
    )


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, per_chunk: int = 50_000) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... without gaps within each group.

    No task gets a whole group: rows are dealt into chunks by a hash of ``order``, the
    chunks' sizes are summed up, and rows are numbered within their chunk. ``order``
    must tell the rows of a group apart; equal rows get any order.
    """
    rows = df.count()
    chunks = max(16, rows // per_chunk)
    dealt = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    sizes = dealt.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*group, "_chunk").orderBy(*order)
    return (
        dealt.join(starts, [*group, "_chunk"])
        .withColumn(name, F.col("_start") + F.row_number().over(within) - 1)
        .drop("_chunk", "_start")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (id, root) for each id that has an
    edge, root being the smallest id of its component.

    Each round points every neighbour of a node, and the node, at the smallest one seen
    (larger neighbours first, then smaller ones), until nothing changes; the number of
    rounds grows with the logarithm of the size. Every round is written as a table.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = durable(links)
    before = None
    while True:
        both = links.union(links.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
            F.col("a").alias("_n"), F.least("a", "_m").alias("_m")
        )
        # Large star: neighbours above the node point at the least of its neighbourhood.
        large = links.join(least, F.col("b") == F.col("_n")).select("a", F.col("_m").alias("b"))
        large = large.distinct()
        # Small star: neighbours below the node, and the node, point at the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("_m"))
        low = low.withColumnRenamed("a", "_n")
        small = large.join(low, F.col("a") == F.col("_n")).select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("_m").alias("y")),
                              F.struct(F.col("b").alias("x"), F.col("_m").alias("y")))).alias("e")
        ).select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).filter("a <> b").distinct()
        links = durable(small)
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    ids = links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return ids.union(links.select(F.col("b"), F.col("b")).distinct())

