"""From raw documents to packed token sequences, a stage at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import decontaminate, jaccard_join, line_dedup, packing, quality_classifier
from tillwise.llm.registry import tokenizer_path
from tillwise.llm.shared import configure_texts, table
from tillwise.session import durable

#: Documents below this quality score go.
LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    model = quality_classifier.fit_quality(docs, table(configure_texts(spark), sf_dir, "labels"))
    return quality_classifier.keep_quality(docs, model, LEAST_QUALITY)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with four or more others; n_chars follows."""
    configure_texts(spark)
    kept = line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs))
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates; of several texts with
    that id, the one whose digest comes first; of rows that repeat both, one. Rows with a null
    id stay."""
    configure_texts(spark)
    classes = jaccard_join.text_classes(docs.filter(F.col("doc_id").isNotNull()))
    first = classes.groupBy("class_no").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select("first.*")
    # A column name that no document has.
    own = "_digest" + "_" * max(map(len, docs.columns))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn(own, F.unhex(F.sha2(text, 256)))
    first = first.withColumnRenamed("digest", own).hint("shuffle_hash")
    kept = marked.join(first, ["doc_id", own], "left_semi").dropDuplicates(["doc_id", own]).drop(own)
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(configure_texts(spark), sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their place in sequences of 2048 tokens."""
    configure_texts(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_shared_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: SQL has no trained classifier; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over all documents; each one's result is written as a
    Parquet table and read again."""
    docs = table(configure_texts(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
