"""The operators as queries over the test tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    decontaminate, jaccard_join, line_dedup, packing, periodic_runs, quality_classifier, quality_rules, sharding, spelling,
    substring_dedup, suffix_dedup, toxicity, warc,
)
from tillwise.llm.shared import configure_texts, fold, table
from tillwise.llm.sql import ORACLE


def tokenizer_path() -> str:
    """The 50k byte-level BPE among the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return _predicted(toxicity.score_toxicity(docs, model), 0.5)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels"))
    return _predicted(quality_classifier.score_quality(docs, model), 0.3)


def _predicted(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("n_lines")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.line_report(docs, line_dedup.keep_bitmaps(docs))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_digests(spark, warc.write_archive(table(spark, sf_dir, "pages")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(spelling.vocabulary(spelling.spelled_runs(table(spark, sf_dir, "documents"))))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.with_planted_periods(table(spark, sf_dir, "documents")))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_toxicity, op2_decontamination, op3_sharding, op4_quality_rules, op5_packing, op6_substring_dedup, op7_jaccard_join,
        op8_quality, op9_line_dedup, op10_warc, op11_spelling, op12_periodic_runs, op13_suffix_dedup,
    )
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(run):
        return lambda spark, sf_dir: run(configure_texts(spark), sf_dir)

    return {name: bind(run) for name, run in {**QUERIES, "pipeline": pipeline}.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
