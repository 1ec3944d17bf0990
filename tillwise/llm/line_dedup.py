"""Lines that many documents share, found without moving texts."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.shared import plain_names
from tillwise.session import durable

SPACE = " \t\n\x0b\f\r"
#: Stands for a null id: it compares as the smallest.
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _identity(doc_id: str, text: str) -> list[Column]:
    return [
        F.coalesce(F.col(doc_id), F.lit(NO_ID)).alias("_did"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_tid"),
    ]


def keep_bitmaps(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """Which lines stay, for each document that loses some: (_did, _tid, n_lines,
    n_dropped, keep), keep being the bitmap of kept lines as runs (first, n).

    A key (see ``line_key``) of at least ``min_chars`` code points in at least
    ``min_docs`` documents stays only in the largest id that holds it, in all its lines
    there. Hashes of keys (128 bits), ids and positions are range-partitioned by hash and
    id, so that a key that a third of all documents hold is spread over many tasks; they
    are sorted by position within, where the first line of each key and document streams out.
    Only these are counted, one row for a key and task, to find the count and the keeper.

    Rows with a null id count as one document, smaller than any other. Rows that repeat an
    id with another text count once for it, but each keeps its own bitmap. Null and empty
    texts are one empty line, and never lose it. Other columns are not read.
    """
    rows = docs.select(*_identity(doc_id, text), _lines(F.col(text)).alias("_lines"))
    lines = rows.select(
        "_did", "_tid", F.size("_lines").alias("_n"), F.posexplode("_lines").alias("_pos", "_line")
    ).filter(F.octet_length("_line") >= min_chars)
    keyed = lines.withColumn("_key", line_key(F.col("_line"))).filter(F.char_length("_key") >= min_chars)
    # Written first: partitioning by range reads its input twice.
    hashed = durable(
        keyed.select(
            F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"), "_did", "_tid", "_n", "_pos"
        )
    )
    # The window runs in the order of the range partitions, so it adds no exchange: rows of a
    # key and document stream past by position, and what repeats the row before goes.
    ranged = hashed.repartitionByRange("_h1", "_h2", "_did")
    inside = Window.partitionBy("_h1", "_h2", "_did").orderBy("_pos", "_tid")
    before = F.lag(F.struct("_pos", "_tid")).over(inside)
    held = durable(
        ranged.withColumn("_before", before)
        .filter(~F.col("_before").eqNullSafe(F.struct("_pos", "_tid")))
        .withColumn("_first", F.col("_before").isNull())
        .drop("_before")
    )
    shared = (
        held.filter("_first")
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_did").alias("_keeper"))
        .filter(F.col("_docs") >= min_docs)
    )
    dropped = (
        held.join(shared, ["_h1", "_h2"])
        .filter(F.col("_did") != F.col("_keeper"))
        .groupBy("_did", "_tid", F.col("_n").alias("n_lines"))
        .agg(F.sort_array(F.collect_list("_pos")).alias("_gone"))
    )
    gone = F.size("_gone")
    runs = F.transform(
        F.sequence(F.lit(0), gone),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(F.get("_gone", i - 1) + 1).alias("first"),
            (F.when(i == gone, F.col("n_lines")).otherwise(F.get("_gone", i))
             - F.when(i == 0, 0).otherwise(F.get("_gone", i - 1) + 1)).alias("n"),
        ),
    )
    return dropped.select(
        "_did", "_tid", "n_lines", gone.alias("n_dropped"), F.filter(runs, lambda r: r["n"] > 0).alias("keep")
    )


def _joined(docs: DataFrame, bitmaps: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, Column]:
    """``docs`` next to its bitmaps, and the text that stays."""
    own = [f"`{c}`" for c in docs.columns]
    marked = docs.select(*own, *_identity(doc_id, text))
    small = bitmaps.select("_did", "_tid", F.col("n_dropped").alias("_n_dropped"), F.col("keep").alias("_keep"))
    both = marked.join(small.hint("shuffle_hash"), ["_did", "_tid"], "left")
    lines = _lines(F.col(text))
    kept = F.array_join(
        F.flatten(F.transform("_keep", lambda r: F.slice(lines, r["first"] + 1, r["n"]))), "\n"
    )
    return both, F.when(F.col("_keep").isNull(), F.col(text)).otherwise(kept)


def drop_lines(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines gone that ``bitmaps`` (of ``keep_bitmaps``) leave out.
    Kept lines are joined by line feeds; a text that loses all of them becomes empty.
    Columns, and texts that lose nothing (null ones too), stay as they are."""
    plain, names = plain_names(docs, doc_id, text)
    both, kept = _joined(plain, bitmaps, doc_id, text)
    return both.select(*[(kept if n == text else F.col(f"`{n}`")).alias(c) for n, c in zip(names, docs.columns)])


def line_report(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: doc_id, n_lines, n_dropped, and the SHA-256 of the text that stays."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    both, kept = _joined(slim, bitmaps, "doc_id", "text")
    return both.select(
        "doc_id",
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.col("_n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(kept, F.lit("")), 256).alias("kept_sha256"),
    )
