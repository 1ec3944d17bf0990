"""Spelling variants of a vocabulary: words one letter apart, and the form each belongs to.

Method (PartEnum): a word's letters as a multiset are a binary vector with a dimension for each
letter and occurrence. One inserted or deleted letter changes one dimension, a replaced one two,
so near words have a Hamming distance of at most two. The dimensions are dealt into PARTS parts
by a hash; of two near words all parts but two agree, so the signatures, one for each choice of
two parts left out, over the rest of the parts, have one in common. They meet in an equi-join, and
each pair is verified letter by letter. Near words also share their first or their last letters
(half of the least length), which every signature is refined by: it splits the signatures of
frequent letters.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.words import list_array, map_batches, mix
from tillwise.session import durable, release

PARTS = 5
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form has at least so many times the occurrences of the word.
FORM_RATIO = 10

RUN_OF_LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spelled_runs(docs: DataFrame) -> DataFrame:
    """(word): every run of letters in the texts, A to Z lower-cased; where 31 divides the
    CRC-32 of ``<doc_id>:<run>``, one letter is missing. A null id counts as no text."""
    run = F.col("run")
    crc = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), run))
    at = (F.col("_crc") % F.char_length(run)).cast("int")
    letters = F.regexp_extract_all(F.col("text"), F.lit(RUN_OF_LETTERS), F.lit(0))
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return (
        docs.select("doc_id", F.explode(letters).alias("run"))
        .withColumn("run", F.translate("run", UPPER, LOWER))
        .withColumn("_crc", crc)
        .select(F.when(F.col("_crc") % 31 == 0, without).otherwise(run).alias("word"))
    )


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words of at least ``least_length`` code points that occur
    ``least_count`` times or more. Null words are left out."""
    return (
        words.filter(F.char_length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


def _signatures(words: pa.Array, affix: int) -> tuple[np.ndarray, int]:
    """A row of hashes for each word: one for each two parts left out, with its first letters and
    again with its last ones."""
    texts = words.to_pylist()
    lengths = np.array([len(x) for x in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    first = np.cumsum(lengths) - lengths

    order = np.lexsort((letters, owner))
    sorted_letters = letters[order]
    opens = np.ones(len(order), bool)
    opens[1:] = (sorted_letters[1:] != sorted_letters[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(order))
    occurrence = at - np.maximum.accumulate(np.where(opens, at, 0))
    dimension = mix(sorted_letters * np.uint64(1 << 20) + occurrence.astype(np.uint64))
    parts = np.zeros((len(texts), PARTS), np.uint64)
    np.add.at(parts, (owner, (dimension % np.uint64(PARTS)).astype(np.int64)), mix(dimension))
    total = parts.sum(axis=1, dtype=np.uint64)

    ends = []
    for base in (first, first + lengths - affix):
        code = np.zeros(len(texts), np.uint64)
        for j in range(affix):
            code = code * np.uint64(0xD6E8FEB86659FD93) + letters[base + j]
        ends.append(mix(code + np.uint64(len(ends) + 1)))
    rows = []
    for number, (i, j) in enumerate(itertools.combinations(range(PARTS), 2)):
        rest = mix(total - parts[:, i] - parts[:, j] + np.uint64(number))
        rows += [mix(rest ^ end) for end in ends]
    return np.stack(rows, axis=1), len(rows)


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n, near, near_n), both ways: all pairs of ``words`` (word, n; distinct) that differ
    by exactly one inserted, deleted or replaced code point. Words shorter than
    ``least_length`` (2 at least) must not occur."""
    affix = max(1, least_length // 2)

    def make():
        def each(batch: pa.RecordBatch):
            signatures, width = _signatures(batch.column(0), affix)
            offsets = np.arange(0, signatures.size + 1, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), list_array(pa.array(signatures.ravel().view(np.int64)), offsets)],
                names=["word", "n", "signatures"],
            )

        return each

    signed = map_batches(words.select("word", "n"), "word string, n bigint, signatures array<bigint>", make)
    keyed = signed.select("word", "n", F.explode("signatures").alias("_key"))
    other = keyed.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("_key").alias("_other"))
    # Each unordered pair is verified once, found by however many signatures.
    pairs = keyed.join(
        other,
        (F.col("_key") == F.col("_other"))
        & (F.col("word") < F.col("near"))
        & (F.abs(F.char_length("word") - F.char_length("near")) <= 1)
        & (F.levenshtein("word", "near", 1) == 1),
    ).select("word", "n", "near", "near_n")
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.distinct().select(F.inline(both))


def spelling_forms(words: DataFrame, least_length: int = LEAST_LENGTH, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n; distinct).

    A word's form is its near word with the largest n, of equal ones the first in code-point
    order, if that n is ``ratio`` times the word's or more. ``root`` follows forms to the last.
    As n grows by that ratio with each step, roots are found in about log2(log(n)) rounds.
    An empty table gives an empty table.
    """
    words = durable(words)
    # A word has a bounded number of near words: so many as there are letters and places.
    best = near_words(words, least_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("_best"),
    )
    leads = -F.col("_best.minus") >= ratio * F.col("n")
    formed = durable(
        words.join(best, "word", "left").select(
            "word",
            F.when(leads, F.col("_best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, -F.col("_best.minus")).alias("form_n"),
        )
    )
    roots = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    written = None
    while True:
        # Where the root so far has a root itself, that one takes its place.
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = durable(
            roots.join(onward, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
            )
        )
        if written is not None:
            release(written)
        written, roots = jumped, jumped.select("word", "root")
        if jumped.filter("_moved").isEmpty():
            break
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
