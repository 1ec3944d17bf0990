"""Quality rules whose thresholds follow each language and source."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.words import (
    Powers, Texts, byte_class, map_batches, nonspace_bytes, pieces, shingles_of, span_hashes, words_of,
)
from tillwise.session import durable

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeats(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values that belong to texts: whether the text holds the value more than once,
    and whether it held it before."""
    order = np.lexsort((np.arange(len(values)), values, owner))
    o, v = owner[order], values[order]
    again = np.zeros(len(v), bool)
    again[1:] = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    many = again.copy()
    many[:-1] |= again[1:]
    back_many, back_again = np.empty_like(many), np.empty_like(again)
    back_many[order], back_again[order] = many, again
    return back_many, back_again


def measure(texts: Texts, powers: Powers) -> dict[str, np.ndarray]:
    n = len(texts)
    owner_of = lambda at: np.searchsorted(texts.offsets, at, side="right") - 1
    data = texts.data
    inside = nonspace_bytes()
    words = words_of(texts, inside, powers)
    owner = words.owner()
    # Code points: bytes that do not continue a character.
    points = np.concatenate(([0], np.cumsum(((data & 0xC0) != 0x80) & inside[data])))
    symbols = np.concatenate(([0], np.cumsum(byte_class(SYMBOLS)[data])))
    # Lines end at line feeds and at the end of each text.
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((texts.offsets[:-1], breaks + 1)), kind="stable")
    line_owner = np.sort(np.concatenate((np.arange(n), owner_of(breaks))), kind="stable")
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.flatnonzero(np.diff(line_owner, append=n))
    ends[last] = texts.offsets[line_owner[last] + 1]
    content = np.concatenate(([0], np.cumsum(inside[data])))
    full = content[ends] > content[starts]
    line_hash = span_hashes(data, starts[full], ends[full], powers)
    _, again = repeats(line_owner[full], line_hash)
    # Words in five-word windows that the text holds twice or more.
    shingle, first = shingles_of(words)
    long = words.counts() >= 5
    shingle_owner = np.repeat(np.arange(n), np.diff(first))
    many, _ = repeats(shingle_owner, shingle)
    many &= long[shingle_owner]
    at = np.flatnonzero(many)
    at = at - first[shingle_owner[at]] + words.first[shingle_owner[at]]
    change = np.zeros(len(words.hashes) + 6, np.int64)
    change[at] += 1
    np.add.at(change, at + 5, -1)
    covered = np.cumsum(change)[: len(words.hashes)] > 0
    return {
        "n_words": words.counts(),
        "word_chars": points[texts.offsets[1:]] - points[texts.offsets[:-1]],
        "n_symbols": symbols[texts.offsets[1:]] - symbols[texts.offsets[:-1]],
        "n_lines": np.bincount(line_owner, minlength=n),
        "n_dup_lines": np.bincount(line_owner[full][again], minlength=n),
        "n_repeat_words": np.bincount(owner[covered], minlength=n),
    }


def base_measures(docs: DataFrame, *, doc_id: str, text: str, lang: str, source: str) -> DataFrame:
    def make():
        powers = Powers()

        def each(batch):
            for piece in pieces(batch.column("text")):
                found = measure(piece, powers)
                part = batch.slice(piece.first, len(piece))
                columns = [part.column(c) for c in ("doc_id", "lang", "source")]
                columns += [pa.array(found[m], pa.int64()) for m in MEASURES]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "source", *MEASURES])

        return each

    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{m} long" for m in MEASURES)
    return map_batches(chosen, schema, make)


@dataclass(frozen=True)
class Rule:
    """A ratio, how far a group's quartiles may lie apart without counting as nearer than
    ``spread``, and whether low values fail too."""

    name: str
    over: str
    under: str
    spread: float
    both: bool = False

    def value(self) -> Column:
        return F.col(self.over) / F.greatest(F.col(self.under), F.lit(1))


RULES = (
    Rule("word_length", "word_chars", "n_words", 1.5, both=True),
    Rule("symbols", "n_symbols", "n_words", 0.05),
    Rule("dup_lines", "n_dup_lines", "n_lines", 0.1),
    Rule("repeats", "n_repeat_words", "n_words", 0.05),
)
#: Buckets of the sketch grow by this factor: quantiles are right to about 1 %.
GROWTH = 1.02


def sketch(values: DataFrame, keys: list[str]) -> DataFrame:
    """Quantile sketches as rows: for each key the number of values in each bucket, a bucket
    holding values up to GROWTH ** bucket (0 has a bucket of its own, the lowest). Sketches
    merge by adding counts, so Spark merges them before and after its shuffle."""
    bucket = F.when(F.col("value") > 0, F.ceil(F.log("value") / F.lit(math.log(GROWTH)))).otherwise(F.lit(-(1 << 31)))
    return values.groupBy(*keys, bucket.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """The value at each share of the sorted values, and how many values there are."""
    up = Window.partitionBy(*keys).orderBy("bucket")
    whole = Window.partitionBy(*keys)
    middle = F.when(F.col("bucket") == -(1 << 31), 0.0).otherwise(
        F.pow(F.lit(GROWTH), F.col("bucket")) * (2 / (1 + GROWTH))
    )
    summed = sketches.select(
        *keys, middle.alias("_value"), F.sum("n").over(up).alias("_upto"), F.sum("n").over(whole).alias("_all")
    )
    return summed.groupBy(*keys).agg(
        F.max("_all").alias("n"),
        *[F.min(F.when(F.col("_upto") >= F.col("_all") * q, F.col("_value"))).alias(name) for name, q in shares.items()],
    )


def quality_rules(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = 100, fence: float = 3.0, rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Measures of every text, base_failed, and kept.

    base_failed: fewer than 10 words, or over a fifth of the words in five-word windows that
    repeat. Of the other documents, those are kept whose ratios lie no further than ``fence``
    quartile distances outside the quartiles of their language and source. Groups of fewer
    than ``min_docs`` documents use the sketch of their language, merged from all its
    sources, and small languages that of all documents.

    Null texts have no words and fail. Null language and source are groups like others. Null
    ids and repeated rows are kept as they are. Other columns are not read. The texts are
    read once and not moved; what is shuffled is one row for each bucket of a sketch and task.
    """
    measured = durable(base_measures(docs, doc_id=doc_id, text=text, lang=lang, source=source))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    pairs = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), r.value().alias("value")) for r in rules]))
    values = measured.filter(~failed).select("lang", "source", pairs.alias("_p")).select("lang", "source", "_p.*")
    shares = {"low": 0.25, "high": 0.75}
    finest = sketch(values, ["lang", "source", "rule"])
    chosen = finest.select("lang", "source", "rule").distinct()
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        sketches = finest if level == 0 else merge(finest, [*keys, "rule"])
        found = quantiles(sketches, [*keys, "rule"], shares).filter(F.col("n") >= (min_docs if keys else 1)).select(
            *[F.col(k).alias(f"_{k}") for k in [*keys, "rule"]],
            F.col("low").alias(f"_low{level}"), F.col("high").alias(f"_high{level}"),
        )
        same = F.col("rule") == F.col("_rule")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        chosen = chosen.join(found, same, "left").drop(*[f"_{k}" for k in [*keys, "rule"]])
    chosen = chosen.select(
        "lang", "source", "rule",
        *[F.coalesce(*[F.col(f"_{c}{i}") for i in range(3)]).alias(c) for c in ("low", "high")],
    )
    wide = {}
    for r in rules:
        low, high = (F.max(F.when(F.col("rule") == r.name, F.col(c))) for c in ("low", "high"))
        reach = F.lit(fence) * F.greatest(high - low, F.lit(r.spread))
        wide[f"{r.name}_max"] = high + reach
        if r.both:
            wide[f"{r.name}_min"] = low - reach
    limits = chosen.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(
        *[c.alias(n) for n, c in wide.items()]
    )
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    passes = F.lit(True)
    for r in rules:
        passes = passes & (r.value() <= F.col(f"{r.name}_max"))
        if r.both:
            passes = passes & (r.value() >= F.col(f"{r.name}_min"))
    return joined.select(
        "doc_id", *MEASURES, failed.alias("base_failed"), (~failed & F.coalesce(passes, F.lit(False))).alias("kept")
    )
