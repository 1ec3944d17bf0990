"""Stretches of a text that repeat one period three times or more, word for word.

Method, per document (internal pattern matching): the words' suffix array comes from prefix
doubling, whose ranks at every power of two name the dyadic blocks. A run with period q in
[B, 2B) holds a block of B words at a multiple of B, and the same block q words further on;
periods below 16 hold one of 8 words. So each such block asks where it occurs in the window
behind it: a range successor query in a wavelet tree over its interval of the suffix array.
Occurrences at most B / 2 apart form a progression, all inside one stretch of that smaller
period, and only the shifts that carry the ends of the block's own stretch onto those of the
occurrences' can be periods. Candidates are widened by longest common extensions and kept
if long enough.

Documents are independent of each other: no shuffle. A null text, an empty one and one of white
space have no words and no runs; repeated rows and null ids are treated like any other row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.words import Powers, Texts, list_array, map_batches, nonspace_bytes, pieces, ragged, words_of

LEAST_WORDS = 24
LEAST_EXPONENT = 3
#: Blocks of 8 words find every period below 16: 2 * 8 - 1 + q words are at most 24 for q
#: up to 9, and at most 3 * q beyond.
FIRST_LEVEL = 3


class Wavelet:
    """A wavelet tree over numbers, kept as one array of zero counts for each bit."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.top = 1 << self.bits
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            counts = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~ones, out=counts[1:])
            self.zeros.append(counts)
            values = np.concatenate((values[~ones], values[ones]))

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest number of at least ``least`` at places low .. high - 1, or ``top``."""
        skip = self._below(low, high, least)
        found = skip < high - low
        result = np.full(len(low), self.top, np.int64)
        result[found] = self._nth(low[found], high[found], skip[found])
        return result

    def _below(self, low, high, least):
        beyond = least >= self.top
        least = np.where(beyond, self.top - 1, least)
        count = np.zeros(len(low), np.int64)
        first, last = low, high
        for level, zeros in enumerate(self.zeros):
            z0, z1 = zeros[first], zeros[last]
            up = (least >> (self.bits - 1 - level)) & 1 == 1
            count += np.where(up, z1 - z0, 0)
            first = np.where(up, zeros[-1] + first - z0, z0)
            last = np.where(up, zeros[-1] + last - z1, z1)
        return np.where(beyond, high - low, count)

    def _nth(self, low, high, nth):
        value = np.zeros(len(low), np.int64)
        for zeros in self.zeros:
            z0, z1 = zeros[low], zeros[high]
            up = nth >= z1 - z0
            value = 2 * value + up
            nth = np.where(up, nth - (z1 - z0), nth)
            low = np.where(up, zeros[-1] + low - z0, z0)
            high = np.where(up, zeros[-1] + high - z1, z1)
        return value


class Suffixes:
    """Ranks of all factors whose length is a power of two, and the suffix array."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        _, rank = np.unique(words, return_inverse=True)
        self.ranks, size = [rank.astype(np.int64)], 1
        while self.ranks[-1].max(initial=0) + 1 < n:
            rank = self.ranks[-1]
            pair = (rank + 1) * (n + 1)
            pair[: n - size] += rank[size:] + 1
            _, rank = np.unique(pair, return_inverse=True)
            self.ranks.append(rank.astype(np.int64))
            size *= 2
        self.array = np.argsort(self.ranks[-1])
        self.tree = Wavelet(self.array)

    def interval(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of the suffix array that starts with the block of 2^level words at ``at``."""
        ends = np.cumsum(np.bincount(self.ranks[level]))
        high = ends[self.ranks[level][at]]
        return np.where(self.ranks[level][at] > 0, ends[self.ranks[level][at] - 1], 0), high

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            step = self.ranks[level][a] == self.ranks[level][b]
            for x in (a, b, n):
                x[step] += 1 << level
        return n

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            size = 1 << level
            step = (a >= size) & (b >= size)
            step[step] = self.ranks[level][a[step] - size] == self.ranks[level][b[step] - size]
            for x, by in ((a, -size), (b, -size), (n, size)):
                x[step] += by
        return n


def find_runs(
    words: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs, by start, then period. ``words`` are
    numbers; one that occurs once, such as the end mark of a text, is in no run. The last must be
    such a mark. Needs least_words >= 24 and least_exponent >= 3."""
    if len(words) <= least_words:
        return (np.empty(0, np.int64),) * 3
    suffixes = Suffixes(words)
    found = []
    for level in range(FIRST_LEVEL, len(suffixes.ranks)):
        block = 1 << level
        at = np.arange(0, len(words) - block, block)
        low, high = suffixes.interval(level, at)
        again = high - low > 1
        at, low, high = at[again], low[again], high[again]
        first, last = (1 if level == FIRST_LEVEL else block), 2 * block
        here = suffixes.tree.successor(low, high, at + first)
        while True:
            inside = here < at + last
            at, low, high, here = at[inside], low[inside], high[inside], here[inside]
            if not len(at):
                break
            found.append((at, here - at))
            following = suffixes.tree.successor(low, high, here + 1)
            step = following - here
            near = np.flatnonzero(step <= block // 2)
            if len(near):
                step, own, other = step[near], at[near], here[near]
                ends = other + step + suffixes.right(other, other + step)
                shift_right = ends - own - step - suffixes.right(own, own + step)
                shift_left = other - suffixes.left(other, other + step) - own + suffixes.left(own, own + step)
                for shift in (shift_right, shift_left):
                    fits = (shift >= first) & (shift < last)
                    found.append((own[fits], shift[fits]))
                behind = other + (ends - block - other) // step * step + 1
                following[near] = suffixes.tree.successor(low[near], high[near], behind)
            here = following
    if not found:
        return (np.empty(0, np.int64),) * 3
    pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found)], axis=1), axis=0)
    at, period = pairs[:, 0], pairs[:, 1]
    start = at - suffixes.left(at, at + period)
    end = at + period + suffixes.right(at, at + period)
    long = end - start >= np.maximum(least_words, least_exponent * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # A multiple of the period gives the same stretch.
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _piece(texts: Texts, powers: Powers, member: np.ndarray):
    """Numbers of words, runs and collapsed texts of a piece."""
    words = words_of(texts, member, powers)
    counts = words.counts()
    rows = len(texts)
    # An end mark that occurs once behind each text.
    place = np.arange(len(words.hashes)) + words.owner()
    _, number = np.unique(words.hashes, return_inverse=True)
    marked = np.full(len(number) + rows, -1, np.int64)
    marked[place] = number
    marks = marked < 0
    marked[marks] = len(number) + np.arange(rows)
    start, end, period = find_runs(marked)
    owner = np.searchsorted(np.flatnonzero(marks), start)
    first = words.first[:-1] + np.arange(rows)

    kept = np.zeros(len(marked) + 1, np.int64)
    np.add.at(kept, start + period, 1)
    np.add.at(kept, end, -1)
    kept = (np.cumsum(kept[:-1]) == 0)[place]
    # Kept words with one blank behind each, then without the last one of a text.
    lengths = words.ends[kept] - words.starts[kept] + 1
    at = ragged(words.starts[kept], lengths)
    stops = np.cumsum(lengths)
    padded = np.append(texts.data, np.uint8(32))
    data = padded[at]
    data[stops - 1] = 32
    kept_counts = np.add.reduceat(np.append(kept, False), words.first[:-1]) if rows else np.empty(0, np.int64)
    kept_counts[counts == 0] = 0
    bounds = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(kept_counts)))]
    body = data.tobytes()
    collapsed = [body[a : max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:])]
    runs = np.bincount(owner, minlength=rows)
    return counts, runs, start - first[owner], end - start, period, collapsed


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def period_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``docs``: ``doc_id``, n_words, runs (start, length, period; by start,
    then period) and ``collapsed``: the words that no run holds after its first period, with one
    blank between. Words are cut at ASCII white space."""

    def make():
        powers, member = Powers(), nonspace_bytes()
        kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

        def each(batch: pa.RecordBatch):
            for texts in pieces(batch.column(1)):
                counts, runs, start, length, period, collapsed = _piece(texts, powers, member)
                found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts)),
                        pa.array(counts, pa.int64()),
                        list_array(found, np.concatenate(([0], np.cumsum(runs)))),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

        return each

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string",
        make,
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where about a tenth of the texts, by the CRC-32 of their id, go on
    periodically from a word on. A null id or a text without words stays."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g, n = F.floor(F.col("_crc") / 10), F.size("_words").cast("long")
    planted = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_n") - 1),
        lambda i: F.get("_words", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))),
    )
    return (
        docs.select("doc_id", "text", crc.alias("_crc"))
        .withColumn("_words", F.when(F.col("_crc") % 10 == 0, words))
        .withColumn("_n", n)
        .withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
        .withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8)))
        .select("doc_id", F.when(F.col("_n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
    )


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the run of greatest length by period, and
    digests of all runs and of the collapsed text."""
    best = F.expr(
        """aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, run) ->
           case when best is null or run.length * best.period > best.length * run.period then run else best end)"""
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return period_runs(docs).withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
