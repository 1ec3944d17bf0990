"""Benchmark passages inside documents, found by fingerprints of item-sized windows."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import plain_names
from tillwise.llm.words import (
    SHINGLE, Powers, first_marks, map_batches, pieces, plain_word_bytes, ragged, shingles_of, words_of,
)

BLOCKS = 8  # of 8 bits each
FILTER_BITS = 20
SLICE = 1 << 16  # places whose bits are held at once
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def covered(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places that windows of ``width`` cover, as begin and length, and each window's run."""
    new = np.diff(starts, prepend=starts[:1] - width - 1) > width
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(starts)) - 1
    return starts[begin], starts[last] + width - starts[begin], np.cumsum(new) - 1


def fingerprints(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of ``width`` shingle hashes at each of the starts, which are sorted,
    as 8 bytes. A shingle weighs as often as it occurs; a bit is set where more than half of
    the weight sets it.

    Bits are counted by running sums, eight at a time, over slices of the places that windows cover.
    """
    out = np.empty((len(starts), BLOCKS), np.uint8)
    new = np.minimum(np.diff(starts, prepend=starts[:1] - width), width)  # places that no window before has
    slices = np.cumsum(new) // max(width, SLICE)
    edges = np.append(np.flatnonzero(first_marks(slices)), len(starts))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        own = starts[low:high]
        begin, many, run = covered(own, width)
        places = shingles[ragged(begin, many)].view(np.uint8).reshape(-1, BLOCKS)
        at = (np.cumsum(many) - many - begin)[run] + own
        for b in range(BLOCKS):
            bits = np.unpackbits(places[:, b : b + 1], axis=1)
            sums = np.zeros((len(bits) + 1, 8), np.int32)
            np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
            out[low:high, b] = np.packbits(2 * (sums[at + width] - sums[at]) > width, axis=1)[:, 0]
    return out


@dataclass
class SameLength:
    """Items with the same number of shingles, and their multi-index: for each block and
    each of its 256 values, which items differ in few enough bits there."""

    items: np.ndarray
    shingles: np.ndarray
    prints: np.ndarray
    near: np.ndarray

    @staticmethod
    def of(items: np.ndarray, shingles: np.ndarray, radius: int) -> SameLength:
        items_at = np.arange(len(shingles), dtype=np.int64) * shingles.shape[1]
        prints = fingerprints(np.ascontiguousarray(shingles).reshape(-1), items_at, shingles.shape[1])
        values = np.arange(256, dtype=np.uint8)
        near = np.stack([ONES[values[:, None] ^ prints[None, :, b]] <= radius // BLOCKS for b in range(BLOCKS)])
        return SameLength(items, shingles, prints, near)

    def within(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) whose fingerprints differ in at most ``radius`` bits: among
        BLOCKS blocks one differs in at most radius // BLOCKS bits, so it is looked up."""
        rows, columns = [], []
        step = max(1, (1 << 22) // max(1, len(self.items)))
        for at in range(0, len(prints), step):
            part = prints[at : at + step]
            found = self.near[0][part[:, 0]]
            for b in range(1, BLOCKS):
                found = found | self.near[b][part[:, b]]
            r, c = np.nonzero(found)
            close = ONES[part[r] ^ self.prints[c]].sum(axis=1) <= radius
            rows.append(r[close] + at)
            columns.append(c[close])
        return np.concatenate(rows), np.concatenate(columns)


def weighted_jaccard(shingles: np.ndarray, starts: np.ndarray, width: int, item: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of the window of ``width`` shingles at each of the
    starts, which are sorted, to the item: the sum of the smaller shingle counts over the sum
    of the larger ones.

    A shingle that the item has c times counts in a window as long as at most c - 1 of the same
    stand before it there, so each place counts for one range of starts, and the ranges are
    counted by their ends. Time and memory go with the places, not with places times width.
    """
    own, counts = np.unique(item, return_counts=True)
    places = ragged(*covered(starts, width)[:2])
    at = np.searchsorted(own, shingles[places])
    at[at == len(own)] = 0
    known = own[at] == shingles[places]
    places, at = places[known], at[known]
    order = np.argsort(at, kind="stable")
    place, code = places[order], at[order]
    back = np.arange(len(order)) - counts[code]
    earlier = np.where(back >= np.searchsorted(code, code), place[back], -1)
    low = np.sort(np.maximum(place - width, earlier) + 1)
    shared = np.searchsorted(low, starts, side="right") - np.searchsorted(places, starts)
    return shared / (width + len(item) - shared)


class Benchmark:
    """An index over benchmark items, for one size of shingle."""

    def __init__(self, size: int, items: list[tuple[int, np.ndarray]], radius: int, similarity: float):
        self.size, self.radius, self.similarity = size, radius, similarity
        lengths = np.array([len(s) for _, s in items])
        flat = np.concatenate([s for _, s in items])
        owner = np.repeat(lengths, lengths)
        order = np.lexsort((owner, flat))
        flat, owner = flat[order], owner[order]
        new = first_marks(flat) | first_marks(owner)
        # Known shingles, and the lengths of the items that hold each of them.
        flat, self.lengths = flat[new], owner[new]
        first = first_marks(flat)
        self.known = flat[first]
        self.first = np.append(np.flatnonzero(first), len(flat))
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.known >> np.uint64(64 - FILTER_BITS)] = True
        self.groups = {
            int(m): SameLength.of(
                np.array([i for i, s in items if len(s) == m]), np.stack([s for _, s in items if len(s) == m]), radius
            )
            for m in np.unique(lengths)
        }

    def search(self, shingles: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """(text, item, similarity, start, shingles in the window) of every window that
        is similar enough. Windows without a shingle of an item of their length have
        similarity 0 and are not fingerprinted; a text shorter than the item is a window."""
        hits = np.flatnonzero(self.maybe[shingles >> np.uint64(64 - FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.known, shingles[hits]), len(self.known) - 1)
        same = self.known[at] == shingles[hits]
        hits, at = hits[same], at[same]
        if not len(hits):
            return []
        many = self.first[at + 1] - self.first[at]
        length = self.lengths[ragged(self.first[at], many)]
        place = np.repeat(hits, many)
        found = []
        for m in np.unique(length):
            where = place[length == m]
            text = np.searchsorted(first, where, side="right") - 1
            low, high = first[text], np.maximum(first[text + 1] - m, first[text])
            begin, end = np.maximum(where - m + 1, low), np.minimum(where, high)
            # Both rise from hit to hit; each hit adds the starts that none before it has.
            begin[1:] = np.maximum(begin[1:], end[:-1] + 1)
            starts = ragged(begin, np.maximum(end - begin + 1, 0))
            text = np.searchsorted(first, starts, side="right") - 1
            width = np.minimum(m, first[text + 1] - starts)
            for w in np.unique(width):
                own = starts[width == w]
                group = self.groups[int(m)]
                rows, columns = group.within(fingerprints(shingles, own, int(w)), self.radius)
                for c in np.unique(columns):
                    r = rows[columns == c]
                    score = weighted_jaccard(shingles, own[r], int(w), group.shingles[c])
                    good = score >= self.similarity
                    r, score = r[good], score[good]
                    if len(r):
                        found.append((text[width == w][r], np.full(len(r), group.items[c]), score, own[r], np.full(len(r), w)))
        return found


def index_items(items: pa.Table, radius: int, similarity: float) -> list[Benchmark]:
    """Indexes of the items with at least one word; an item of fewer than five words is one
    shingle of all its words."""
    by_size: dict[int, list] = {}
    powers, ids = Powers(), items["item_id"].to_numpy()
    for piece in pieces(items["text"].combine_chunks() if items.num_rows else pa.array([], pa.string())):
        words = words_of(piece, plain_word_bytes(), powers)
        counts = words.counts()
        for size in np.unique(np.minimum(counts, SHINGLE)):
            if size:
                shingles, first = shingles_of(words, int(size))
                for i in np.flatnonzero(np.minimum(counts, SHINGLE) == size):
                    item = (int(ids[piece.first + i]), shingles[first[i] : first[i + 1]])
                    by_size.setdefault(int(size), []).append(item)
    return [Benchmark(size, own, radius, similarity) for size, own in by_size.items()]


def best_matches(texts: pa.Array, indexes: list[Benchmark], powers: Powers) -> tuple[np.ndarray, ...]:
    """(row, item, similarity, start word, words) of the best window of each text and item."""
    parts = []
    for piece in pieces(texts):
        words = words_of(piece, plain_word_bytes(), powers)
        counts = words.counts()
        for index in indexes:
            shingles, first = shingles_of(words, index.size)
            for row, item, score, start, width in index.search(shingles, first):
                length = np.minimum(width + index.size - 1, counts[row])
                parts.append((row + piece.first, item, score, start - first[row], length))
    if not parts:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.float64, np.int64, np.int64))
    row, item, score, start, length = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.lexsort((start, -score, item, row))
    row, item, score, start, length = (a[order] for a in (row, item, score, start, length))
    best = first_marks(row) | first_marks(item)
    return row[best], item[best], score[best], start[best], length[best]


def _indexes(benchmark: DataFrame, item_id: str, text: str, radius: int, similarity: float, block_bytes: int):
    """The benchmark's indexes, a block of items at a time, each broadcast on its own."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.lower(F.col(text)).alias("text")).dropna()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        made = cloudpickle.dumps(index_items(own, radius, similarity))
        yield benchmark.sparkSession.sparkContext.broadcast(made)


def _map(docs: DataFrame, schema: str, sent, make_output: Callable) -> DataFrame:
    def make():
        powers, indexes = Powers(), pickle.loads(sent.value)
        return lambda batch: make_output(batch, best_matches(batch.column("_text"), indexes, powers))

    return map_batches(docs, schema, make)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", similarity: float = 0.8, radius: int = 23, block_bytes: int = 16 << 20,
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): the best window of each document
    for each benchmark item it is similar to.

    Words are runs of letters and digits in lower case. Every window with as many words as
    an item is compared: 64-bit SimHash fingerprints of its five-word shingles, a multi-index
    over 8 blocks that finds all items within ``radius`` bits, then the exact weighted Jaccard
    similarity of the shingles. At similarity 0.8 about one fingerprint in 100,000 differs in
    more than 23 bits.

    The documents are read once for each ``block_bytes`` of benchmark text (one pass below
    16 MB) and nothing is shuffled; an index of one block, some ten times its text, is what
    is broadcast. Null or wordless texts and items match nothing, nor do items with a null
    id. Equal items each match; repeated rows and null document ids give rows like others.
    Other columns are not read.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("_text"))
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"

    def rows(batch, found):
        row, item, score, start, length = found
        if len(row):
            ids = batch.column("doc_id").take(pa.array(row))
            arrays = [ids, pa.array(item), pa.array(score), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "similarity", "start_word", "n_words"])

    result = None
    for sent in _indexes(benchmark, item_id, item_text, radius, similarity, block_bytes):
        one = _map(chosen, schema, sent, rows)
        result = one if result is None else result.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    similarity: float = 0.8, radius: int = 23, block_bytes: int = 16 << 20,
) -> DataFrame:
    """``docs`` without the rows that ``find_benchmark`` would report; columns stay as they are."""
    plain, names = plain_names(docs, text)
    lowered = plain.select(*[F.col(f"`{c}`") for c in names], F.lower(F.col(text)).alias("_text"))
    schema = lowered.schema

    def rows(batch, found):
        clean = np.ones(batch.num_rows, bool)
        clean[found[0]] = False
        yield batch.filter(pa.array(clean))

    for sent in _indexes(benchmark, item_id, item_text, radius, similarity, block_bytes):
        lowered = _map(lowered, schema, sent, rows)
    return lowered.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, docs.columns)])
