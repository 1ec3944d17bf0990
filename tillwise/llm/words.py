"""Words, lines and shingles of Arrow text columns as numpy arrays.

All functions work on whole texts. A batch is cut between rows into pieces of about
``PIECE_BYTES`` so that the arrays stay small; a longer text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

PIECE_BYTES = 1 << 18
SHINGLE = 5

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def byte_class(members: bytes) -> np.ndarray:
    """A table over the 256 bytes that is True for ``members``."""
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain_word_bytes() -> np.ndarray:
    """Bytes of words that ignore punctuation: ASCII letters and digits, and every
    byte of a character outside ASCII."""
    return byte_class(ALNUM + bytes(range(128, 256)))


def nonspace_bytes() -> np.ndarray:
    """Bytes of words that are cut at ASCII white space only."""
    return ~byte_class(SPACE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), PIECE_BYTES)
            for name, base in (("up", BASE), ("down", INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, all at once."""
    n = len(data)
    up, down = powers.upto(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Texts:
    """A piece of a text column: its bytes, where each text starts, and its row numbers."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of a piece: spans, hashes, and the number of the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a text column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Texts]:
    data, offsets = buffers(texts)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        stop = min(max(stop, at + 1), rows)
        low, high = offsets[at], offsets[stop]
        yield Texts(data[low:high], offsets[at : stop + 1] - low, at)
        at = stop


def spans(texts: Texts, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of member bytes, cut where a text ends."""
    inside = member[texts.data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    cuts = texts.offsets[1:-1]
    before[cuts[cuts < len(inside)]] = False
    after[cuts[cuts > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words_of(texts: Texts, member: np.ndarray, powers: Powers) -> Words:
    starts, ends = spans(texts, member)
    first = np.searchsorted(starts, texts.offsets)
    return Words(starts, ends, span_hashes(texts.data, starts, ends, powers), first)


def shingles_of(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words, in order, and the number of the first
    shingle of each text. A text of fewer words has one shingle of all its words, a
    text without words has none."""
    counts = words.counts()
    total = len(words.hashes)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(made)))
    at = np.arange(first[-1]) - np.repeat(first[:-1], made) + np.repeat(words.first[:-1], made)
    stop = np.repeat(words.first[1:], made)
    padded = np.concatenate((words.hashes, np.zeros(1, np.uint64)))
    mixed = np.zeros(len(at), np.uint64)
    for j in range(size):
        where = np.where(at + j < stop, at + j, total)
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + padded[where]
    return mix(mixed), first


def first_marks(values: np.ndarray) -> np.ndarray:
    """True at the first of each run of equal values in a sorted array."""
    marks = np.ones(len(values), bool)
    marks[1:] = values[1:] != values[:-1]
    return marks


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start .. start + length - 1 of every span, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def map_batches(df: DataFrame, schema, make: Callable[[], Callable]) -> DataFrame:
    """``mapInArrow`` where ``make()`` gives, once per task, a function from a record
    batch to an iterator of record batches."""

    def run(batches):
        each = make()
        for batch in batches:
            if batch.num_rows:
                yield from each(batch)

    return df.mapInArrow(run, schema)
