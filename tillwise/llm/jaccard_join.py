"""Documents whose five-word shingles have a Jaccard similarity above a bound."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import components
from tillwise.llm.words import Powers, first_marks, list_array, map_batches, mix, pieces, plain_word_bytes, shingles_of, words_of
from tillwise.session import durable

BANDS, ROWS = 20, 4
FRESH = 48
STEP = 8
BLOCK = 256


class MinHasher:
    """BANDS * ROWS hash functions for candidates and FRESH others for pruning."""

    def __init__(self, seed: int = 7):
        own = np.random.default_rng(seed)
        n = BANDS * ROWS + FRESH
        self.factor = own.integers(1, 1 << 32, n, np.uint64).astype(np.uint32) | np.uint32(1)
        self.shift = own.integers(0, 1 << 32, n, np.uint64).astype(np.uint32)

    def __call__(self, shingles: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Minima by text with shingles and hash function, and those texts."""
        texts = np.flatnonzero(np.diff(first))
        out = np.empty((len(texts), len(self.factor)), np.uint32)
        if len(texts):
            base = (shingles >> np.uint64(32)).astype(np.uint32)
            for h, (a, b) in enumerate(zip(self.factor, self.shift, strict=True)):
                x = base * a
                x += b
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x2C1B3C6D)
                out[:, h] = np.minimum.reduceat(x, first[texts])
        return out, texts


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(minima), BANDS), np.uint64)
    for r in range(ROWS):
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + minima[:, r : BANDS * ROWS : ROWS].astype(np.uint64) + np.uint64(1)
    return mix(keys + np.arange(BANDS, dtype=np.uint64))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, bands, fresh) of each row of (doc_id, digest, text); a text without
    words has no bands."""

    def make():
        powers, hasher = Powers(), MinHasher()

        def each(batch):
            for piece in pieces(batch.column("text")):
                minima, texts = hasher(*shingles_of(words_of(piece, plain_word_bytes(), powers)))
                part = batch.slice(piece.first, len(piece))
                counts = np.zeros(len(piece), np.int64)
                counts[texts] = BANDS
                offsets = np.concatenate(([0], np.cumsum(counts)))
                keys = band_keys(minima).view(np.int64).ravel()
                fresh: list = [None] * len(piece)
                for row, t in zip(np.ascontiguousarray(minima[:, BANDS * ROWS :]), texts.tolist(), strict=True):
                    fresh[t] = row.tobytes()
                arrays = [part.column("doc_id"), part.column("digest"), list_array(pa.array(keys), offsets), pa.array(fresh, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest", "bands", "fresh"])

        return each

    return map_batches(docs, "doc_id long, digest binary, bands array<long>, fresh binary", make)


def least_matches(compared: int, similarity: float, tolerance: float) -> int:
    """The fewest equal values among ``compared`` with which a pair stays: with fewer, the
    posterior probability of reaching the similarity (uniform prior) is below tolerance."""
    chance = 0.0
    for m in range(compared + 1):
        chance += comb(compared + 1, m) * similarity**m * (1 - similarity) ** (compared + 1 - m)
        if chance >= tolerance:
            return m
    return compared


def pruned_pairs(left: np.ndarray, right: np.ndarray, alive: np.ndarray, similarity: float, tolerance: float) -> np.ndarray:
    """Which pairs are left after comparing MinHash values a few at a time."""
    equal = np.zeros(alive.shape, np.int16)
    for at in range(0, FRESH, STEP):
        rows = np.flatnonzero(alive.any(axis=1))
        if not len(rows):
            break
        for h in range(at, at + STEP):
            equal[rows] += left[rows, h, None] == right[None, :, h]
        alive = alive & (equal >= least_matches(at + STEP, similarity, tolerance))
    return alive


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of all left with all right sets of sorted shingles, as
    a product of incidence matrices over shingles that both sides hold."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    sizes = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), 4096):
        part = shared[at : at + 4096]

        def incidence(sets, part=part):
            matrix = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], side="right")]
                place = np.minimum(np.searchsorted(part, s), len(part) - 1)
                matrix[i, place[part[place] == s]] = 1
            return matrix

        sizes += incidence(left) @ incidence(right).T
    return sizes


def linked(ids, fresh, sets, blocks, similarity: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of texts that are similar: all pairs of one block, or, where two blocks
    are given, all pairs of a text of one and a text of the other."""
    names = np.unique(blocks)
    left = np.flatnonzero(blocks == names[0])
    right = left if len(names) == 1 else np.flatnonzero(blocks == names[1])
    alive = np.ones((len(left), len(right)), bool)
    if len(names) == 1:
        alive = np.triu(alive, 1)
    alive = pruned_pairs(fresh[left], fresh[right], alive, similarity, tolerance)
    rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if not len(rows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    alive = alive[np.ix_(rows, columns)]
    left, right = left[rows], right[columns]
    both = intersections([sets[i] for i in left], [sets[i] for i in right])
    size = np.array([len(s) for s in sets])
    union = size[left][:, None] + size[right][None, :] - both
    a, b = np.nonzero(alive & (both >= similarity * union - 1e-9))
    return left[a], right[b]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect the same rows as all the given ones, without cycles."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            kept.append((x, y))
    return kept


def _verify(similarity: float, tolerance: float):
    def run(table: pa.Table) -> pa.Table:
        roots = table["root"].to_numpy()
        order = np.argsort(roots, kind="stable")
        out = {"a": [], "b": [], "links": []}
        cuts = np.append(np.flatnonzero(first_marks(roots[order])), len(order))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            own = table.take(pa.array(order[lo:hi]))
            ids, copies = own["id"].to_numpy(), own["copies"].to_numpy()
            fresh = np.frombuffer(b"".join(own["fresh"].to_pylist()), np.uint32).reshape(len(ids), FRESH)
            sets = [np.frombuffer(s, np.uint64) for s in own["shingles"].to_pylist()]
            a, b = linked(ids, fresh, sets, own["block"].to_numpy(), similarity, tolerance)
            links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
            for i in np.flatnonzero(links).tolist():
                out["a"].append(int(ids[i]))
                out["b"].append(None)
                out["links"].append(int(links[i]))
            for x, y in forest(a, b):
                out["a"].append(int(ids[x]))
                out["b"].append(int(ids[y]))
                out["links"].append(0)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return run


def shingle_sets(docs: DataFrame, keep: str) -> DataFrame:
    """Column text replaced by shingles: its distinct shingles, sorted, 8 bytes each."""
    names = [c for c in docs.columns if c != "text"]

    def make():
        powers = Powers()

        def each(batch):
            for piece in pieces(batch.column("text")):
                shingles, first = shingles_of(words_of(piece, plain_word_bytes(), powers))
                sets = [np.unique(shingles[first[i] : first[i + 1]]).tobytes() for i in range(len(piece))]
                part = batch.slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(sets, pa.binary())], names=[*names, "shingles"])

        return each

    return map_batches(docs.select(*names, "text"), f"{keep}, shingles binary", make)


def jaccard_classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8, tolerance: float = 1e-4
) -> DataFrame:
    """(doc_id, class_id, n_links) for every row of ``docs``.

    Two documents are linked where the Jaccard similarity of their sets of five-word shingles
    (of runs of letters and digits in lower case; a shorter text is one shingle) is at least
    ``similarity``, or where their texts are equal. class_id is the smallest id that chains of
    links reach, n_links the number of other rows it is linked to.

    Equal texts are counted first and represented by one. Representatives meet in MinHash
    bands; buckets are stars around their smallest id, never all pairs, and joined to candidate
    components. Within a component MinHash values (others than the bands') are compared 8 at
    a time; a pair is dropped when its posterior probability of reaching ``similarity`` falls
    below ``tolerance``; the others are verified exactly. A component of more than 256 texts is
    dealt into blocks, one task for each two blocks, so that no task holds a large component;
    tasks give back link counts and a spanning forest, not pairs.

    A null text counts as empty. Texts without words link only to equal texts. Rows that repeat
    are linked to each other. A row with a null id is left out of links and classes: its
    class_id is null, n_links 0. Rows that share an id but not the text are looked at as
    different documents. Other columns are not read.
    """
    found = text_classes(docs, doc_id=doc_id, text=text, similarity=similarity, tolerance=tolerance)
    result = found.select("doc_id", "class_id", "n_links")
    unnamed = docs.filter(F.col(doc_id).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return result.unionByName(unnamed)


def text_classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8, tolerance: float = 1e-4
) -> DataFrame:
    """``jaccard_classes`` of the rows with an id, with the text's ``digest`` and the number of
    the class (``class_no``), which tells classes apart where ids repeat."""
    whole = F.coalesce(F.col(text), F.lit(""))
    texts_of = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.lower(whole).alias("text"))
    named = texts_of.filter(F.col("doc_id").isNotNull())
    rows = durable(signatures(named))
    texts = durable(
        rows.groupBy("digest").agg(
            F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"),
            F.first("bands").alias("bands"), F.first("fresh").alias("fresh"),
        )
        # A text is a node of the graph, by its own number: ids may repeat.
        .withColumnRenamed("id", "doc")
        .withColumn("id", F.monotonically_increasing_id())
    )
    banded = texts.select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least <> most")
    stars = banded.join(shared, "key").filter("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    candidates = durable(components(stars))
    sizes = candidates.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = candidates.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    members = durable(
        dealt.join(texts.select("id", "doc", "digest", "copies", "fresh"), "id").select(
            "id", "doc", "root", "blocks", "block", "copies", "fresh", F.col("digest").alias("_digest")
        )
    )
    held = (
        named.join(members.hint("shuffle_hash"), (named["doc_id"] == members["doc"]) & (named["digest"] == members["_digest"]))
        .select("id", "root", "blocks", "block", "copies", "fresh", "text")
    )
    kept = "id long, root long, blocks int, block int, copies long, fresh binary"
    sets = shingle_sets(held, kept).dropDuplicates(["id"])
    bundles = max(1, candidates.count() // 1024)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = sets.select("*", other.alias("_other")).select(
        "id", "root", "block", "copies", "fresh", "shingles",
        # Small components share tasks; a large one has a task for each two blocks.
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(bundles))).otherwise(F.col("root")).alias("_of"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.least("block", "_other")).alias("_one"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("block", "_other")).alias("_two"),
    )
    found = durable(
        paired.groupBy("_of", "_one", "_two").applyInArrow(
            _verify(similarity, tolerance), "a long, b long, links long"
        )
    )
    links = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("_a")).agg(F.sum("links").alias("_links"))
    classes = components(found.filter(F.col("b").isNotNull()).select("a", "b")).select(F.col("id").alias("_id"), "root")
    described = durable(
        texts.select(F.col("digest").alias("_digest"), "id", "doc", "copies")
        .join(classes, F.col("id") == F.col("_id"), "left")
        .join(links, F.col("id") == F.col("_a"), "left")
        .select(
            "_digest", "doc", F.coalesce("root", "id").alias("class_no"),
            (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    named_classes = described.groupBy("class_no").agg(F.min("doc").alias("class_id"))
    described = described.drop("doc").join(named_classes, "class_no")
    return rows.select("doc_id", "digest").join(described, F.col("digest") == F.col("_digest")).select(
        "doc_id", "class_id", "n_links", "digest", "class_no"
    )
