"""Documents into shards of near-equal size, groups of equal texts kept together."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import numbered
from tillwise.session import durable


class BinTree:
    """Open bins in a balanced (AVL) tree ordered by (remaining capacity, bin)."""

    class Node:
        __slots__ = ("key", "left", "right", "height")

        def __init__(self, key):
            self.key, self.left, self.right, self.height = key, None, None, 1

    def __init__(self):
        self.root = None

    def add(self, remaining: int, bin_id: int) -> None:
        self.root = self._add(self.root, (remaining, bin_id))

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity that is >= size."""
        node, best, low = self.root, None, (size, -1)
        while node:
            if node.key >= low:
                best, node = node.key, node.left
            else:
                node = node.right
        if best:
            self.root = self._remove(self.root, best)
        return best

    @staticmethod
    def _height(node) -> int:
        return node.height if node else 0

    def _balanced(self, node):
        tilt = self._height(node.left) - self._height(node.right)
        if tilt > 1:
            if self._height(node.left.left) < self._height(node.left.right):
                node.left = self._rotated(node.left, "right", "left")
            return self._rotated(node, "left", "right")
        if tilt < -1:
            if self._height(node.right.right) < self._height(node.right.left):
                node.right = self._rotated(node.right, "left", "right")
            return self._rotated(node, "right", "left")
        node.height = 1 + max(self._height(node.left), self._height(node.right))
        return node

    def _rotated(self, node, up: str, down: str):
        child = getattr(node, up)
        setattr(node, up, getattr(child, down))
        setattr(child, down, node)
        for n in (node, child):
            n.height = 1 + max(self._height(n.left), self._height(n.right))
        return child

    def _add(self, node, key):
        if node is None:
            return self.Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._balanced(node)

    def _remove(self, node, key):
        if key < node.key:
            node.left = self._remove(node.left, key)
        elif key > node.key:
            node.right = self._remove(node.right, key)
        elif node.left is None or node.right is None:
            return node.left or node.right
        else:
            least = node.right
            while least.left:
                least = least.left
            node.key = least.key
            node.right = self._remove(node.right, least.key)
        return self._balanced(node)


Run = tuple[int, int, int, int]  # size, first rank, end rank, bin


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> tuple[list[Run], int]:
    """Pack groups given as (size, how many), largest size first, into bins of
    ``capacity``; no size may be larger. Groups of one size are alike, so those that go
    into the same bin go together. Returns the runs and the number of bins."""
    tree, runs, bins = BinTree(), [], 0
    for size, many in sizes:
        rank = 0
        while rank < many:
            remaining, bin_id = tree.take_tightest(size) or (capacity, bins)
            bins = max(bins, bin_id + 1)
            fit = min(many - rank, remaining // size)
            runs.append((size, rank, rank + fit, bin_id))
            tree.add(remaining - fit * size, bin_id)
            rank += fit
    return runs, bins


def into_shards(sizes: list[tuple[int, int]], shards: int) -> list[Run]:
    """Groups into at most ``shards`` bins of the least capacity that is found.

    A group larger than a fair share of what is left gets a shard of its own. For the
    others the capacity starts at the fair share, grows until best-fit decreasing needs
    no more bins than there are, and is then halved back towards the share.
    """
    sizes = sorted(sizes, reverse=True)
    runs: list[Run] = []
    left, total = shards, sum(s * n for s, n in sizes)
    alone: dict[int, int] = {}
    while left > 1 and sizes and sizes[0][0] * left > total:
        size, many = sizes[0]
        rank = alone.get(size, 0)
        runs.append((size, rank, rank + 1, shards - left))
        alone[size] = rank + 1
        sizes[0] = (size, many - 1)
        if many == 1:
            sizes = sizes[1:]
        left, total = left - 1, total - size
    if not sizes:
        return runs
    first = shards - left
    fair = max(-(-total // left), sizes[0][0])
    step = max(1, fair // 1_000_000)
    low, high = fair - 1, fair
    while (best := best_fit_decreasing(sizes, high))[1] > left:
        low, high, step = high, high + step, step * 4
    while high - low > max(1, fair // 1_000_000):
        middle = (low + high) // 2
        tried = best_fit_decreasing(sizes, middle)
        if tried[1] <= left:
            best, high = tried, middle
        else:
            low = middle
    for size, begin, end, bin_id in best[0]:
        moved = alone.get(size, 0)
        runs.append((size, begin + moved, end + moved, bin_id + first))
    return runs


def shard_documents(
    docs: DataFrame, *, shards: int = 8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) for every row of ``docs``.

    A row's size is the UTF-8 length of its text plus 1; null counts as the empty text.
    Rows of equal texts are one group and share a shard. Groups are packed by best-fit
    decreasing. Only the number of groups of each size reaches the driver: sizes that
    differ number at most the square root of twice the total size (1.4e7 at 100 TB, some
    hundred thousand in practice). Slots count the rows of a shard without gaps.

    Null ids and repeated rows are kept, each with a slot of its own. Other columns are
    not read. Texts are not moved.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = durable(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.unhex(F.sha2(whole, 256)).alias("digest"),
        )
    )
    spark = docs.sparkSession
    groups = durable(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    counted = groups.groupBy("bytes").count().toArrow()
    sizes = list(zip(counted["bytes"].to_pylist(), counted["count"].to_pylist(), strict=True))
    runs = into_shards(sizes, shards)
    columns = list(zip(*runs, strict=True)) or [(), (), (), ()]
    plan = spark.createDataFrame(
        pa.table(
            {
                "bytes": pa.array(columns[0], pa.int64()), "_from": pa.array(columns[1], pa.int64()),
                "_to": pa.array(columns[2], pa.int64()), "shard": pa.array(columns[3], pa.int32()),
            }
        )
    )
    ranked = numbered(groups, ["bytes"], ["digest"], "_rank")
    placed = ranked.join(plan, "bytes").filter("_rank >= _from and _rank < _to").select("digest", "shard")
    return numbered(durable(rows.join(placed, "digest")), ["shard"], ["doc_id", "digest"], "slot")
