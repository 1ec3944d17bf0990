"""Documents packed into token sequences of a fixed length, by best fit and local search."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import plain_names
from tillwise.llm.tokens import Tokenizer
from tillwise.llm.words import map_batches, pieces
from tillwise.session import durable

PIECE_BYTES = 1 << 20


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole pieces, the first one may be shorter."""
    first = n % size
    return ([(0, first)] if first else []) + [(at, size) for at in range(first, n, size)]


def token_pieces(
    docs: DataFrame, tokenizer: str, *, size: int = 2048, end_id: int = 0, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of at most ``size`` tokens: doc_id, piece, start, length, ids_crc32 and, where
    asked for, the ids. A document is its text's ids and then ``end_id``; a null text is
    empty, so every row has a piece. ``tokenizer`` is the path of a byte-level BPE file that
    all executors can read. One pass, no shuffle."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def make():
        coder = Tokenizer(tokenizer)

        def each(batch):
            for part in pieces(batch.column("text"), PIECE_BYTES):
                ids, first = coder.encode(part)
                row, number, start, length, crc, tokens = [], [], [], [], [], []
                for i in range(len(part)):
                    own = np.append(ids[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, (at, n) in enumerate(cut(len(own), size)):
                        row.append(i)
                        number.append(k)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(own[at : at + n]))
                        if with_ids:
                            tokens.append(own[at : at + n].astype(np.int32))
                arrays = [
                    batch.column("doc_id").slice(part.first, len(part)).take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ] + ([pa.array(tokens, pa.list_(pa.int32()))] if with_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

        return each

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), schema, make)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of row numbers: longest first, each into the fullest bin it fits."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    open_rooms = 0  # bit r is set where a bin with r tokens to spare exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = open_rooms >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms &= ~(1 << r)
        else:
            r, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        if r > n:
            room.setdefault(r - n, []).append(b)
            open_rooms |= 1 << (r - n)
    return bins


class LocalSearch:
    """Exchanges documents between underfull bins so that the sum of squared fills grows,
    until no move or exchange helps any bin.

    Bins give in turn, the emptiest first: a document moves into a bin, or is exchanged for a
    shorter one, or two are exchanged for one that is shorter than both together, always so
    that the other bin, which is at least as full, becomes fuller. A bin that could give
    nothing is tried again only with bins that changed since.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], size: int):
        self.lengths, self.bins, self.size = np.asarray(lengths, np.int64), bins, size
        self.fill = np.array([int(self.lengths[b].sum()) for b in bins], np.int64)
        self.home = np.empty(len(lengths), np.int64)
        for k, b in enumerate(bins):
            self.home[b] = k
        # Steps are counted: the last one that changed a bin, and the last one it had tried all others at.
        self.step = 1
        self.changed = np.ones(len(bins), np.int64)
        self.tried = np.zeros(len(bins), np.int64)

    def put(self, i: int, k: int) -> None:
        old = int(self.home[i])
        self.bins[old].remove(i)
        self.bins[k].append(i)
        self.fill[old] -= self.lengths[i]
        self.fill[k] += self.lengths[i]
        self.home[i] = k
        self.changed[[old, k]] = self.step
        self.tried[[old, k]] = 0

    def run(self) -> list[list[int]]:
        moved = True
        while moved:
            moved = False
            under = np.flatnonzero((self.fill > 0) & (self.fill < self.size))
            for k in under[np.argsort(self.fill[under], kind="stable")].tolist():
                while 0 < self.fill[k] < self.size and self.improve(k):
                    moved = True
                    self.step += 1
                self.tried[k] = self.step
                self.step += 1
        return [b for b in self.bins if b]

    def improve(self, k: int) -> bool:
        """One move or exchange that takes tokens out of bin k."""
        partner = (self.fill < self.size) & (self.fill >= self.fill[k]) & (self.changed > self.tried[k])
        partner[k] = False
        others = np.flatnonzero(partner)
        if not len(others):
            return False
        by_length: dict[int, list[int]] = {}
        for i in self.bins[k]:
            by_length.setdefault(int(self.lengths[i]), []).append(i)
        own = np.array(sorted(by_length), np.int64)
        given = self.best(own, np.zeros(len(others), np.int64), self.size - self.fill[others])
        if given:
            self.put(by_length[int(own[given[0]])][0], int(others[given[1]]))
            return True
        inside = np.flatnonzero(partner[self.home])
        held, spare = self.lengths[inside], self.size - self.fill[self.home[inside]]
        given = self.best(own, held, spare)
        if given:
            leaving, j = [by_length[int(own[given[0]])][0]], int(inside[given[1]])
        else:
            x, y = np.triu_indices(len(own))
            twice = np.array([len(by_length[int(n)]) > 1 for n in own])
            x, y = x[(x < y) | twice[x]], y[(x < y) | twice[x]]
            totals = own[x] + own[y]
            order = np.argsort(totals, kind="stable")
            given = self.best(totals[order], held, spare)
            if not given:
                return False
            first, second, j = int(own[x[order[given[0]]]]), int(own[y[order[given[0]]]]), int(inside[given[1]])
            leaving = [by_length[first][0], by_length[second][-1]]
        target = int(self.home[j])
        # The shorter one leaves first, so that no bin holds too much in between.
        self.put(j, k)
        for i in leaving:
            self.put(i, target)
        return True

    @staticmethod
    def best(totals: np.ndarray, held: np.ndarray, spare: np.ndarray) -> tuple[int, int] | None:
        """(of totals, of held) where the total, which is sorted, exceeds what is held by most,
        and by no more than is to spare there; of equal ones where least is left to spare."""
        if not len(totals):
            return None
        at = np.searchsorted(totals, held + spare, side="right") - 1
        more = np.where(at >= 0, totals[at] - held, 0)
        most = int(more.max())
        if most <= 0:
            return None
        ties = np.flatnonzero(more == most)
        c = int(ties[np.argmin(spare[ties])])
        return int(at[c]), c


def pack(lengths: np.ndarray, size: int) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, size), size).run()


def _pack_group(size: int, step: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        base = (step << 54) | (key[0].as_py() << 22)
        number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        again = np.zeros(len(lengths), bool)
        bins = pack(lengths, size)
        for k, b in enumerate(bins):
            number[b] = base + k
            upto = np.cumsum(lengths[b])
            offset[b] = upto - lengths[b]
        fills, rows = [int(lengths[b].sum()) for b in bins], 0
        for k in np.argsort(fills, kind="stable").tolist():
            rows += len(bins[k])
            if fills[k] == size or 2 * rows > len(lengths):
                break
            again[bins[k]] = True
        out = table.drop(["_group"])
        for name, values in (("sequence_id", number), ("offset", offset), ("_again", again)):
            out = out.append_column(name, pa.array(values))
        return out

    return run


def pack_pieces(pieces_table: DataFrame, *, size: int = 2048, group_rows: int = 16_384) -> DataFrame:
    """Adds sequence_id and offset to pieces (a stored table with a column ``length`` of 1 to
    ``size``): sequences of at most ``size`` tokens, filled without gaps.

    Whole pieces are sequences. The others are dealt at random into groups of about
    ``group_rows``, each packed by one task. Each group then gives up its emptiest sequences, as
    many as hold at most half of its pieces; those pieces are dealt anew, into half as many
    groups or fewer, until one group is left. Rows that repeat are pieces of their own and spread
    over the groups. All columns pass through, but for columns named sequence_id or offset, which are replaced.
    """
    pieces_table = pieces_table.drop("sequence_id", "offset")
    table, columns = plain_names(pieces_table)
    whole = (
        table.filter(F.col("length") == size)
        .withColumn("sequence_id", F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62)))
        .withColumn("offset", F.lit(0).cast("long"))
    )
    left = table.filter(F.col("length") < size)
    schema = left.schema.add("sequence_id", "long").add("offset", "long").add("_again", "boolean")
    done, step = [whole], 0
    rows = left.count()
    groups = -(-rows // group_rows)
    while rows:
        # The number of a row in the stored table tells rows apart that repeat; the round deals rows in another way.
        salt = F.xxhash64(F.lit(step), F.monotonically_increasing_id(), "length")
        dealt = left.withColumn("_group", F.pmod(salt, F.lit(groups)).cast("long"))
        packed = durable(dealt.groupBy("_group").applyInArrow(_pack_group(size, step), schema))
        if groups == 1:
            done.append(packed.drop("_again"))
            break
        done.append(packed.filter(~F.col("_again")).drop("_again"))
        left = packed.filter("_again").select(*[F.col(f"`{c}`") for c in columns])
        rows, step = left.count(), step + 1
        groups = min(-(-rows // group_rows), groups - 1)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.toDF(*pieces_table.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, *, size: int = 2048, end_id: int = 0,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of all documents with their place: see ``token_pieces``, ``pack_pieces``."""
    made = durable(token_pieces(docs, tokenizer, size=size, end_id=end_id, doc_id=doc_id, text=text))
    return pack_pieces(made, size=size)
