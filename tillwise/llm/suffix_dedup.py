"""Removal of every byte that a string of ``LENGTH`` bytes covers which also starts elsewhere.

Method: distributed prefix doubling over a sparse suffix array. Ranking every byte position in
every round would shuffle some hundred times the input, so only anchors are ranked: in
each window of LENGTH bytes the leftmost smallest hash among its grams of LENGTH // 2 + 1
bytes. Equal windows have equal anchors, and neighbouring anchors' grams touch, so a row of grams
with their distances spells out all bytes between.

1. Each anchor's gram gets a rank: rows are sorted by gram over range partitions, equal ones
   share the number of the first. A gram that occurs once ends there.
2. Round t ranks 2^(t+1) grams from each anchor on, as the pair of the ranks of 2^t grams there
   and 2^t anchors later. What is unique drops out; what is long enough to hold all windows
   that start between two anchors is past the threshold: if it occurs again, they all do.
3. Windows that neither decides, at the ends of what repeats, are compared with those that have the
   same smallest gram, also in one stretch of each rank that shares it. Runs of such windows
   move as bytes, grouped by gram; where one gram has very many runs, they are cut in two at the
   same distances from it, and each half goes by all bytes that its windows share, until groups
   are small or a half is one window. Of halves that are the same bytes one goes on.

Texts are known by their SHA-256 and copies of one text are looked at once where text is needed.
A null text is an empty one; texts shorter than LENGTH keep all; repeated rows are copies, so they
lose all from LENGTH bytes on; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.words import Powers, list_array, map_batches, mix, pieces, ragged, span_hashes
from tillwise.session import drop_shuffles, durable, release

LENGTH = 200
HEAD, TAIL = np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B)
PLACE = np.uint64((1 << 40) - 1)
#: Runs of windows that one task compares for a gram; those of more frequent grams are cut.
GROUP_ROWS = 1000


def smallest_grams(data: np.ndarray, offsets: np.ndarray, length: int, powers: Powers):
    """Names of all grams, and for each window of each text, in order, the place of its leftmost
    smallest gram."""
    gram = length // 2 + 1
    width = length - gram + 1
    grams = np.arange(max(0, len(data) - gram + 1))
    names = span_hashes(data, grams, grams + gram, powers)
    # Order by 24 bits of the hash, then by place: the leftmost wins, at every size alike.
    order = (names & ~PLACE) | grams.astype(np.uint64)
    order = np.append(order, np.full(-len(order) % width, ~np.uint64(0)))
    rows = order.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    sizes = np.diff(offsets)
    long = sizes >= length
    starts = ragged(offsets[:-1][long], sizes[long] - length + 1)
    least = np.minimum(backward[starts], forward[starts + width - 1]) & PLACE
    return names, least.astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, powers: Powers):
    """Places and names of the anchors of some texts, each text's first one, and the smallest
    grams. A text of at least ``length`` bytes has also its first and its last gram, under names of
    their own, before and behind the others; a shorter one has none."""
    names, least = smallest_grams(data, offsets, length, powers)
    chosen = np.ones(len(least), bool)
    chosen[1:] = least[1:] != least[:-1]
    chosen = least[chosen]
    long = np.diff(offsets) >= length
    first, last = offsets[:-1][long], offsets[1:][long] - (length // 2 + 1)
    place = np.concatenate((first, chosen, last))
    name = np.concatenate((mix(names[first] ^ HEAD), names[chosen], mix(names[last] ^ TAIL)))
    kind = np.repeat([0, 1, 2], [len(first), len(chosen), len(last)])
    owner = np.searchsorted(offsets, place, side="right") - 1
    by = np.lexsort((place, kind, owner))
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    return (place - offsets[owner])[by], name[by], np.concatenate(([0], np.cumsum(counts))), least


def _parsed(docs: DataFrame, length: int) -> DataFrame:
    """(digest, n_bytes, at, name): the anchors of each row's text."""

    def make():
        powers = Powers()

        def each(batch: pa.RecordBatch):
            for texts in pieces(batch.column(1)):
                at, name, first, _ = anchors(texts.data, texts.offsets, length, powers)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts)),
                        pa.array(np.diff(texts.offsets)),
                        list_array(pa.array(at, pa.int32()), first),
                        list_array(pa.array(name.view(np.int64)), first),
                    ],
                    names=["digest", "n_bytes", "at", "name"],
                )

        return each

    texts = docs.select("digest", "text")
    return map_batches(texts, "digest string, n_bytes bigint, at array<int>, name array<bigint>", make)


def ranked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows whose ``keys`` (numbers) occur more than once, without them, with ``rank``, the same
    number for equal keys, and ``opens``, true for one row of each rank.

    Rows are sorted by keys and ``order`` over range partitions, so that one key may fill
    many of them. A task numbers the rows of its partition, and says of the first and the last
    key what number and how many rows they got there. These two rows a partition are put
    together on the driver; they tell what number a key has that several partitions share.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in keys]
    schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept]
        + ["rank bigint", "opens boolean", "size bigint"] + [f"key{i} bigint" for i in range(len(keys))]
    )
    kinds = [pa.int64(), pa.bool_(), pa.int64()] + [pa.int64()] * len(keys)
    names = ["rank", "opens", "size"] + [f"key{i}" for i in range(len(keys))]

    def number(batches):
        # Ranks are the places at which keys open; before and held: last key and last batch.
        at = open_at = 0
        first_rank = first_size = base = before = held = None

        def rows_of(held, follows):
            """Rows of the batch that another one equals, or may equal in another partition."""
            batch, ranks, opens = held
            alone = opens & (ranks != first_rank)
            alone[:-1] &= opens[1:]
            alone[-1] &= follows
            n = len(ranks)
            columns = [batch.column(f) for f in kept] + [pa.array(ranks), pa.array(opens)]
            columns += [pa.nulls(n, pa.int64())] * (1 + len(keys))
            return pa.RecordBatch.from_arrays(columns, names=[*kept, *names]).filter(pa.array(~alone))

        def summary(row, *values):
            columns = [row.column(f) for f in kept] + [pa.array([v], k) for v, k in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(k).to_numpy() for k in keys]
            opens = np.ones(batch.num_rows, bool)
            opens[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
            if before is not None:
                opens[0] = any(v[0] != b for v, b in zip(values, before))
            else:
                base = int(batch.column(batch.num_columns - 1)[0].as_py()) << 40
                first_rank, first_row, first_key = base, batch.slice(0, 1), [int(v[0]) for v in values]
            before = [int(v[-1]) for v in values]
            place = np.arange(at, at + batch.num_rows)
            ranks = np.maximum.accumulate(np.where(opens, place, open_at)) + base
            at, open_at = at + batch.num_rows, int(ranks[-1]) - base
            if first_size is None and open_at > 0:
                first_size = int(place[np.argmax(ranks != base)])
            if held is not None:
                yield rows_of(held, opens[0])
            held = batch, ranks, opens
        if held is None:
            return
        yield rows_of(held, False)
        yield summary(first_row, base, False, at if first_size is None else first_size, *first_key)
        if first_size is not None:
            yield summary(held[0].slice(0, 1), base + open_at, False, at - open_at, *before)

    ordered = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    found = durable(ordered.withColumn("_task", F.spark_partition_id()).mapInArrow(number, schema))
    drop_shuffles(spark)
    seen = {}
    for row in found.filter("size IS NOT NULL").select("rank", "size", *names[3:]).collect():
        seen.setdefault(tuple(row[2:]), []).append((row.rank, row.size))
    shared = [(r, min(x)[0], sum(n for _, n in x)) for x in seen.values() for r, _ in x]
    shared = spark.createDataFrame(shared, "rank bigint, _own bigint, _total bigint")
    repeated = (
        found.filter("size IS NULL")
        .join(F.broadcast(shared), "rank", "left")
        .filter("_total IS NULL OR _total > 1")
        .select(
            *kept,
            F.coalesce("_own", "rank").alias("rank"),
            (F.col("opens") & (F.col("_own").isNull() | (F.col("_own") == F.col("rank")))).alias("opens"),
        )
    )
    repeated.durable_path = found.durable_path
    return repeated


def _by_place(rows: DataFrame, text: str, schema: str, make) -> DataFrame:
    """``make()`` gives, once per task, a function from the sorted columns of whole texts
    to a list of columns. Rows of a text meet in one task, which is bounded by its length."""

    def run(batches):
        each = make()
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            ids = table.column(text).to_numpy()
            cut = int(np.searchsorted(ids, ids[-1]))
            if cut:
                whole = table.slice(0, cut)
                yield from each({c: whole.column(c).to_numpy() for c in whole.column_names}, cut)
            held = table.slice(cut)
        if held is not None:
            yield from each({c: held.column(c).to_numpy() for c in held.column_names}, held.num_rows)

    return rows.repartition(text).sortWithinPartitions(text, "p").mapInArrow(run, schema)


def _emit(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _places(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """One increasing number for each (text, place)."""
    opens = np.ones(len(ids), bool)
    opens[1:] = ids[1:] != ids[:-1]
    return (np.cumsum(opens) << 40) + p


def _wanted(rows: DataFrame, length: int) -> DataFrame:
    """Of each anchor with a repeated gram: how many grams from it on hold all windows that start
    at it or behind it, before the next anchor (``m``, 0 if one of them is unique), and up to which
    round it must be ranked (``top``)."""
    gram = length // 2 + 1

    def make():
        def each(c, n):
            ids, p, at, tail = c["id"], c["p"], c["at"], c["tail"]
            spot = _places(ids, p)
            run = np.cumsum(np.append(True, spot[1:] != spot[:-1] + 1))
            following = np.append(run[1:] == run[:-1], False)
            # The last window ends where the gram of the last anchor needed ends, or the text.
            need = np.append(at[1:], 0) + length - gram - 1
            line = run * np.int64(1 << 40)
            reach = np.searchsorted(line + at, line + need)
            last = np.searchsorted(run, run, side="right") - 1
            end = np.minimum(np.maximum(reach, np.arange(n) + 1), last)
            m = np.where(following & ((reach <= last) | tail[last]), end - np.arange(n) + 1, 0)
            level = np.where(m > 1, np.ceil(np.log2(np.maximum(m, 2))).astype(np.int64) - 1, -1)
            top = np.zeros(n, np.int64)
            for t in range(1, int(level.max()) + 1):
                far = np.maximum.accumulate(np.where(level >= t, end, -1))
                top[np.arange(n) + (1 << t) - 1 <= far] = t
            yield _emit(id=ids, p=p, at=at, m=m, top=top, rank=c["rank"])

        return each

    return _by_place(rows, "id", "id bigint, p bigint, at bigint, m bigint, top bigint, rank bigint", make)


def _pairs(rows: DataFrame, t: int) -> DataFrame:
    """Keys of the next round: pairs of ranks 2^t grams apart (a even), and those that hold all
    windows between two anchors (a odd, m -1)."""

    def make():
        def each(c, n):
            ids, p, at, m, top, rank = (c[k] for k in ("id", "p", "at", "m", "top", "rank"))
            spot = _places(ids, p)

            def pair(which, shift, odd):
                other = np.searchsorted(spot, spot[which] + shift)
                there = other < n
                there[there] = spot[other[there]] == (spot[which] + shift)[there]
                own, other = which[there], other[there]
                return _emit(
                    a=2 * rank[own] + odd, gap=at[other] - at[own], b=rank[other], id=ids[own], p=p[own], at=at[own],
                    m=np.full(len(own), -1) if odd else m[own], top=top[own],
                )

            yield pair(np.flatnonzero(top > t), 1 << t, 0)
            ready = np.flatnonzero((m > 1 << t) & (m <= 2 << t))
            yield pair(ready, m[ready] - (1 << t), 1)

        return each

    schema = "a bigint, gap bigint, b bigint, id bigint, p bigint, at bigint, m bigint, top bigint"
    return _by_place(rows, "id", schema, make)


def _open(grams: DataFrame, whole: DataFrame, length: int) -> DataFrame:
    """(id, p, rank, kind): repeated grams whose anchor may be the smallest of a window not known
    to occur again (kind 0), and, for each stretch that stands first among equal ones,
    the ranks of the grams its windows may have as the smallest (kind 1)."""
    gram = length // 2 + 1
    state = grams.select("id", "p", "at", "rank", F.lit(0).alias("what")).unionByName(
        whole.select("id", "p", *[F.lit(0).cast("long").alias(c) for c in ("at", "rank")], F.when(F.col("opens"), 2).otherwise(1).alias("what"))
    )

    def make():
        def each(c, n):
            spot = _places(c["id"], c["p"])
            number = np.cumsum(np.append(True, spot[1:] != spot[:-1])) - 1
            what = np.zeros(number[-1] + 1, np.int64)
            np.maximum.at(what, number, c["what"])
            own = np.flatnonzero(c["what"] == 0)
            ids, p, at, rank, spot = (x[own] for x in (c["id"], c["p"], c["at"], c["rank"], spot))
            n = len(own)
            run = np.cumsum(np.append(True, spot[1:] != spot[:-1] + 1))
            line = run * np.int64(1 << 40)
            # Windows with anchor j as the smallest start behind at[j] - (length - gram + 1).
            low = np.searchsorted(line + at, line + np.maximum(at - (length - gram), 0), side="right") - 1
            first = np.searchsorted(run, run)
            sums = np.concatenate(([0], np.cumsum(what > 0)))
            known = (low >= first) & (sums[np.arange(n) + 1] - sums[np.maximum(low, 0)] == np.arange(n) + 1 - low)
            known |= p == 0  # the first gram of a text is no anchor
            yield _emit(id=ids[~known], p=p[~known], rank=rank[~known], kind=np.zeros(int((~known).sum()), np.int64))
            lead = np.flatnonzero(what == 2)
            high = np.searchsorted(line + at, line[lead] + at[np.minimum(lead + 1, n - 1)] + length - gram, side="left")
            high = np.maximum(np.minimum(high, np.searchsorted(run, run[lead], side="right")), lead + 1)
            grams_of = ragged(lead, high - lead)
            of = np.repeat(lead, high - lead)
            yield _emit(id=ids[of], p=p[of], rank=rank[grams_of], kind=np.ones(len(of), np.int64))

        return each

    return _by_place(state, "id", "id bigint, p bigint, rank bigint, kind bigint", make)


def _packed(docs: DataFrame) -> DataFrame:
    """(digest, packed): each text once, compressed on its way through shuffles."""

    def make():
        press = zstandard.ZstdCompressor(level=1)

        def each(batch: pa.RecordBatch):
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_buffer()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([press.compress(text)], pa.binary())], names=["digest", "packed"]
                )

        def together(batch: pa.RecordBatch):
            parts = list(each(batch))
            yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        return together

    return map_batches(docs.select("digest", "text"), "digest string, packed binary", make).dropDuplicates(["digest"])


def _text_of(packed, opener) -> np.ndarray:
    return np.frombuffer(opener.decompress(packed.as_py()), np.uint8)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and where each list starts among them."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64), (offsets - offsets[0]).astype(np.int64)


def _runs(rows: DataFrame, length: int) -> DataFrame:
    """Of each text, by the places where windows start: low..high of the stretches known to occur
    again, as few as possible, and start, count and gram (its name, and at its place) of the other
    windows whose smallest gram is repeated (held false) and of those they are held against
    (held true)."""
    width = length - length // 2
    schema = "digest string, id bigint, low array<int>, high array<int>, start array<int>, count array<int>, held array<boolean>, gram array<bigint>, gram_at array<int>"

    def make():
        def each(batch: pa.RecordBatch):
            at, first = _lists(batch.column("at"))
            name, _ = _lists(batch.column("name"))
            size = batch.column("n_bytes").to_numpy()
            base = np.cumsum(size + 1) - size - 1
            doc = np.repeat(np.arange(len(size)), np.diff(first))
            at += base[doc]
            upto = base + size - length + 1  # behind the last window

            def marked(column):
                p, of = _lists(batch.column(column))
                marks = np.zeros(len(at), bool)
                marks[p + np.repeat(first[:-1], np.diff(of))] = True
                return marks

            known, whole, lead = marked("known"), marked("whole"), marked("lead")

            def listed(where, values, kind):
                return list_array(pa.array(values, kind), np.searchsorted(where, np.arange(len(size) + 1)))

            # The last gram is no anchor; some stretches hold no window.
            own = np.flatnonzero(whole)
            low, high = at[own], np.minimum(at[own + 1], upto[doc[own]])
            low, high = low[high > low], high[high > low]
            opens = np.append(True, low[1:] != high[:-1])[: len(low)]
            low, high = low[opens], high[np.append(opens[1:], True)[: len(high)]]
            of = np.searchsorted(base, low, side="right") - 1

            # Of neighbouring anchors the smaller one has all windows that hold both.
            anchor = np.ones(len(at), bool)
            anchor[first[:-1]] = anchor[first[1:] - 1] = False
            anchor = np.flatnonzero(anchor)
            order = name[anchor].view(np.uint64) & ~PLACE
            begin = np.empty(len(anchor), np.int64)
            begin[1:] = np.where(order[:-1] <= order[1:], at[anchor[:-1]] + 1, at[anchor[1:]] - width + 1)
            begin[np.searchsorted(doc[anchor], np.arange(len(size)))] = base
            # Between two places where a window's smallest gram or its stretch changes.
            start = np.unique(np.concatenate((begin, at)))
            smallest = anchor[np.searchsorted(begin, start, side="right") - 1]
            stretch = np.searchsorted(at, start, side="right") - 1
            stop = np.minimum(np.append(start[1:], upto[-1]), upto[doc[smallest]])
            open_ = (stop > start) & known[smallest] & (~whole | lead)[stretch]
            start, stop, smallest, held = start[open_], stop[open_], smallest[open_], lead[stretch[open_]]
            opens = np.ones(len(start), bool)
            opens[1:] = (start[1:] != stop[:-1]) | (smallest[1:] != smallest[:-1]) | (held[1:] != held[:-1])
            stop, start, smallest, held = stop[np.append(opens[1:], True)[: len(stop)]], start[opens], smallest[opens], held[opens]
            by = doc[smallest]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("id"),
                 listed(of, low - base[of], pa.int32()), listed(of, high - 1 - base[of], pa.int32()),
                 listed(by, start - base[by], pa.int32()), listed(by, stop - start, pa.int32()),
                 listed(by, held, pa.bool_()), listed(by, name[smallest], pa.int64()), listed(by, at[smallest] - base[by], pa.int32())],
                names=[c.split()[0] for c in schema.split(", ")],
            )

        return each

    return map_batches(rows.select("digest", "id", "n_bytes", "at", "name", "known", "whole", "lead"), schema, make)


CONTEXT = "gram bigint, check bigint, id bigint, start bigint, gram_at bigint, held boolean, bytes binary"
CONTEXT_COLUMNS = [c.split()[0] for c in CONTEXT.split(", ")]


def _taken(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of some spans."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[ragged(starts, sizes)])])


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """(gram, check, id, start, gram_at, held, bytes): the bytes that each run of windows spans."""

    def make():
        opener = zstandard.ZstdDecompressor()

        def each(batch: pa.RecordBatch):
            data = [_text_of(packed, opener) for packed in batch.column("packed")]
            base = np.cumsum([0] + [len(x) for x in data])
            data = np.concatenate(data)
            (start, first), (count, _), (gram, _), (gram_at, _) = (_lists(batch.column(c)) for c in ("start", "count", "gram", "gram_at"))
            held = batch.column("held").flatten()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            ids = batch.column("id").to_numpy()
            sizes = count + length - 1
            # Some MB at a time.
            ends = np.cumsum(sizes)
            low = 0
            while low < len(start):
                high = max(low + 1, int(np.searchsorted(ends, ends[low] + (1 << 21))))
                own = slice(low, high)
                columns = [pa.array(x) for x in (gram[own], np.zeros(high - low, np.int64), ids[doc[own]], start[own], gram_at[own])]
                columns += [held.slice(low, high - low), _taken(data, base[doc[own]] + start[own], sizes[own])]
                yield pa.RecordBatch.from_arrays(columns, names=CONTEXT_COLUMNS)
                low = high

        return each

    return map_batches(texts, CONTEXT, make)


def _bytes_of(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of some runs of windows, where each run starts there, and how many windows it has."""
    column = batch.column("bytes")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[:-1] - offsets[0], np.diff(offsets) - length + 1


def _halves(contexts: DataFrame, length: int, cell: int) -> DataFrame:
    """The runs cut where a window's distance from its gram is a multiple of ``cell``: gram and check
    are two hashes of all bytes that windows of such a part share, and of where it is."""

    def make():
        powers = Powers()

        def each(batch: pa.RecordBatch):
            data, base, count = _bytes_of(batch, length)
            before = batch.column("gram_at").to_numpy() - batch.column("start").to_numpy()
            # A window starts 0 to length // 2 bytes before its gram.
            least, most = (before - count + 1) // cell, before // cell
            run = np.repeat(np.arange(len(count)), most - least + 1)
            part = ragged(least, most - least + 1)
            start = np.maximum(before[run] - part * cell - cell + 1, 0)
            stop = np.minimum(before[run] - part * cell, count[run] - 1)
            shared = base[run] + before[run] - part * cell
            # A part at an end of the run may lack windows, but all of it hold these bytes.
            names = span_hashes(data, shared, shared - cell + 1 + length, powers)
            other = span_hashes(data, shared + 1, shared - cell + length, powers)
            own = [batch.column(c).to_numpy()[run] for c in ("gram", "id", "start", "gram_at")]
            place = mix((part + cell * length).astype(np.uint64) ^ own[0].view(np.uint64))
            columns = [pa.array(x) for x in (mix(names ^ place).view(np.int64), mix(other ^ place).view(np.int64), own[1], own[2] + start, own[3])]
            columns += [batch.column("held").take(pa.array(run)), _taken(data, base[run] + start, stop - start + length)]
            yield pa.RecordBatch.from_arrays(columns, names=CONTEXT_COLUMNS)

        def some(batch: pa.RecordBatch):
            for low in range(0, batch.num_rows, GROUP_ROWS):
                yield from each(batch.slice(low, GROUP_ROWS))

        return some

    return map_batches(contexts, CONTEXT, make)


def _equal_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(id, low, high): runs of windows that are not held and equal others with their gram. The
    runs of a gram meet in one task."""

    def run(batches):
        powers = Powers()

        def compared(table: pa.Table):
            batch = table.combine_chunks().to_batches()[0]
            held, ids = batch.column("held").to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
            gram = batch.column("gram").to_numpy()
            data, base, counts = _bytes_of(batch, length)
            i = ragged(base, counts)
            run = np.repeat(np.arange(len(counts)), counts)
            place = ragged(batch.column("start").to_numpy(), counts)
            name = span_hashes(data, i, i + length, powers)
            order = np.argsort(name)
            ordered = name[order]
            equal = ordered[1:] == ordered[:-1]
            own = order[np.append(equal, False) | np.append(False, equal)]
            keys = name[own], span_hashes(data, i[own] + 1, i[own] + length - 1, powers), gram[run[own]]
            by = np.lexsort(keys)
            own, keys = own[by], [k[by] for k in keys]
            equal = np.all([k[1:] == k[:-1] for k in keys], axis=0)
            own = np.sort(own[(np.append(equal, False) | np.append(False, equal))[: len(own)]])
            own = own[~held[run[own]]]
            opens = np.ones(len(own), bool)
            opens[1:] = (own[1:] != own[:-1] + 1) | (run[own[1:]] != run[own[:-1]])
            yield _emit(id=ids[run[own[opens]]], low=place[own[opens]], high=place[own[np.append(opens[1:], True)[: len(own)]]])

        waiting, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting, rows = [*waiting, batch], rows + batch.num_rows
            if rows < GROUP_ROWS:
                continue
            table = pa.Table.from_batches(waiting)
            grams = table.column("gram").to_numpy()
            # Whole grams, some thousand runs at a time; those of the last one wait.
            ends = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            low = 0
            while len(ends) and low < ends[-1]:
                high = int(ends[max(np.searchsorted(ends, low + 4 * GROUP_ROWS, side="right") - 1, np.searchsorted(ends, low, side="right"))])
                yield from compared(table.slice(low, high - low))
                low = high
            waiting, rows = table.slice(low).to_batches(), table.num_rows - low
        if rows:
            yield from compared(pa.Table.from_batches(waiting))

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "id bigint, low bigint, high bigint")


def _repeated_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(id, low, high): runs of windows that are not held and occur more than once."""
    found, cell = [], 1 << (length // 2).bit_length()
    ends = "id", F.col("start").alias("low"), (F.col("start") + F.length("bytes") - length).alias("high")
    while True:
        sizes = contexts.groupBy("gram", "check").agg(F.count(F.lit(1)).alias("n"))
        frequent = durable(sizes.filter(F.col("n") > GROUP_ROWS).select("gram", "check"))
        if frequent.isEmpty():
            return reduce(DataFrame.unionByName, found, _equal_windows(contexts, length))
        found.append(_equal_windows(contexts.join(frequent, ["gram", "check"], "left_anti"), length))
        contexts = contexts.join(frequent, ["gram", "check"], "left_semi")
        if cell == 1:
            # What is left are single windows, each with many equal ones.
            return reduce(DataFrame.unionByName, found, contexts.filter("NOT held").select(*ends))
        # Runs that are the same bytes around their gram are found; one of them is held against others.
        same = ["gram", "check", "_before", "_digest"]
        contexts = contexts.withColumn("_before", F.col("gram_at") - F.col("start")).withColumn("_digest", F.md5("bytes"))
        copies = durable(
            contexts.groupBy(*same).agg(
                F.count(F.lit(1)).alias("_n"),
                F.min_by(F.struct(*CONTEXT_COLUMNS), F.struct("id", "start")).alias("_one"),
            ).filter("_n > 1").select(*same, "_one")
        )
        if not copies.isEmpty():
            found.append(contexts.join(copies.select(*same), same, "left_semi").filter("NOT held").select(*ends))
            alone = contexts.join(copies.select(*same), same, "left_anti").select(*CONTEXT_COLUMNS)
            contexts = alone.unionByName(copies.select("_one.*").withColumn("held", F.lit(True)))
        cell //= 2
        contexts = durable(_halves(contexts.select(*CONTEXT_COLUMNS), length, cell))


def _removed(texts: DataFrame, length: int) -> DataFrame:
    """What is left of each text without its windows that start at low..high: (digest,
    n_removed, n_spans, spans, kept_sha256)."""

    def make():
        opener = zstandard.ZstdDecompressor()

        def each(batch: pa.RecordBatch):
            removed, counts, shas, starts, ends = [], [], [], [], []
            (lows, first), (highs, _) = _lists(batch.column("low")), _lists(batch.column("high"))
            for row, packed in enumerate(batch.column("packed")):
                data = _text_of(packed, opener)
                own = slice(first[row], first[row + 1])
                by = np.argsort(lows[own], kind="stable")
                low, reach = lows[own][by], np.maximum.accumulate(highs[own][by] + length)
                opens = np.append(True, low[1:] > reach[:-1])
                starts.append(low[opens])
                ends.append(reach[np.append(opens[1:], True)])
                removed.append(int((ends[-1] - starts[-1]).sum()))
                counts.append(len(starts[-1]))
                kept, at = hashlib.sha256(), 0
                for start, stop in zip(starts[-1].tolist(), ends[-1].tolist()):
                    kept.update(data[at:start])
                    at = stop
                kept.update(data[at:])
                shas.append(kept.hexdigest())
            offsets = np.concatenate(([0], np.cumsum(counts)))
            spans = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x), pa.int64()) for x in (starts, ends)], names=["start", "stop"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                 list_array(spans, offsets), pa.array(shas, pa.string())],
                names=["digest", "n_removed", "n_spans", "spans", "kept_sha256"],
            )

        return each

    schema = "digest string, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, stop: bigint>>, kept_sha256 string"
    return map_batches(texts, schema, make)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """For each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans (start, stop; in bytes of
    UTF-8) of what goes, and kept_sha256 of the bytes that stay. ``length``: 4 at least."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(body, 256).alias("digest"), body.alias("text"))
    parsed = durable(_parsed(docs, length).withColumn("id", F.monotonically_increasing_id()))

    # Round after round twice as many grams.
    place = parsed.select("id", F.size("at").alias("_n"), "at", F.posexplode("name").alias("_p", "name")).select(
        "name", "id", F.col("_p").cast("long").alias("p"), F.get("at", F.col("_p")).cast("long").alias("at"),
        (F.col("_p") == F.col("_n") - 1).alias("tail"),
    )
    grams = ranked(place, ["name"], ["id", "p"])
    wanted = durable(_wanted(grams, length))
    rows, rounds, t = wanted, [], 0
    while not rows.isEmpty():
        rounds.append(ranked(_pairs(rows, t), ["a", "gap", "b"], ["id", "p"]))
        rows, t = rounds[-1].filter("m >= 0"), t + 1
    release(wanted)
    whole = reduce(DataFrame.unionByName, [r.filter("m < 0").select("id", "p", "opens") for r in rounds],
                   grams.select("id", "p", "opens").filter("false"))

    # Windows at the ends of what repeats, and one stretch of each rank to hold them against.
    opened = durable(_open(grams, whole, length))
    drop_shuffles(spark)
    ranks_open = opened.filter("kind = 0").select("rank").distinct()
    leads = opened.filter("kind = 1").join(ranks_open, "rank", "left_semi").select("id", "p").distinct()
    marks = (
        grams.select("id", "p", F.lit(0).alias("what"))
        .unionByName(whole.select("id", "p", F.lit(1).alias("what")))
        .unionByName(leads.select("id", "p", F.lit(2).alias("what")))
    )

    def listed(what: int, name: str):
        return F.collect_list(F.when(F.col("what") == what, F.col("p"))).alias(name)

    state = marks.groupBy("id").agg(listed(0, "known"), listed(1, "whole"), listed(2, "lead"))
    # Copies of a text have the same grams; a stretch may stand first in any of them.
    text_of = F.struct("id", "n_bytes", "at", "name", "known", "whole")
    state = (
        state.join(parsed, "id")
        .groupBy("digest")
        .agg(F.min_by(text_of, "id").alias("_text"), F.flatten(F.collect_list("lead")).alias("lead"))
        .select("digest", "_text.*", "lead")
    )
    runs = durable(_runs(state, length))
    drop_shuffles(spark)
    for read in (parsed, grams, opened, *rounds):
        release(read)
    texts = _packed(docs)
    contexts = durable(_contexts(texts.join(runs.drop("low", "high").filter("size(start) > 0"), "digest"), length))
    drop_shuffles(spark)
    singles = _repeated_windows(contexts, length).groupBy("id").agg(
        F.collect_list(F.col("low").cast("int")).alias("_low"), F.collect_list(F.col("high").cast("int")).alias("_high")
    )
    none = F.array().cast("array<int>")
    found = runs.select("digest", "id", "low", "high").join(singles, "id", "left").filter("size(low) > 0 OR _low IS NOT NULL")
    found = durable(found.select("digest", *[F.concat(c, F.coalesce(f"_{c}", none)).alias(c) for c in ("low", "high")]))
    release(contexts)
    drop_shuffles(spark)
    cut = _removed(texts.join(found, "digest"), length)
    return docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(cut, "digest", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("spans", F.array().cast("array<struct<start: bigint, stop: bigint>>")).alias("spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
    )
