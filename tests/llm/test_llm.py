"""The operators against plain versions, on small tables and on the test data."""

import collections
import itertools
import os
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import duck
from tillwise.llm import (
    decontaminate, jaccard_join, line_dedup, packing, quality_classifier, quality_rules, registry, sharding, shared,
    substring_dedup, toxicity, warc, words,
)

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
NO_WORDS = "... !!"


def words_of(text):
    return WORD.findall((text or "").lower())


def shingles(text):
    w = words_of(text)
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def prose(n, seed):
    own = random.Random(seed)
    return " ".join(own.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(own.randrange(999)) for _ in range(n))


def edited(text, every):
    w = text.split(" ")
    w[every::every] = [x + "x" for x in w[every::every]]
    return " ".join(w)


PASSAGE = prose(60, 1)
LONG = prose(40_000, 2)
ODD = [
    (1, None), (2, ""), (3, NO_WORDS), (4, "one"), (5, "one two three"), (6, "one two three"), (6, "one two three"),
    (7, LONG), (8, LONG + " end"), (9, prose(80, 3)), (10, prose(80, 3)), (11, edited(prose(300, 4), 140)),
    (12, prose(300, 4)), (13, prose(50, 5) + " " + PASSAGE + " " + prose(30, 6)), (14, PASSAGE + "\n" + prose(90, 7)),
    (None, PASSAGE), (None, None), (15, "\n\n \n"), (16, "É ñandú 東京 don't 'tis  \n\n x's 'S''ll 　 7½"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names that
    operators use inside."""
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, i, t, 3, "x") for i, t in ODD]
    schema = "doc_id long, text string, lang string, source string, id long, digest string, shard int, key string"
    return spark.createDataFrame(rows, schema).withColumn("n_chars", F.char_length("text").cast("long"))


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i, _ in ODD if i] + [(1, 1, 0), (None, 1, 1), (3, None, None), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# words


def test_words_and_shingles():
    import pyarrow as pa

    texts = pa.array([t for _, t in ODD])
    powers, seen = words.Powers(), {}
    for limit in (64, 1 << 20):
        out = []
        for piece in words.pieces(texts, limit):
            own = words.words_of(piece, words.plain_word_bytes(), powers)
            hashes, first = words.shingles_of(own)
            out += [hashes[first[i] : first[i + 1]].tolist() for i in range(len(piece))]
        seen[limit] = out
    assert seen[64] == seen[1 << 20]
    names = {}
    for (_, text), got in zip(ODD, seen[64], strict=True):
        want = [tuple(s) for s in shingles_cased(text)]
        assert len(got) == len(want)
        for s, h in zip(want, got, strict=True):
            assert names.setdefault(s, h) == h
    assert len(set(names.values())) == len(names)


def shingles_cased(text):
    w = WORD.findall(text or "")
    return [w[i : i + 5] for i in range(max(1, len(w) - 4))] if w else []


# 1 and 8


@pytest.mark.parametrize("fit, score, label", [
    (toxicity.fit_toxicity, toxicity.score_toxicity, "toxic"),
    (quality_classifier.fit_quality, quality_classifier.score_quality, "quality"),
])
def test_classifiers_take_odd_rows(odd, none, labels, fit, score, label):
    model = fit(odd, labels)
    got = score(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1
    assert score(none, model).count() == 0
    blank = fit(none, labels.filter("false"))
    assert {round(r.score, 6) for r in score(odd, blank).collect()} == {0.5}


def test_training_never_sees_held_out_rows(odd, labels):
    sample = shared.labelled_sample(odd, labels, "toxic", 1000, 1).collect()
    out = {str(i) for i, _ in ODD if i and zlib.crc32(str(i).encode()) % 5 == 0}
    assert out
    texts = {t for i, t in ODD if i and str(i) not in out}
    assert sample and all(r.text in texts for r in sample)


@pytest.mark.parametrize("name, label, least", [("op1_toxicity", "toxic", 0.8), ("op8_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    folder = FOLDER.replace("sf0.01", "sf0.1")
    rows = registry.queries()[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    held = rows.filter("held_out").collect()
    for truth in (0, 1):
        own = [r.predicted for r in held if r[label] == truth]
        assert own and sum(p == truth for p in own) / len(own) >= least


def test_dual_coordinate_descent_reaches_the_dual_optimum():
    own = np.random.default_rng(3)
    docs = [np.arange(4) for _ in range(60)]
    values = [own.normal(size=4) for _ in range(60)]
    y = np.array([int(v @ [1, -2, 0.5, 0] > 0) for v in values])
    w, b = quality_classifier.dual_coordinate_descent(
        docs, values, y, 4, quality_classifier.Svm(epochs=2000, tolerance=1e-9, cost=1.0))

    def loss(w, b):
        sign = np.where(y > 0, 1, -1)
        cost = 0.5 / np.where(y > 0, y.mean(), 1 - y.mean())
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - sign * (np.array(values) @ w + b))).sum()

    best = loss(w, b)
    assert all(best <= loss(w + d[:4], b + d[4]) + 1e-7 for d in own.normal(scale=1e-3, size=(200, 5)))


# 2


def plain_benchmark(docs, items):
    out = {}
    for i, text in docs:
        for b, item in items:
            g, own = shingles(text), shingles(item)
            if len(words_of(item)) < 5 and own:
                n = len(words_of(item))
                w = words_of(text)
                g = [tuple(w[k : k + n]) for k in range(max(0, len(w) - n + 1))]
            if not g or not own or not set(g) & set(own):
                continue
            count, best = collections.Counter(own), 0
            for at in range(max(1, len(g) - len(own) + 1)):
                win = collections.Counter(g[at : at + len(own)])
                best = max(best, sum((win & count).values()) / sum((win | count).values()))
            if best >= 0.8:
                out[i, b] = best
    return out


def test_decontamination(spark, odd, none):
    items = [(0, PASSAGE), (1, "one two three"), (2, ""), (3, None), (4, prose(70, 99)), (None, PASSAGE), (5, prose(80, 3).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, t) for i, t in ODD if t != LONG and t != LONG + " end"]
    want = plain_benchmark(docs, [(i, t) for i, t in items if i is not None])
    for block in (16 << 20, 200):
        got = decontaminate.find_benchmark(odd, bench, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
        assert sum((r.doc_id, r.item_id) == (6, 1) for r in got) == 2
    clean = decontaminate.drop_contaminated(odd, bench)
    assert clean.columns == odd.columns
    bad = {i for i, _ in want}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in ODD if i not in bad or t is None)
    assert decontaminate.find_benchmark(none, bench).count() == 0
    assert decontaminate.find_benchmark(odd, bench.filter("false")).count() == 0



def test_windows_against_plain_counts(monkeypatch):
    """Fingerprints and similarities of windows by running sums, over several slices."""
    monkeypatch.setattr(decontaminate, "SLICE", 64)
    own = np.random.default_rng(3)
    few = own.integers(0, 1 << 63, 12, np.uint64) * np.uint64(2) + np.uint64(1)
    shingled = np.where(own.random(600) < 0.7, few[own.integers(0, 12, 600)], own.integers(0, 1 << 63, 600, np.uint64))
    for width, length in ((1, 1), (7, 7), (30, 30), (30, 45), (100, 100)):
        item = few[own.integers(0, 12, length)]
        for starts in (np.arange(601 - width), np.sort(own.choice(601 - width, 40, False)), np.array([5]), np.array([], np.int64)):
            got = decontaminate.fingerprints(shingled, starts, width)
            bits = [np.unpackbits(shingled[s : s + width].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0) for s in starts]
            assert got.tolist() == [np.packbits(2 * b.astype(int) > width).tolist() for b in bits]
            if len(starts):
                want, have = [], collections.Counter(item.tolist())
                for s in starts:
                    win = collections.Counter(shingled[s : s + width].tolist())
                    want.append(sum((win & have).values()) / sum((win | have).values()))
                assert np.allclose(decontaminate.weighted_jaccard(shingled, starts, width, item), want)


def test_long_items_need_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    item = prose(10_000, 31)
    text = " ".join([prose(20_000, 32), edited(item, 2500), prose(20_000, 33)])
    index = decontaminate.index_items(pa.table({"item_id": [1], "text": [item]}), 23, 0.8)
    tracemalloc.start()
    row, found, score, start, length = decontaminate.best_matches(pa.array([text]), index, words.Powers())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (row.tolist(), found.tolist(), start.tolist(), length.tolist()) == ([0], [1], [20_000], [10_000])
    assert 0.9 < score[0] < 1 and peak < 200 << 20


def test_multi_index_finds_all_within_radius():
    own = np.random.default_rng(1)
    group = decontaminate.SameLength.of(np.arange(50), own.integers(0, 1 << 63, (50, 30), np.uint64), 23)
    prints = group.prints[own.integers(0, 50, 400)] ^ np.packbits(own.random((400, 64)) < 0.3, axis=1)
    far = decontaminate.ONES[prints[:, None] ^ group.prints[None]].sum(axis=2)
    r, c = group.within(prints, 23)
    assert set(zip(r.tolist(), c.tolist(), strict=True)) == set(zip(*(a.tolist() for a in np.nonzero(far <= 23)), strict=True))


# 3


def test_sharding(spark, odd, none):
    rows = sharding.shard_documents(odd, shards=3).collect()
    assert len(rows) == len(ODD)
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[bytes(r.digest)].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    for shard in range(3):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert sharding.shard_documents(none, shards=3).count() == 0


def test_shards_are_near_equal_and_best_fit_is_followed():
    own = random.Random(5)
    sizes = collections.Counter(own.randrange(1, 3000) for _ in range(5000))
    runs = sharding.into_shards(list(sizes.items()), 8)
    loads = collections.Counter()
    for size, a, b, k in runs:
        loads[k] += size * (b - a)
    assert max(loads.values()) - min(loads.values()) <= 0.001 * max(loads.values())
    placed = collections.Counter()
    for size, a, b, _ in runs:
        placed[size] += b - a
    assert placed == sizes
    # Best fit, a group at a time, over a plain list.
    items, capacity = sorted(own.choices(range(1, 60), k=300), reverse=True), 100
    room, want = [], []
    for n in items:
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        k = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(capacity)
        room[k] -= n
        want.append(k)
    runs, bins = sharding.best_fit_decreasing(sorted(collections.Counter(items).items(), reverse=True), capacity)
    assert bins == len(room)
    assert [k for _, a, b, k in runs for _ in range(b - a)] == want
    hot = sharding.into_shards([(1000, 1), (1, 700)], 8)
    loads = collections.Counter()
    for size, a, b, k in hot:
        loads[k] += size * (b - a)
    assert sorted(loads.values()) == [100] * 7 + [1000]


# 4


def test_quality_rules(spark, odd, none):
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == len(ODD)
    for i, t in ODD:
        r = next(r for r in rows if r.doc_id == i and (i is not None or r.n_words == len((t or "").split())))
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.base_failed == (len(w) < 10 or 100 * r.n_repeat_words > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(none).count() == 0


def test_sketches_merge_and_are_near(spark):
    own = np.random.default_rng(2)
    values = own.lognormal(size=4000)
    df = spark.createDataFrame([(k % 2, float(v)) for k, v in enumerate(values)], "half int, value double")
    merged = quality_rules.merge(quality_rules.sketch(df, ["half"]), [])
    got = quality_rules.quantiles(merged, [], {"low": 0.25, "high": 0.75}).first()
    assert got.n == 4000
    for name, share in (("low", 0.25), ("high", 0.75)):
        assert abs(got[name] / np.quantile(values, share) - 1) < 0.02


# 5


def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    own = tokenizers.Tokenizer.from_file(registry.tokenizer_path())
    own.encode_special_tokens = True
    return own


def check_packing(rows, texts, size=2048):
    own = tokenizer()
    by_doc, by_sequence, total = collections.defaultdict(list), collections.defaultdict(list), 0
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, copies in texts.items():
        want = collections.Counter()
        for text in copies:
            ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            total += len(ids)
            for k, (at, n) in enumerate(packing.cut(len(ids), size)):
                want[k, at, n, zlib.crc32(ids[at : at + n].tobytes())] += 1
        assert collections.Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == want
    for parts in by_sequence.values():
        upto = 0
        for at, n in sorted(parts):
            assert at == upto
            upto += n
        assert upto <= size
    return len(by_sequence), -(-total // size)


def test_packing(spark, odd, none):
    texts = collections.defaultdict(list)
    for i, t in ODD:
        texts[i].append(t)
    rows = packing.pack_documents(odd, registry.tokenizer_path()).collect()
    used, least = check_packing(rows, texts)
    assert used == least
    assert packing.pack_documents(none, registry.tokenizer_path()).count() == 0
    made = packing.token_pieces(odd, registry.tokenizer_path(), with_ids=True).filter("doc_id = 5").first()
    assert made.ids == [*tokenizer().encode("one two three").ids, 0]


def test_packing_in_many_groups(spark):
    own = random.Random(4)
    df = spark.createDataFrame([(i, own.randrange(1, 2048)) for i in range(3000)], "doc_id long, length long")
    rows = packing.pack_pieces(df, group_rows=300).collect()  # groups this small waste some 4 %
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    fill = collections.Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= 1.05 * sum(fill.values()) / 2048


def test_pretokens_are_the_librarys():
    import pyarrow as pa

    from tillwise.llm.tokens import Tokenizer

    own = random.Random(8)
    letters = "ab'sStTrvemld 12.,!? \n\t é東\U0001f600½"
    texts = ["".join(own.choice(letters) for _ in range(own.randrange(40))) for _ in range(3000)]
    mine, theirs = Tokenizer(registry.tokenizer_path()), tokenizer()
    for piece in words.pieces(pa.array(texts), 1 << 14):
        ids, first = mine.encode(piece)
        for i in range(len(piece)):
            want = theirs.encode(texts[piece.first + i], add_special_tokens=False).ids
            assert ids[first[i] : first[i + 1]].tolist() == want, repr(texts[piece.first + i])


def test_added_tokens_are_the_librarys():
    """The library as it comes: strings of added tokens in a text are those tokens."""
    import pyarrow as pa

    from tillwise.llm.tokens import Tokenizer

    theirs = pytest.importorskip("tokenizers").Tokenizer.from_file(registry.tokenizer_path())
    own = random.Random(10)
    parts = ["<|endoftext|>", "<|endoftext|", "<|", "|>", "endoftext", " ", "  ", "a", "'s", "\n", "東", "1"]
    texts = ["<|endoft", "ext|>", "", "x <|endoftext|> y", "<|endoftext|>"]
    texts += ["".join(own.choice(parts) for _ in range(own.randrange(12))) for _ in range(2000)]
    mine = Tokenizer(registry.tokenizer_path())
    for piece in words.pieces(pa.array(texts), 1 << 12):
        ids, first = mine.encode(piece)
        for i in range(len(piece)):
            want = theirs.encode(texts[piece.first + i], add_special_tokens=False).ids
            assert ids[first[i] : first[i + 1]].tolist() == want, repr(texts[piece.first + i])


def test_local_search_empties_bins():
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = packing.LocalSearch(lengths, [[0, 5], [1, 6], [2], [3, 4]], 10).run()
    assert len(bins) == 3
    assert sorted(i for b in bins for i in b) == list(range(7))



def helps(lengths, bins, size):
    """Whether some move, exchange or two-for-one exchange makes a bin fuller that is at least as full."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    for k, giver in enumerate(bins):
        for t, taker in enumerate(bins):
            if t == k or fill[k] == size or not fill[k] <= fill[t] < size:
                continue
            singles = [lengths[i] for i in giver]
            pairs = [a + b for a, b in itertools.combinations(singles, 2)]
            for back in (0, *(lengths[j] for j in taker)):
                if any(0 < x - back <= size - fill[t] for x in singles + (pairs if back else [])):
                    return True
    return False


def fewest(lengths, size):
    """Fewest bins by trying every place of every document."""
    least = len(lengths)

    def place(at, rooms):
        nonlocal least
        if len(rooms) >= least:
            return
        if at == len(lengths):
            least = len(rooms)
            return
        for r in {r for r in rooms if r >= lengths[at]}:
            rest = list(rooms)
            rest.remove(r)
            place(at + 1, rest + [r - lengths[at]])
        place(at + 1, rooms + [size - lengths[at]])

    place(0, [])
    return least


def test_local_search_ends_where_nothing_helps():
    own = random.Random(12)
    more = 0
    for case in range(150):
        lengths = np.array(sorted((own.randint(1, 30) for _ in range(own.randint(1, 9))), reverse=True))
        start = packing.best_fit(lengths, 40)
        got = packing.pack(lengths, 40)
        assert sorted(i for b in got for i in b) == list(range(len(lengths)))
        assert all(lengths[b].sum() <= 40 for b in got) and not helps(lengths.tolist(), got, 40)
        least = fewest(lengths.tolist(), 40)
        assert least <= len(got) <= min(len(start), least + 1)
        more += len(got) - least
    assert more <= 3
    # Many underfull bins at once, and bins of many small documents.
    for low, high, n in ((300, 1000, 250), (1, 2047, 200), (20, 90, 300)):
        lengths = np.array([own.randint(low, high) for _ in range(n)])
        assert not helps(lengths.tolist(), packing.pack(lengths, 2048), 2048)


def test_repeated_pieces_spread_over_groups(spark):
    df = spark.createDataFrame([(None, 1500, 7)] * 600 + [(None, 500, 7)] * 600, "doc_id long, length long, offset int")
    df = shared.durable(df.withColumn("_group", F.lit(3)).withColumn("_again", F.lit("x")))
    got = packing.pack_pieces(df, group_rows=100)
    assert got.columns == ["doc_id", "length", "_group", "_again", "sequence_id", "offset"]
    rows = got.collect()
    assert len(rows) == 1200 and {(r._group, r._again) for r in rows} == {(3, "x")}
    assert len({(r.sequence_id >> 22) & 0xFFFFFFFF for r in rows if r.sequence_id >> 54 == 0}) > 8
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    assert all(sorted(x) in ([(0, 1500)], [(0, 1500), (1500, 500)], [(0, 500), (500, 1500)]) or {n for _, n in x} == {500}
               for x in places.values())
    assert len(places) <= 612  # 600 is least; groups of 100 rows waste up to 2 %


# 6


def test_compact_windows_are_cartesian_tree_nodes():
    own = np.random.default_rng(6)
    first = np.array([0, 40, 43, 43, 120])
    values = own.integers(0, 1 << 63, 120, np.uint64)
    for least in (1, 5, 20):
        want = set()
        for a, b in zip(first[:-1], first[1:], strict=True):
            for c in range(a, b):
                low = c
                while low > a and values[low - 1] > values[c]:
                    low -= 1
                high = c
                while high + 1 < b and values[high + 1] > values[c]:
                    high += 1
                if high - low + 1 >= least:
                    want.add((c, low, high))
        got = substring_dedup.compact_windows(values, first, least)
        assert set(zip(*(a.tolist() for a in got), strict=True)) == want


def test_shared_passages(spark, odd, none):
    rows = substring_dedup.shared_passages(odd).collect()
    classes = collections.defaultdict(set)
    for r in rows:
        classes[r.class_id, r.class_start_word].add(r.doc_id)
    assert {7, 8} in classes.values() and {9, 10} in classes.values() and {11, 12} in classes.values()
    assert {13, 14} in classes.values()
    assert {r.doc_id for r in rows} == {7, 8, 9, 10, 11, 12, 13, 14}
    spot = next(r for r in rows if r.doc_id == 13)
    assert abs(spot.start_word - 50) <= 4 and abs(spot.n_words - 60) <= 8
    assert substring_dedup.shared_passages(none).count() == 0


def test_passages_in_a_hot_line(spark):
    """A line that all documents hold, in unlike surroundings, hides no equal passage."""
    line = prose(30, 50)
    docs = [(i, f"{prose(40, 100 + i)} {line} {prose(40, 500 + i)}") for i in range(60)]
    shared_text = f"{prose(20, 900)} {line} {prose(20, 901)}"
    docs += [(100 + i, f"{prose(40, 700 + i)} {shared_text} {prose(40, 800 + i)}") for i in range(5)]
    rows = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows} == set(range(100, 105)) and len({r.class_id for r in rows}) == 1


def test_recall_of_short_near_copies(spark):
    """Passages of 50 to 80 words with one other word, at or above the least similarity."""
    own, docs = random.Random(61), []
    for k in range(200):
        words_in = prose(50 + k % 31, 20_000 + k).split(" ")
        docs.append((2 * k, f"{prose(120, 30_000 + k)} {' '.join(words_in)} {prose(120, 40_000 + k)}"))
        words_in[own.randrange(15, 35)] += "x"
        docs.append((2 * k + 1, f"{prose(120, 50_000 + k)} {' '.join(words_in)} {prose(120, 60_000 + k)}"))
    rows = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    classes = collections.defaultdict(set)
    for r in rows:
        classes[r.class_id, r.class_start_word].add(r.doc_id)
    lost = [k for k in range(200) if {2 * k, 2 * k + 1} not in classes.values()]
    assert not lost


def test_parts_of_near_copies_in_another_order():
    own = np.random.default_rng(9)

    def near(run):
        out = run.copy()
        out[[25, 26, 27, 28, 29]] = own.integers(0, 1 << 63, 5, np.uint64)
        return out

    one, two, more, gap = (own.integers(0, 1 << 63, n, np.uint64) for n in (70, 70, 20, 200))
    for mine, other, want in (
        (np.concatenate((one, two)), np.concatenate((near(two), gap, near(one))), [(0, 70), (70, 140)]),
        (np.concatenate((one, two)), np.concatenate((near(two), near(one))), [(0, 70), (70, 140)]),
        (np.concatenate((one, more)), np.concatenate((more, gap, near(one))), [(0, 70)]),
        (one, np.concatenate((one[:30], gap, near(one))), [(0, 70)]),
    ):
        found = substring_dedup.shared_parts(mine, other, 46, 0.8)
        for low, high in want:
            assert any(abs(a - low) <= 5 and abs(b - high) <= 5 for a, b, *_ in found), (low, high, found)


def test_parts_that_repeat_on_one_side():
    """A passage that repeats one shingle is found also where the other side has few of them."""
    few, many = np.full(15, 7, np.uint64), np.full(130, 7, np.uint64)
    assert (0, 130) in {p[2:4] for p in substring_dedup.shared_parts(few, many, 46, 0.8)}
    assert (0, 130) in {p[:2] for p in substring_dedup.shared_parts(many, few, 46, 0.8)}


def test_all_places_of_a_signature(spark):
    """Every place of a passage has its windows, and each is linked."""
    text = prose(50, 8000)
    docs = [(1, f"{prose(90, 8001)} {text} {prose(90, 8002)} {text} {prose(90, 8003)}"), (2, f"{prose(70, 8004)} {text}")]
    named = spark.createDataFrame(docs, "doc long, text string")
    rows = substring_dedup.window_rows(named, 46, range(substring_dedup.PAIRS))
    places = collections.defaultdict(set)
    for r in rows.collect():
        places[r.key].add((r.doc, r.at))
    whole = [v for v in places.values() if len(v) == 3]
    assert len(whole) >= substring_dedup.PAIRS  # at least the window of the whole passage
    linked = {(r.doc, r.at) for r in substring_dedup.stars(rows).collect()}
    assert all(len(v - linked) == 1 and min(v) not in linked for v in whole)


def test_near_copies_around_a_hot_line(spark):
    """A line that all documents hold, in unlike surroundings, hides no near copy."""
    line = prose(44, 50)
    docs = [(i, f"{prose(40, 2100 + i)} {line} {prose(40, 2500 + i)}") for i in range(60)]
    for k in range(60):
        words_in = f"{prose(3, 9000 + 2 * k)} {line} {prose(3, 9001 + 2 * k)}".split(" ")
        docs.append((100 + 2 * k, f"{prose(40, 3000 + k)} {' '.join(words_in)} {prose(40, 3100 + k)}"))
        words_in[20 + k % 10] += "x"
        docs.append((101 + 2 * k, f"{prose(40, 3200 + k)} {' '.join(words_in)} {prose(40, 3300 + k)}"))
    rows = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r.doc_id for r in rows}
    assert not [i for i in range(100, 220) if i not in got]


def test_links_of_a_key_cross_tasks(spark):
    rows = [(7, d, 10, 5, 5) for d in range(200)] + [(k, k, 1, 1, 1) for k in range(100, 300)]
    df = spark.createDataFrame(rows, "key long, doc long, at int, before int, after int").repartition(5)
    got = substring_dedup.stars(df).collect()
    parent = {r.doc: r.to_doc for r in got}
    assert all(r.key == 7 for r in got) and set(parent) == set(range(1, 200))

    def top(x):
        while x in parent:
            x = parent[x]
        return x

    assert {top(x) for x in parent} == {0}


def test_windows_only_where_documents_are_alike(spark, monkeypatch):
    """Texts that share nothing, and copies, make no rows of windows; of others only the stretches that are alike do."""
    made, plain = [], substring_dedup.window_rows

    def counted(docs, least, pairs):
        rows = plain(docs, least, pairs)
        made.extend((r.doc, r.at - r.before, r.at + r.after) for r in rows.collect())
        return rows

    monkeypatch.setattr(substring_dedup, "window_rows", counted)
    docs = [(i, prose(300, 61_000 + i)) for i in range(30)]
    docs += [(100 + i, docs[7][1]) for i in range(5)]
    assert {r.doc_id for r in substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == {
        7, 100, 101, 102, 103, 104,
    }
    assert not made
    words_in = prose(60, 62_000).split(" ")
    docs.append((200, f"{prose(400, 62_001)} {' '.join(words_in)} {prose(400, 62_002)}"))
    words_in[30] += "x"
    docs.append((201, f"{prose(150, 62_003)} {' '.join(words_in)} {prose(700, 62_004)}"))
    rows = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    classes = collections.defaultdict(set)
    for r in rows:
        classes[r.class_id, r.class_start_word].add(r.doc_id)
    assert sorted(map(sorted, classes.values())) == [[7, 100, 101, 102, 103, 104], [200, 201]]
    assert made and {d for d, _, _ in made} == {200, 201}
    for doc, low, high in ((200, 400, 456), (201, 150, 206)):
        assert all(low - 80 <= a and b <= high + 80 for d, a, b in made if d == doc)


def test_runs_that_are_looked_up():
    """Any 41 alike of 46 places in a row, apart by changed words, have a run of RUN; others may have shorter ones only."""
    assert substring_dedup.run_length(46, 0.8) == substring_dedup.RUN
    assert substring_dedup.run_length(46, 0.5) == 7 and substring_dedup.run_length(1, 0.8) == 1
    spots = np.array([20, 32, 44, 200]) * substring_dedup.SPOT**2 + 11 * substring_dedup.SPOT + 11
    text, low, high = substring_dedup.stretches(spots, np.array([0, 0, 0, 1]), np.array([100, 300]), 46, 0.2)
    assert text.tolist() == [0] and low[0] <= 9 and 56 <= high[0] <= 70


def test_further_rows_of_a_document_cross_tasks(spark):
    """Every row with a key of two documents or more is linked once, to another document, also where tasks share the key."""
    rows = [(k, d, at, 1, 1) for k, docs in ((1, 40), (2, 1), (3, 2), (4, 9)) for d in range(k, k + docs) for at in range(12)]
    conf = {"spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        got = substring_dedup.stars(spark.createDataFrame(rows, "key long, doc long, at int, before int, after int")).collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    linked = [(r.key, r.doc, r.at) for r in got]
    assert all(r.doc != r.to_doc for r in got) and len(set(linked)) == len(linked)
    assert set(linked) == {r[:3] for r in rows if r[0] != 2} - {(k, k, 0) for k in (1, 3, 4)}


def test_equal_passages_on_test_data(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    runs = collections.defaultdict(set)
    for r in docs.collect():
        w = words_of(r.text)
        for k in range(len(w) - 50):
            runs[tuple(w[k : k + 51])].add(r.doc_id)
    want = {i for s in runs.values() if len(s) > 1 for i in s}
    got = {r.doc_id for r in registry.queries()["op6_substring_dedup"](spark, FOLDER).collect()}
    assert want <= got


# 7


def plain_classes(docs, similarity=0.8):
    sets = {k: set(shingles(t)) for k, (_, t) in enumerate(docs)}
    parent, links = {k: k for k in sets}, collections.Counter()

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            held[x].append(k)
    pairs = {(a, b) for v in held.values() for i, a in enumerate(v) for b in v[i + 1 :]}
    pairs |= {(a, b) for a in sets for b in sets if a < b and (docs[a][1] or "") == (docs[b][1] or "")}
    for a, b in pairs:
        same = (docs[a][1] or "") == (docs[b][1] or "")
        if docs[a][0] is not None and docs[b][0] is not None and (same or len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])):
            links[a] += 1
            links[b] += 1
            parent[top(a)] = top(b)
    smallest = {}
    for k in sets:
        if docs[k][0] is not None:
            smallest[top(k)] = min(smallest.get(top(k), docs[k][0]), docs[k][0])
    return sorted((str(i), str(smallest.get(top(k)) if i is not None else None), links[k]) for k, (i, _) in enumerate(docs))


def test_jaccard_join(spark, odd, none):
    got = jaccard_join.jaccard_classes(odd).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == plain_classes(ODD)
    assert jaccard_join.jaccard_classes(none).count() == 0


def test_jaccard_join_in_blocks(spark, monkeypatch):
    base = prose(200, 31)
    docs = [(i, edited(base, 60 + i)) for i in range(60)] + [(100 + i, edited(base, 60 + i)) for i in range(0, 60, 7)]
    docs += [(200 + i, prose(100, 400 + i)) for i in range(40)]
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    got = jaccard_join.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == plain_classes(docs)


def test_jaccard_join_on_test_data(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = registry.queries()["op7_jaccard_join"](spark, FOLDER).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == plain_classes(docs)


def test_pruning_keeps_what_can_reach_the_bound():
    for n in (8, 16, 48):
        m = jaccard_join.least_matches(n, 0.8, 1e-4)
        grid = np.linspace(0, 1, 20001)
        mass = [(grid ** k * (1 - grid) ** (n - k)) for k in (m, m - 1) if k >= 0]
        posterior = [p[grid >= 0.8].sum() / p.sum() for p in mass]
        assert posterior[0] >= 1e-4 * 0.98 and (len(posterior) == 1 or posterior[1] < 1e-4 * 1.02)


def test_components(spark):
    own = random.Random(9)
    edges = [(own.randrange(400), own.randrange(400)) for _ in range(250)] + [(1000 + k, 1001 + k) for k in range(100)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    got = shared.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.root for r in got} == {x: top(x) for e in edges if e[0] != e[1] for x in e}
    assert len(got) == len({r.id for r in got})


# 9


def test_line_dedup(spark, odd, none):
    line = "A line of more than forty characters, shared."
    texts = [f"{line}\nown {i}\n  {line.upper()} \n" for i in range(5)] + [line, line, f"x\n{line[:39]}", None, ""]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, f"{line}\nother"), (None, line), (6, f"z\n{line}")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id long, text string, key string, n_dropped int")
    bitmaps = line_dedup.keep_bitmaps(df)
    got = line_dedup.drop_lines(df, bitmaps)
    assert got.columns == df.columns
    want = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i == 6 or x.strip(" \t\r").lower() != line.lower()]
        want.append((str(i), t if len(kept) == len(lines) else "\n".join(kept)))
    assert sorted((str(r.doc_id), r.text) for r in got.collect() if r.doc_id != 8) == sorted(w for w in want if w[0] != "8")
    assert line_dedup.line_report(odd, line_dedup.keep_bitmaps(odd)).count() == len(ODD)
    assert line_dedup.line_report(none, line_dedup.keep_bitmaps(none)).count() == 0


# 10


def test_first_lines_stream_in_range_order(spark):
    """One exchange by range serves the window; a document with many equal lines has no array of them."""
    line = "x" * 50
    rows = [(i, f"{line}\n{line}\nown {i}") for i in range(5)] + [(4, f"{line}\n{line}\nown 4"), (3, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["_did"], r["n_lines"]): [tuple(k) for k in r["keep"]] for r in line_dedup.keep_bitmaps(docs).collect()}
    assert found == {(i, 3): [(2, 1)] for i in range(4)} | {(3, 1): []}


def test_warc_tells_what_its_header_lines_say(spark, tmp_path):
    rows = [(1, "u", "same"), (2, "u\u2028WARC-Type: revisit", "same"), (3, "a: b", "other"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.write_archive(pages, str(tmp_path / "archive"))
    headers = spark.read.parquet(f"{folder}/headers")
    assert headers.columns == ["header"]
    kept = headers.collect()

    def damaged(old, new):
        path = str(tmp_path / f"damaged-{abs(hash((old, new)))}")
        for part in ("payloads", "digests"):
            spark.read.parquet(f"{folder}/{part}").write.parquet(f"{path}/{part}")
        changed = [(h.header.replace(old, new),) for h in kept]
        spark.createDataFrame(changed, "header string").write.parquet(f"{path}/headers")
        return {r.page_id: tuple(r)[1:] for r in warc.read_digests(spark, path).collect()}

    whole = damaged("none at all", "")
    assert whole[1][2:] == ("revisit", 2) and whole[2][2:] == ("response", None) and whole[None][0] == 0
    assert damaged("WARC-Type: revisit\r\n", "garbage\r\n")[1][2:] == (None, 2)
    assert damaged("Payload-Length: 4", "Payload-Length: 5")[1][:2] == (None, None)
    assert damaged("sha1:", "sha1:A")[3][:2] == (None, None)
    assert damaged("sha256:", "sha256:x")[3][:2] == (None, None)
    spark.createDataFrame([("garbage",)], "header string").write.mode("append").parquet(f"{folder}/headers")
    assert sum(r.record is None for r in warc.read_records(spark, folder).collect()) == 1


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""),
            (None, "n", "<p>é</p>"), (None, "n", "alone"), (5, "u", "x" * 100_000)]
    pages = spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, sha256 string")
    folder = warc.write_archive(pages, str(tmp_path / "archive"))
    records = warc.read_records(spark, folder).collect()
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in records) == sorted((str(i), h or "") for i, _, h in rows)
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[length:] == b"\r\n\r\n" and b"\nX: y" not in head
        if b"Type: response" in head:
            assert rest[:length].endswith(bytes(r.payload))
    kinds = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in warc.read_digests(spark, folder).collect()}
    assert kinds[1, 9] == ("revisit", 2) and kinds[2, 9] == ("response", None) and kinds[None, 9] == ("revisit", 2)
    assert kinds[3, 0] == ("revisit", 4) and kinds[4, 0] == ("response", None) and kinds[None, 5] == ("response", None)
    assert spark.read.parquet(f"{folder}/payloads").select("sha256").distinct().count() == 4
    longer = warc.write_archive(pages, str(tmp_path / "longer"), min_bytes=10)
    assert {r.record_type for r in warc.read_digests(spark, longer).collect()} == {"response"}
    blank = warc.write_archive(pages.filter("false"), str(tmp_path / "blank"))
    assert warc.read_digests(spark, blank).count() == 0


# queries


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duck(FOLDER)
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = registry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert collections.Counter(map(tuple, df.select(*names).collect())) == collections.Counter(map(tuple, result.fetchall()))


def test_no_python_in_line_dedup(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = line_dedup.line_report(docs, line_dedup.keep_bitmaps(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pipeline(spark):
    import corpus_pipeline as p

    folder = FOLDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scores = {r.doc_id: r.predicted for r in registry.queries()["op8_quality"](spark, folder).collect()}
    plain = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id]]
    holders = collections.defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({k: k + 32 for k in range(65, 91)})
    for i, t in plain:
        for x in t.split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(i)
    plain = [(i, "\n".join(x for x in t.split("\n") if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == i)) for i, t in plain]
    stage = docs
    for _, f in p.STAGES[:2]:
        stage = shared.durable(f(spark, stage, folder))
    assert sorted((r.doc_id, r.text) for r in stage.collect()) == sorted(plain)
    assert stage.filter("n_chars <> char_length(text)").count() == 0
    classes = {int(i): int(c) for i, c, _ in plain_classes(plain)}
    plain = [(i, t) for i, t in plain if classes[i] == i]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {i for i, _ in plain_benchmark(plain, bench)}
    plain = [(i, t) for i, t in plain if i not in bad]
    rows = p.run(spark, folder).collect()
    used, least = check_packing(rows, {i: [t] for i, t in plain})
    assert {r.doc_id for r in rows} == {i for i, _ in plain} and used <= least + 1


def test_stages_keep_columns_with_names_of_their_own(spark, odd):
    clash = "_keep _did _tid _n_dropped _text _h1 _digest".split()
    docs = odd.select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    plain = docs.select("doc_id", "text")
    for stage in (
        lambda d: line_dedup.drop_lines(d, line_dedup.keep_bitmaps(d)),
        lambda d: decontaminate.drop_contaminated(d, bench),
    ):
        kept = stage(docs)
        assert kept.columns == docs.columns
        rows = collections.Counter(map(tuple, kept.collect()))
        assert rows == collections.Counter((*r, *range(len(clash))) for r in stage(plain).collect())


def test_ftrl_against_a_plain_loop():
    own = random.Random(9)
    texts = [[own.randrange(60) for _ in range(own.randint(0, 12))] for _ in range(300)]
    labels = [int(3 in t or own.random() < 0.1) for t in texts]
    how = toxicity.Ftrl(l1=1.5, epochs=2)
    # Features of a text are different from each other, as the operator makes them.
    texts = [sorted(set(t)) for t in texts]
    z, n, bias_z, bias_n = collections.defaultdict(float), collections.defaultdict(float), 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= how.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * how.l1) / ((how.beta + n[i] ** 0.5) / how.alpha + how.l2)

    order = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for row in order.permutation(len(texts)):
            w = {i: weight(i) for i in texts[row]}
            bias = -bias_z / ((how.beta + bias_n**0.5) / how.alpha)
            g = 1 / (1 + np.exp(-(sum(w.values()) + bias))) - labels[row]
            for i in w:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / how.alpha * w[i]
                n[i] += g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / how.alpha * bias
            bias_n += g * g
    got, bias = toxicity.ftrl([np.array(t, np.int64) for t in texts], np.array(labels), 64, how)
    assert np.allclose(got, [weight(i) for i in range(64)], atol=1e-9)
    assert np.isclose(bias, -bias_z / ((how.beta + bias_n**0.5) / how.alpha))
    assert np.argmax(got) == 3
    # With the usual L1 nearly all weights are 0.
    sparse, _ = toxicity.ftrl([np.array(t, np.int64) for t in texts], np.array(labels), 64, toxicity.Ftrl(epochs=2))
    assert (sparse == 0).mean() > 0.8 and sparse[3] > 0


def test_no_group_is_lost_where_ids_repeat(spark):
    import corpus_pipeline

    a, b, c = prose(60, 21), prose(60, 22), prose(200, 23)
    rows = [(1, a), (1, b), (7, b), (1, edited(c, 150)), (9, c), (9, c), (5, a), (8, None), (8, ""), (None, b)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        kept = corpus_pipeline.one_of_each_group(spark, docs, FOLDER).collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted(
            [(1, a), (1, b), (1, edited(c, 150)), (8, ""), (0, b)]
        )
        found = jaccard_join.jaccard_classes(docs).collect()
        assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in found) == sorted(
            [(1, 1, 1), (5, 1, 1), (1, 1, 1), (7, 1, 1), (1, 1, 2), (9, 1, 2), (9, 1, 2), (8, 8, 1), (8, 8, 1), (0, 0, 0)]
        )


def test_stages_take_odd_rows(spark, odd, none):
    import corpus_pipeline as p

    folder = FOLDER.replace("sf0.01", "sf0.001")
    for start in (odd, none):
        docs = start.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("key"), F.lit(2).alias("_did2"))
        for _, f in p.STAGES[:-1]:
            after = shared.durable(f(spark, docs, folder))
            assert after.columns == docs.columns
            docs = after
        assert p.STAGES[-1][1](spark, docs, folder).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def plain_places(mine, other, back):
    """Of several places the one that goes on from the last one (back: from the next one)."""
    held = np.isin(mine, other)
    place, last = {}, None
    for i in np.flatnonzero(held)[:: -1 if back else 1].tolist():
        options = np.flatnonzero(other == mine[i])
        if last is None:
            place[i] = int(options[-1 if back else 0])
        else:
            place[i] = int(options[np.argmin(np.abs(options - (place[last] + i - last)))])
        last = i
    return held.tolist(), place


def test_places_of_repeats_are_those_of_a_plain_search_and_found_faster():
    rnd = np.random.default_rng(8)
    for size in (1, 3, 40):
        for _ in range(40):
            mine, other = (rnd.integers(0, size, rnd.integers(1, 60)).astype(np.uint64) for _ in range(2))
            for back in (False, True):
                held, place, choice = substring_dedup.places_in(mine, other, back)
                want, places = plain_places(mine, other, back)
                assert held.tolist() == want and {i: int(place[i]) for i in places} == places
                assert choice == any(np.count_nonzero(other == v) > 1 for v in mine)
    # A step costs no more than a few of Python's own, and not four calls of numpy.
    mine = np.tile(np.arange(50, dtype=np.uint64), 400)
    took = [[], []]
    for _ in range(3):
        for times, step in zip(took, (lambda: substring_dedup.places_in(mine, mine), lambda: [mine[i : i + 2].argmin() for i in range(len(mine))]), strict=True):
            began = time.process_time()
            step()
            times.append(time.process_time() - began)
    assert min(took[0]) < 4 * min(took[1])
