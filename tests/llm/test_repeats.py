"""Spelling variants, periodic runs and repeated substrings against plain versions."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import periodic_runs, registry, spelling, suffix_dedup
from tillwise.session import checkpoint_dir

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def prose(own, n, size=1000):
    return " ".join(own.choice("the né foo barbaz q lorem ipsum".split()) + str(own.randrange(size)) for _ in range(n))


def odd_texts():
    own = random.Random(11)
    passages = [prose(own, own.randint(5, 80), own.choice([3, 1000])) for _ in range(8)]
    texts = [None, "", " \n\t ", "x", "a " * 400, "ab" * 300, "é" * 300, prose(own, 20_000)]
    for _ in range(50):
        text = prose(own, own.randint(0, 60))
        for _ in range(own.randint(0, 4)):
            p = own.choice(passages)
            text += own.choice([p, p[len(p) // 3 :], p[: len(p) // 2]]) + prose(own, own.randint(0, 30))
        texts.append(text)
    texts += [texts[20]] * 4 + [texts[21] + "!", "!" + texts[21], texts[22][:-3]]
    texts += [" ".join(prose(own, p).split() * 5) + " " + prose(own, 9) for p in (1, 3, 8, 17, 40)]
    return texts


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, null ids, and columns whose names the
    operators use inside."""
    rows = [(i, t, t, 3, 4, t, 1) for i, t in enumerate(odd_texts())] + [(None, odd_texts()[20], "", 0, 0, "", 0), (0, None, "", 0, 0, "", 0)]
    schema = "doc_id long, text string, digest string, id long, rank int, word string, n int"
    return spark.createDataFrame(rows, schema).withColumn("_crc", F.lit("x")).withColumn("_task", F.lit(1)).repartition(3)


# op11


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def forms(words):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_forms(words).collect()}


def test_spelling_forms(spark):
    own, counts = random.Random(3), {}
    for _ in range(150):
        word = "".join(own.choice("abcdeéß") for _ in range(own.randint(7, 12)))
        for n in (20_000, 1500, 120, 10, 2):
            counts[word] = own.choice([n, 10, 100])
            at, letter = own.randrange(len(word)), own.choice("abcxé")
            word = own.choice([word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + word[at + 1 :]])
            if len(word) < 7:
                break
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = plain_forms(counts)
    assert forms(table) == want
    assert sum(w[0] is not None for w in want.values()) > 100
    # Roots several steps away, and words that are alike in their letters only.
    chain = {"aaaaaaaa": 10**6, "aaaaaaab": 10**5, "aaaaaabb": 10**4, "aaaaabbb": 10**3, "aaaabbbb": 100, "bbbbaaaa": 7}
    assert forms(spark.createDataFrame(list(chain.items()), "word string, n long")) == plain_forms(chain)
    assert forms(table.filter("false")) == {}


def test_spelled_runs(odd):
    rows = odd.select("doc_id", "text").collect()
    want = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            at = h % len(run)
            want[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    assert Counter(r.word for r in spelling.spelled_runs(odd).collect()) == want
    known = {r.word: r.n for r in spelling.vocabulary(spelling.spelled_runs(odd), 3).collect()}
    assert known == {w: n for w, n in want.items() if len(w) >= 3 and n >= 2}


# op12


def plain_runs(words):
    found = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(24, 3 * p):
                found.setdefault((start, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def test_runs_are_all_found():
    own, total = random.Random(5), 0
    for _ in range(400):
        kinds = own.choice([1, 2, 2, 3, 5, 50])
        words = [own.randrange(kinds) for _ in range(own.randint(0, 300))]
        for _ in range(own.randint(0, 4) if len(words) > 30 else 0):
            period = [own.randrange(kinds) for _ in range(own.randint(1, len(words) // 4))]
            if own.random() < 0.5:  # a period that is periodic itself but for one word
                period = (period[: max(1, len(period) // own.randint(1, 6))] * len(period))[: len(period)]
                period[own.randrange(len(period))] = 99
            at = own.randrange(len(words))
            for i in range(own.randint(1, len(words) - at)):
                words[at + i] = period[i % len(period)]
        start, end, period = periodic_runs.find_runs(np.array(words + [10**6]))
        want = plain_runs(words)
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want
        total += len(want)
    assert total > 100


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    milli = None if best is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *(best or (None,) * 3), milli, *digests)


def report(docs):
    rows = periodic_runs.run_report(periodic_runs.with_planted_periods(docs)).collect()
    return Counter(tuple(r) for r in rows)


def test_run_report(odd):
    short = odd.filter("text IS NULL OR length(text) < 20000")
    want = Counter(plain_report(r.doc_id, r.text) for r in short.collect())
    assert report(short) == want
    assert sum(n for r, n in want.items() if r[1]) >= 6
    assert report(odd.filter("false")) == Counter()
    assert sum(report(odd).values()) == odd.count()


def test_run_report_on_test_data(spark):
    docs = spark.read.parquet(f"{os.path.dirname(FOLDER)}/sf0.001/documents.parquet")
    texts = docs.select("doc_id", "text").collect()
    rows = registry.queries()["op12_periodic_runs"](spark, f"{os.path.dirname(FOLDER)}/sf0.001").collect()
    got = {r.doc_id: tuple(r) for r in rows}
    assert len(got) == len(texts)
    for r in texts:
        if len(r.text or "") < 12_000:
            assert got[r.doc_id] == plain_report(r.doc_id, r.text)


# op13


@pytest.fixture
def small(spark):
    """Small batches in partitions that stay apart, so that texts and equal keys cross them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def plain_cut(texts, length):
    bodies = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length", [200, 20])
def test_repeated_spans(small, odd, length):
    rows = odd.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *cut) for r, cut in zip(rows, plain_cut([r.text for r in rows], length)))
    found = suffix_dedup.repeated_spans(odd, length=length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == want
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans for r in found)
    assert suffix_dedup.repeated_spans(odd.filter("false"), length=length).count() == 0


@pytest.mark.parametrize("length", [200, 7])
def test_repeated_spans_of_frequent_grams(spark, small, monkeypatch, length):
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 3)
    own = random.Random(5)
    line = prose(own, 40)[:230]
    texts = [prose(own, own.randint(0, 20)) + line + prose(own, own.randint(0, 40)) for _ in range(30)]
    texts += [t[:300] + "z" + t[301:] for t in texts[:8]] + texts[3:5] + [line, line[:200], line[:199], "ab" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = Counter((i, *cut) for i, cut in enumerate(plain_cut(texts, length)))
    found = suffix_dedup.repeated_spans(docs, length=length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == want


def test_repeated_spans_leave_no_tables_of_grams(spark, odd):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    suffix_dedup.repeated_spans(odd)
    left = set(os.listdir(folder)) - before
    files = [os.path.join(folder, d, f) for d in left for f in os.listdir(os.path.join(folder, d)) if f.endswith(".parquet")]
    columns = {c for f in files for c in spark.read.parquet(f).columns}
    assert "low" in columns and not columns & {"name", "rank", "p", "bytes", "packed"}


def test_ranks_of_a_key_that_fills_partitions(spark, small):
    own = random.Random(2)
    keys = [own.choice([7] * 6 + [own.randrange(4000)]) for _ in range(9000)]
    rows = spark.createDataFrame([(k, k % 2, i) for i, k in enumerate(keys)], "a long, b long, id long").repartition(6)
    got = suffix_dedup.ranked(rows, ["a", "b"], ["id"]).collect()
    times = Counter(keys)
    assert sorted(r.id for r in got) == [i for i, k in enumerate(keys) if times[k] > 1]
    pairs = {(r.rank, keys[r.id]) for r in got}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})
    assert Counter(r.rank for r in got if r.opens) == Counter(r[0] for r in pairs)

