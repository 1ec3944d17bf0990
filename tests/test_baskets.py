import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillwise.functions import make_pairs
from tillwise.operators.baskets import frequent_pairs, pair_counts_small_domain, seen_with


def counted(baskets, more_than=0):
    pairs = Counter(p for items in baskets.values() for p in combinations(sorted(set(items)), 2))
    return sorted((a, b, n) for (a, b), n in pairs.items() if n > more_than)


def as_rows(spark, baskets):
    data = [(b, i) for b, items in baskets.items() for i in items]
    return spark.createDataFrame(data, "basket long, item long")


def found(df):
    return sorted((r["left"], r["right"], r["cnt"]) for r in df.collect())


@pytest.mark.parametrize(
    ("items", "pairs"), [([1, 2, 3], [(1, 2), (1, 3), (2, 3)]), ([7], []), ([], [])]
)
def test_make_pairs(spark, items, pairs):
    df = spark.createDataFrame([(items,)], "a array<long>")
    rows = df.select(F.explode(make_pairs(F.col("a"))).alias("p")).collect()
    assert [tuple(r["p"]) for r in rows] == pairs


@pytest.mark.parametrize("min_count", [0, 1, 3, 8])
@pytest.mark.parametrize(("block", "huge"), [(256, 4096), (3, 10), (1, 2), (5, 1000), (4, None)])
def test_frequent_pairs_is_exact(spark, min_count, block, huge):
    """Some baskets hold nearly every item, with repeats."""
    rnd = random.Random(min_count)
    baskets = {b: [rnd.randrange(25) for _ in range(rnd.randrange(1, 8))] for b in range(60)}
    baskets |= {100 + b: rnd.sample(range(25), 20) * 2 for b in range(4)}
    df = frequent_pairs(
        as_rows(spark, baskets), basket="basket", item="item", min_count=min_count, block=block, huge=huge
    )
    assert found(df) == counted(baskets, min_count)


def test_pair_only_in_huge_baskets(spark):
    """Three huge baskets share 1 and 2; one more basket makes the pair frequent."""
    baskets = {b: list(range(12)) for b in range(3)}
    assert found(frequent_pairs(as_rows(spark, baskets), basket="basket", item="item",
                                min_count=3, block=2, huge=5)) == []
    baskets[9] = [1, 2]
    assert found(frequent_pairs(as_rows(spark, baskets), basket="basket", item="item",
                                min_count=3, block=2, huge=5)) == [(1, 2, 4)]


def test_small_domain(spark):
    rnd = random.Random(5)
    baskets = {b: [rnd.randrange(6) for _ in range(rnd.randrange(1, 9))] for b in range(80)}
    rows = as_rows(spark, baskets).unionByName(
        spark.createDataFrame([(1, None)], "basket long, item long")
    )
    assert found(pair_counts_small_domain(rows, basket=["basket"], item="item")) == counted(baskets)


def test_seen_with(spark):
    baskets = {1: [5, 6, 6], 2: [5, 6, 7], 3: [6, 7]}
    df = seen_with(as_rows(spark, baskets), basket=["basket"], item="item", target=5)
    assert sorted((r["item"], r["cnt"]) for r in df.collect()) == [(6, 2), (7, 1)]
