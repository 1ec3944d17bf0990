"""Counting things that occur together in one basket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.functions.expressions import make_pairs
from tillwise.session import durable


def pair_counts_of_sets(baskets: DataFrame, items: str) -> DataFrame:
    """(left, right, cnt) from one sorted array of distinct items per basket, for items
    out of a short list such as categories.

    Baskets with equal content are counted first, so pairs are made once per distinct
    set of items and not once per basket.
    """
    return (
        baskets.filter(F.size(items) > 1)
        .groupBy(items)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_n", F.explode(make_pairs(F.col(items))).alias("_pair"))
        .groupBy(F.col("_pair.left").alias("left"), F.col("_pair.right").alias("right"))
        .agg(F.sum("_n").alias("cnt"))
    )


def pair_counts_small_domain(rows: DataFrame, *, basket: list[str], item: str) -> DataFrame:
    """``pair_counts_of_sets`` from rows of baskets."""
    sets = rows.filter(F.col(item).isNotNull()).groupBy(*basket).agg(
        F.sort_array(F.collect_set(item)).alias("_items")
    )
    return pair_counts_of_sets(sets, "_items")


def frequent_pairs(
    rows: DataFrame,
    *,
    basket: str,
    item: str,
    min_count: int,
    block: int = 256,
    huge: int | None = 4096,
) -> DataFrame:
    """(left, right, cnt) for item pairs found together in more than ``min_count``
    baskets, left < right. Exact for any basket size:

    * an item in at most ``min_count`` baskets cannot be in such a pair and goes first;
    * baskets are cut into blocks of about ``block`` items, and each pair of blocks is
      a group of its own, so no group outgrows two blocks; a basket of at most ``block``
      items is one block;
    * an option, off with ``huge=None``: the ``min_count`` biggest baskets (62 at most)
      above ``huge`` items make no pairs. A pair above the threshold must also sit in
      some other basket, so they only add to pairs found there: each item has a bit per
      huge basket holding it.

    The items left after the first step are written to the checkpoint folder, since
    several steps read them.
    """
    rows = rows.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct()
    if min_count > 0:
        frequent = rows.groupBy("item").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_count)
        rows = rows.join(frequent, "item", "left_semi")
    rows = durable(rows)
    sizes = rows.groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.filter(F.col("size") > block)
    if huge is None:
        return _count_pairs(_cut(rows, large, block)).filter(F.col("cnt") > min_count)

    hugest = _hugest(sizes, huge, min(min_count, 62))
    pairs = _count_pairs(_cut(rows.join(hugest, "basket", "left_anti"), large, block))
    masks = rows.join(hugest, "basket").groupBy("item").agg(F.bit_or("bit").alias("mask"))
    both = F.coalesce(F.col("_l.mask").bitwiseAND(F.col("_r.mask")), F.lit(0).cast("long"))
    return (
        pairs.join(masks.alias("_l"), F.col("left") == F.col("_l.item"), "left")
        .join(masks.alias("_r"), F.col("right") == F.col("_r.item"), "left")
        .select("left", "right", (F.col("cnt") + F.bit_count(both)).alias("cnt"))
        .filter(F.col("cnt") > min_count)
    )


def _hugest(sizes: DataFrame, huge: int, most: int) -> DataFrame:
    """(basket, bit) of the biggest baskets, at most 62 rows: one bit of a long each."""
    order = [F.desc("size"), F.col("basket")]
    return (
        sizes.filter(F.col("size") > huge)
        .orderBy(*order)
        .limit(most)
        .withColumn("_place", F.row_number().over(Window.orderBy(*order)) - 1)
        .select("basket", F.expr("shiftleft(1L, _place)").alias("bit"))
    )


def _cut(rows: DataFrame, large: DataFrame, block: int) -> DataFrame:
    """Cut large baskets: every item goes to all pairs of blocks that include its own."""
    cuts = large.select("basket", F.ceil(F.col("size") / block).cast("int").alias("_cuts"))
    return (
        rows.join(cuts, "basket", "left")
        .withColumn("_cuts", F.coalesce("_cuts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("item"), F.col("_cuts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
        .withColumn("low", F.least("own", "_other"))
        .withColumn("high", F.greatest("own", "_other"))
    )


def _count_pairs(cut: DataFrame) -> DataFrame:
    items = F.sort_array(F.collect_list(F.struct("item", "own")))
    return (
        cut.groupBy("basket", "low", "high")
        .agg(items.alias("items"))
        .filter(F.size("items") > 1)
        .select("low", "high", F.explode(make_pairs(F.col("items"))).alias("pair"))
        # Between two blocks, pairs inside one of them belong to another group.
        .filter((F.col("low") == F.col("high")) | (F.col("pair.left.own") != F.col("pair.right.own")))
        .groupBy(F.col("pair.left.item").alias("left"), F.col("pair.right.item").alias("right"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def seen_with(rows: DataFrame, *, basket: list[str], item: str, target: int) -> DataFrame:
    """(item, cnt): number of baskets that hold both the item and ``target``."""
    with_target = rows.filter(F.col(item) == target).select(*basket).distinct()
    return (
        rows.filter(F.col(item) != target)
        .join(with_target, basket, "left_semi")
        .select(*basket, item)
        .distinct()
        .groupBy(item)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
