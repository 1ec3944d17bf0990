"""What is bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.baskets import frequent_pairs, pair_counts_small_domain

# Default categories and stores.
CATEGORY_IDS = (1, 2, 3)
STORES = (10, 20, 33, 40, 50)


def _sold_in(t, category_ids, stores) -> DataFrame:
    items = t["item"].filter(F.col("i_category_id").isin(*category_ids))
    sales = t["store_sales"].filter(F.col("ss_store_sk").isin(*stores))
    return sales.join(items, F.col("ss_item_sk") == F.col("i_item_sk"))


def q00(t, *, category_ids=CATEGORY_IDS, stores=STORES) -> DataFrame:
    """Lines sold per category in some stores."""
    return _sold_in(t, category_ids, stores).groupBy("i_category").agg(F.count(F.lit(1)).alias("cnt"))


def q01(t, *, category_ids=CATEGORY_IDS, stores=STORES, min_count=50, limit=100) -> DataFrame:
    """Pairs of items sold on one ticket more than ``min_count`` times."""
    sold = _sold_in(t, category_ids, stores)
    return (
        frequent_pairs(sold, basket="ss_ticket_number", item="ss_item_sk", min_count=min_count)
        .select(F.col("left").alias("item_sk_1"), F.col("right").alias("item_sk_2"), "cnt")
        .orderBy(F.desc("cnt"), "item_sk_1", "item_sk_2")
        .limit(limit)
    )


def top_category_pairs(pairs: DataFrame, limit: int) -> DataFrame:
    return (
        pairs.select(
            F.col("left").cast("long").alias("category_id_1"),
            F.col("right").cast("long").alias("category_id_2"),
            "cnt",
        )
        .orderBy(F.desc("cnt"), "category_id_1", "category_id_2")
        .limit(limit)
    )


def q29(t, *, limit=100) -> DataFrame:
    """Pairs of categories bought in one web order."""
    sold = t["web_sales"].join(t["item"], F.col("ws_item_sk") == F.col("i_item_sk"))
    pairs = pair_counts_small_domain(sold, basket=["ws_order_number"], item="i_category_id")
    return top_category_pairs(pairs, limit)
