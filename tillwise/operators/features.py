"""Feature tables for the models: one row per customer or visitor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import durable

from tillwise.functions.expressions import count_if, ratio, sum_if


def clicks_per_category(
    clicks: DataFrame, item: DataFrame, *, category: str, category_ids: range
) -> DataFrame:
    """Per user: clicks in one named category and in each of some category ids."""
    return (
        clicks.filter(F.col("wcs_user_sk").isNotNull())
        .join(item, F.col("wcs_item_sk") == F.col("i_item_sk"))
        .groupBy("wcs_user_sk")
        .agg(
            sum_if(F.col("i_category") == category, F.lit(1)).alias("clicks_in_category"),
            *[
                sum_if(F.col("i_category_id") == c, F.lit(1)).alias(f"clicks_in_{c}")
                for c in category_ids
            ],
        )
    )


def recency_frequency_money(channels: list[DataFrame], *, today: int, recent_days: int) -> DataFrame:
    """Each channel is (cid, order_no, day, paid). Returns per cid whether the latest
    purchase is less than ``recent_days`` old, the number of orders and the money.

    Every channel is aggregated alone, an order number counting once per channel, and
    the small results are added up.
    """
    per_channel = [
        c.filter(F.col("cid").isNotNull())
        .groupBy("cid")
        .agg(
            F.countDistinct("order_no").alias("frequency"),
            F.max("day").alias("latest"),
            F.sum("paid").alias("paid"),
        )
        for c in channels
    ]
    return (
        reduce(DataFrame.unionByName, per_channel)
        .groupBy("cid")
        .agg(
            F.when(F.lit(today) - F.max("latest") < recent_days, 1.0).otherwise(0.0).alias("recency"),
            F.sum("frequency").cast("double").alias("frequency"),
            F.sum("paid").cast("double").alias("totalspend"),
        )
    )


def return_behaviour(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Both inputs are (cid, order_no, item, money). Returns per ordering customer the
    share of orders, lines and money given back, and the number of returns."""

    def totals(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.groupBy("cid").agg(
            F.countDistinct("order_no").alias(f"{prefix}_orders"),
            F.count("item").alias(f"{prefix}_items"),
            F.sum("money").alias(f"{prefix}_money"),
        )

    def share(what: str):
        quotient = ratio(F.col(f"back_{what}").cast("double"), F.col(f"all_{what}").cast("double"))
        return F.round(F.coalesce(quotient, F.lit(0.0)), 7)

    # A null customer never equals another, so it keeps its row and gets zeros.
    return totals(orders, "all").join(totals(returns, "back"), "cid", "left").select(
        F.col("cid").alias("user_sk"),
        share("orders").alias("orderRatio"),
        share("items").alias("itemsRatio"),
        share("money").alias("monetaryRatio"),
        F.coalesce(F.col("back_orders"), F.lit(0)).cast("double").alias("frequency"),
    )


def class_counts(rows: DataFrame, *, key: str, class_id: str, classes: range, min_count: int) -> DataFrame:
    """Per key, the number of rows in each class as ``id1``, ``id2``, …, for keys with
    more than ``min_count`` rows."""
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("cid"))
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[count_if(F.col(class_id) == c).cast("double").alias(f"id{c}") for c in classes],
        )
        .filter(F.col("_rows") > min_count)
        .drop("_rows")
    )


def split_by_id(rows: DataFrame, key: str, *, parts: int = 10, test_part: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the remainder of an id: the same rows on every run. The rows are read
    once; one job writes both parts, each to a folder of its own, which it is read from."""
    name = "_part" + "_" * max(map(len, rows.columns))
    part = F.pmod(F.col(key), F.lit(parts)) == test_part
    written = durable(rows.withColumn(name, part), by=name)
    return written.filter(~F.col(name)).drop(name), written.filter(F.col(name)).drop(name)
