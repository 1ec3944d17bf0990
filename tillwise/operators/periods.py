"""Comparing periods: year against year, before against after, around a price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.functions.expressions import day_offset, ratio, sum_if


def two_year_totals(
    sales: DataFrame, dates: DataFrame, *, sold: str, key: str, amount: Column, year: int
) -> DataFrame:
    """(key, first, second): the amount in ``year`` and in the year after, for keys
    with a positive first amount."""
    days = dates.filter(F.col("d_year").isin(year, year + 1)).select("d_date_sk", "d_year")
    return (
        sales.join(days, F.col(sold) == F.col("d_date_sk"))
        .groupBy(F.col(key).alias("key"))
        .agg(
            sum_if(F.col("d_year") == year, amount).alias("first"),
            sum_if(F.col("d_year") == year + 1, amount).alias("second"),
        )
        .filter(F.col("first") > 0)
    )


def growth_of_two_channels(store: DataFrame, web: DataFrame) -> DataFrame:
    """(key, store_ratio, web_ratio) where the web grew by the greater factor. Both
    inputs come from ``two_year_totals``, one row per key."""
    store = store.select("key", ratio(F.col("second"), F.col("first")).alias("store_ratio"))
    web = web.select("key", ratio(F.col("second"), F.col("first")).alias("web_ratio"))
    return store.join(web, "key").filter(F.col("web_ratio") > F.col("store_ratio"))


def days_around(dates: DataFrame, anchor: str, days: int) -> DataFrame:
    """(d_date_sk, before) for the days at most ``days`` from ``anchor``; the anchor
    itself is not before."""
    offset = day_offset(F.col("d_date"), anchor)
    return dates.select("d_date_sk", offset.alias("_offset")).filter(
        F.col("_offset").between(-days, days)
    ).select("d_date_sk", (F.col("_offset") < 0).alias("before"))


def before_and_after(rows: DataFrame, *, group: list[str], value: Column) -> DataFrame:
    """``sum_before`` and ``sum_after`` of value per group, by the column ``before`` of
    ``days_around``."""
    return rows.groupBy(*group).agg(
        sum_if(F.col("before"), value).alias("sum_before"),
        sum_if(~F.col("before"), value).alias("sum_after"),
    )


def quantity_around_price_change(
    sales: DataFrame, changes: DataFrame, *, item: str, day: str, quantity: str
) -> DataFrame:
    """(imp_sk, price_change, current, previous): quantity sold in the n days from a
    competitor's price change and in the n days before it.

    Sales are summed per item and day first, so an item with very many sales counts as a few
    days and not as its rows. Days and price changes then meet in one running sum per item,
    never pair by pair: what is sold in an interval is the running sum at its end less that
    at its start. Changes of items that were never sold are left out; those without a start or
    of no days get 0.
    """
    daily = (
        sales.filter(F.col(item).isNotNull())
        .groupBy(F.col(item).alias("i_item_sk"), F.col(day).cast("long").alias("_day"))
        .agg(F.coalesce(F.sum(quantity), F.lit(0)).alias("_quantity"))
        .withColumn("_sale", F.lit(1))
    )
    start = F.col("imp_start_date").cast("long")
    days = F.greatest(F.coalesce(F.col("no_days"), F.lit(0)), F.lit(0)).cast("long")

    def point(at, current: int, previous: int):
        return F.struct(at.alias("_day"), F.lit(current).alias("_current"), F.lit(previous).alias("_previous"))

    points = changes.select(
        "i_item_sk", "imp_sk", "price_change", F.lit(0).alias("_sale"),
        F.inline(F.array(point(start - days, 0, -1), point(start, -1, 1), point(start + days, 1, 0))),
    )
    # A point stands before the sales of its day.
    so_far = Window.partitionBy("i_item_sk").orderBy("_day", "_sale").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        points.unionByName(daily, allowMissingColumns=True)
        .withColumn("_sum", F.coalesce(F.sum("_quantity").over(so_far), F.lit(0)))
        .withColumn("_sold", F.max("_sale").over(Window.partitionBy("i_item_sk")))
        .filter("_sale = 0 AND _sold = 1")
        .groupBy("i_item_sk", "imp_sk", "price_change")
        .agg(
            F.sum(F.col("_sum") * F.col("_current")).alias("current"),
            F.sum(F.col("_sum") * F.col("_previous")).alias("previous"),
        )
    )
