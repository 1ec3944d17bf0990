"""What visitors look at before, and instead of, buying."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.expressions import virtual_seconds
from tillwise.operators.baskets import pair_counts_of_sets
from tillwise.plans.baskets import top_category_pairs
from tillwise.streaming.clicks import (
    abandoned_carts,
    last_views_before_purchase,
    sales_after_page,
    seen_in_session_with,
    session_totals,
)

USER, TS = "wcs_user_sk", "tstamp"
SESSION = [USER, "session_no"]


def _clicks(t) -> DataFrame:
    return t["web_clickstreams"].withColumn(
        TS, virtual_seconds(F.col("wcs_click_date_sk"), F.col("wcs_click_time_sk"))
    )


def q02(t, *, item_sk=10001, timeout=3600, limit=30) -> DataFrame:
    """Items most often viewed in one session with a given item."""
    return (
        seen_in_session_with(
            _clicks(t), user=USER, ts=TS, item="wcs_item_sk", target=item_sk, timeout=timeout
        )
        .select(
            F.col("wcs_item_sk").alias("item_sk_1"),
            F.lit(item_sk).cast("long").alias("item_sk_2"),
            "cnt",
        )
        .orderBy(F.desc("cnt"), "item_sk_1")
        .limit(limit)
    )


def q03(
    t, *, purchased_item=10001, views=5, within_seconds=864000, category_ids=(2, 3), limit=100
) -> DataFrame:
    """Items of some categories among the last views before buying a given item."""
    seen = last_views_before_purchase(
        _clicks(t),
        user=USER,
        ts=TS,
        item="wcs_item_sk",
        sale="wcs_sales_sk",
        purchased=purchased_item,
        within_seconds=within_seconds,
        views=views,
    )
    wanted = t["item"].filter(F.col("i_category_id").isin(*category_ids)).select("i_item_sk")
    return (
        seen.groupBy("purchased_item", "lastviewed_item")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .join(wanted, F.col("lastviewed_item") == F.col("i_item_sk"))
        .select("purchased_item", "lastviewed_item", "cnt")
        .orderBy(F.desc("cnt"), "purchased_item", "lastviewed_item")
        .limit(limit)
    )


def q04(t, *, timeout=3600) -> DataFrame:
    """Mean number of pages in sessions that leave a filled cart behind."""
    clicks = (
        _clicks(t)
        .filter(F.col("wcs_sales_sk").isNull())
        .join(t["web_page"], F.col("wcs_web_page_sk") == F.col("wp_web_page_sk"))
        .select(USER, TS, "wp_type")
    )
    carts = abandoned_carts(clicks, user=USER, ts=TS, page_type="wp_type", timeout=timeout)
    return carts.agg(
        F.avg("pagecount").cast("decimal(20,1)").alias("averageNumberOfPages")
    )


def q08(
    t, *, start="2001-09-02", end="2002-09-02", within_seconds=259200, review_type="review"
) -> DataFrame:
    """Web sales with a review page seen shortly before, and all other web sales."""
    days = t["date_dim"].filter(F.col("d_date").between(start, end)).select("d_date_sk")
    clicks = (
        _clicks(t)
        .join(days, F.col("wcs_click_date_sk") == F.col("d_date_sk"), "left_semi")
        .join(t["web_page"], F.col("wcs_web_page_sk") == F.col("wp_web_page_sk"))
    )
    reviewed = sales_after_page(
        clicks,
        user=USER,
        ts=TS,
        sale="wcs_sales_sk",
        page_type="wp_type",
        wanted=review_type,
        within_seconds=within_seconds,
    ).withColumn("_reviewed", F.lit(True))
    orders = (
        t["web_sales"]
        .join(days, F.col("ws_sold_date_sk") == F.col("d_date_sk"), "left_semi")
        .groupBy("ws_order_number")
        .agg(F.sum("ws_net_paid").alias("paid"))
    )
    with_review = F.sum(F.when(F.col("_reviewed"), F.col("paid")))
    return orders.join(
        reviewed, F.col("ws_order_number") == F.col("wcs_sales_sk"), "left"
    ).agg(
        with_review.cast("long").alias("q08_review_sales_amount"),
        (F.sum("paid") - with_review).cast("long").alias("no_q08_review_sales_amount"),
    )


def q12(
    t, *, categories=("Books", "Electronics"), first_day=37134, view_days=30, sale_days=90
) -> DataFrame:
    """Users who viewed a category online and bought from it in a store later on.

    Some view lies before some purchase exactly if the first view lies before the last
    purchase, so each side shrinks to one day per user before the join.
    """
    items = t["item"].filter(F.col("i_category").isin(*categories)).select("i_item_sk")
    viewed = (
        t["web_clickstreams"]
        .filter(
            F.col("wcs_click_date_sk").between(first_day, first_day + view_days)
            & F.col("wcs_user_sk").isNotNull()
            & F.col("wcs_sales_sk").isNull()
        )
        .join(items, F.col("wcs_item_sk") == F.col("i_item_sk"), "left_semi")
        .groupBy(F.col("wcs_user_sk").alias("u_id"))
        .agg(F.min("wcs_click_date_sk").alias("first_view"))
    )
    bought = (
        t["store_sales"]
        .filter(
            F.col("ss_sold_date_sk").between(first_day, first_day + sale_days)
            & F.col("ss_customer_sk").isNotNull()
        )
        .join(items, F.col("ss_item_sk") == F.col("i_item_sk"), "left_semi")
        .groupBy(F.col("ss_customer_sk").alias("u_id"))
        .agg(F.max("ss_sold_date_sk").alias("last_sale"))
    )
    return (
        viewed.join(bought, "u_id")
        .filter(F.col("first_view") < F.col("last_sale"))
        .select("u_id")
        .orderBy("u_id")
    )


def q30(t, *, timeout=3600, limit=100) -> DataFrame:
    """Pairs of categories viewed in one session."""
    clicks = (
        _clicks(t)
        .join(t["item"], F.col("wcs_item_sk") == F.col("i_item_sk"))
        .filter(F.col("i_category_id").isNotNull())
        .select(USER, TS, "i_category_id")
    )
    sessions = session_totals(
        clicks,
        user=USER,
        ts=TS,
        timeout=timeout,
        partial=[F.collect_set("i_category_id").alias("part")],
        merge=[F.sort_array(F.array_distinct(F.flatten(F.collect_list("part")))).alias("categories")],
    )
    return top_category_pairs(pair_counts_of_sets(sessions, "categories"), limit)
