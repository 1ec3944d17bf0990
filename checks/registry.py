"""Every query and operator, bound to the test tables with arguments that select rows
there. All of them run over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, IntegerType, ShortType

from tillwise import plans
from tillwise.functions.expressions import make_pairs, virtual_seconds
from tillwise.operators import baskets, features, models, periods, statistics, text
from tillwise.plans.channels import BuyerBand, PlaceBand, dear_items, rebought_quantities
from tillwise.plans.trends import declining_stores
from tillwise.session import checkpoint_dir, configure
from tillwise.sources.layout import write_by_day
from tillwise.sources.sinks import write_delimited
from tillwise.sources.testbed import TestbedTables
from tillwise.streaming import clicks

SESSION_GAP = 21600
ITEM = 69
ALL_DAYS = ("1995-01-01", "2001-12-31")
LEXICON = [("er", "NEG"), ("that", "NEG"), ("den", "NEG"), ("la", "POS"), ("with", "POS")]
KNOWN_NAMES = ["The", "That", "Orre Orre", "Ernt", "Eaux", "of the", "the And", "and the of", "in", "of"]
# Two days a month, and two days of one week, which then counts twice.
RETURN_DATES = [f"{y}-{m:02}-{d}" for y in range(1995, 2002) for m in range(1, 13) for d in (10, 24)] + [
    "1997-03-12"
]
BUYERS = (
    BuyerBand("M", "BUILDING", 900, 1500),
    BuyerBand("S", "MACHINERY", 1000, 2200),
    BuyerBand("D", "FURNITURE", 500, 3000),
)
PLACES = (
    PlaceBand("AFRICA", ("NATION_0", "NATION_5", "NATION_10"), 0, 20000),
    PlaceBand("MIDDLE EAST", ("NATION_4", "NATION_9"), 1500, 80000),
    PlaceBand("ASIA", ("NATION_2", "NATION_7", "NATION_12"), 50, 25000),
)

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals and floats as double, short integers as bigint: one common form for
    comparing results."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DecimalType, FloatType)):
            column = column.cast("double")
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            column = column.cast("long")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def _lexicon(t) -> DataFrame:
    return t.spark.createDataFrame(LEXICON, "word string, polarity string")


def _known(t) -> DataFrame:
    return t.spark.createDataFrame([(n,) for n in KNOWN_NAMES], "company_name string")


def _timed_clicks(t) -> DataFrame:
    return t["web_clickstreams"].withColumn(
        "ts", virtual_seconds(F.col("wcs_click_date_sk"), F.col("wcs_click_time_sk"))
    )


def _typed_clicks(t) -> DataFrame:
    return _timed_clicks(t).join(t["web_page"], F.col("wcs_web_page_sk") == F.col("wp_web_page_sk"))


def _sessions(t) -> DataFrame:
    return clicks.sessionize(
        _typed_clicks(t), user="wcs_user_sk", ts="ts", timeout=SESSION_GAP
    )


def _splits(t) -> DataFrame:
    train, test = plans.q28_split(t)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _growth(t) -> DataFrame:
    store = periods.two_year_totals(
        t["store_sales"], t["date_dim"], sold="ss_sold_date_sk", key="ss_customer_sk",
        amount=F.col("ss_net_paid"), year=1996,
    )
    web = periods.two_year_totals(
        t["web_sales"], t["date_dim"], sold="ws_sold_date_sk", key="ws_bill_customer_sk",
        amount=F.col("ws_net_paid"), year=1996,
    )
    return periods.growth_of_two_channels(store, web).select(
        "key", F.round("store_ratio", 6).alias("store_ratio"), F.round("web_ratio", 6).alias("web_ratio")
    )


def _fit(t) -> DataFrame:
    daily = t["store_sales"].groupBy("ss_store_sk", "ss_sold_date_sk").agg(F.sum("ss_net_paid").alias("paid"))
    return statistics.linear_fit(daily, group=["ss_store_sk"], x="ss_sold_date_sk", y="paid").select(
        "ss_store_sk", F.round("slope", 5).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


def _variation(t) -> DataFrame:
    return statistics.variation(
        t["inventory"], group=["inv_warehouse_sk", "inv_item_sk"], value="inv_quantity_on_hand"
    ).withColumn("cov", F.round("cov", 6))


def _correlation(t) -> DataFrame:
    return statistics.correlation(t["store_sales"], x="ss_quantity", y="ss_net_paid").select(
        F.round("correlation", 6).alias("correlation")
    )


def _around(t) -> DataFrame:
    days = periods.days_around(t["date_dim"], "1997-06-01", 30)
    rows = t["inventory"].join(days, F.col("inv_date_sk") == F.col("d_date_sk"))
    return periods.before_and_after(
        rows, group=["inv_warehouse_sk"], value=F.col("inv_quantity_on_hand")
    )


def _price_change(t) -> DataFrame:
    changes = t["item_marketprices"].select(
        F.col("imp_item_sk").alias("i_item_sk"),
        "imp_sk",
        F.col("imp_competitor_price").alias("price_change"),
        "imp_start_date",
        (F.col("imp_end_date") - F.col("imp_start_date")).alias("no_days"),
    )
    return periods.quantity_around_price_change(
        t["web_sales"], changes, item="ws_item_sk", day="ws_sold_date_sk", quantity="ws_quantity"
    ).select("imp_sk", "current", "previous")


def _pairs(t) -> DataFrame:
    orders = t["web_sales"].groupBy("ws_order_number").agg(
        F.sort_array(F.collect_set("ws_warehouse_sk")).alias("warehouses")
    )
    return (
        orders.select("ws_order_number", F.explode(make_pairs(F.col("warehouses"))).alias("p"))
        .select("ws_order_number", F.col("p.left").alias("a"), F.col("p.right").alias("b"))
    )


def _frequent_pairs(t) -> DataFrame:
    """Small blocks and a low bar for huge baskets, so that all three ways are used."""
    return baskets.frequent_pairs(
        t["inventory"].filter(F.col("inv_date_sk").isNotNull()),
        basket="inv_date_sk", item="inv_item_sk", min_count=20, block=4, huge=15,
    )


def _mentions(t) -> DataFrame:
    return text.mentions(
        t["product_reviews"], t["store"], key="pr_review_sk", text="pr_review_content", name="s_store_name"
    )


def _sentiment(t, polarity=None) -> DataFrame:
    return text.extract_sentiment(
        t["product_reviews"], keep=["pr_review_sk"], text="pr_review_content",
        lexicon=_lexicon(t), polarity=polarity,
    )


def _cluster_centers(t) -> DataFrame:
    """A row for each number of a center."""
    result = plans.q20(t)
    return result.centers.withColumn("cost", F.lit(result.cost)).select(
        "cluster", "size", F.posexplode("center").alias("feature", "center"), "cost"
    )


def _seen_with(t) -> DataFrame:
    return baskets.seen_with(t["web_sales"], basket=["ws_bill_customer_sk"], item="ws_item_sk", target=ITEM)


def _classifier_facts(t) -> DataFrame:
    quality = plans.q05(
        t, category="PROMO", education=("BUILDING", "MACHINERY"), iterations=300, tolerance=1e-10
    )
    return models.classifier_facts(quality)


def _clicks_by_day(t):
    """The tables with clicks laid out by day."""
    return write_by_day(t, f"{checkpoint_dir(t.spark)}/days-{uuid.uuid4().hex}", ("web_clickstreams",))


def _delimited(t) -> DataFrame:
    """Lines as the text sink wrote them."""
    path = f"{checkpoint_dir(t.spark)}/lines-{uuid.uuid4().hex}"
    rows = t["web_sales"].select(
        "ws_order_number", "ws_item_sk", "ws_warehouse_sk", "ws_quantity", "ws_sales_price", "ws_net_paid"
    )
    write_delimited(rows, path)
    return t.spark.read.text(path).select(F.col("value").alias("line"))


def _describe(t) -> DataFrame:
    summary = t.raw("lineitem").select("l_quantity", "l_extendedprice").describe()
    return summary.select(
        "summary",
        F.round(F.col("l_quantity").cast("double"), 4).alias("l_quantity"),
        F.round(F.col("l_extendedprice").cast("double"), 2).alias("l_extendedprice"),
    )


def _with_gaps(t) -> DataFrame:
    """Customers where some fields are blanked, for the null-handling calls."""
    return t.raw("customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey").cast("long")).alias("c_nationkey"),
    )


def _per_market(t) -> DataFrame:
    """Notebook calls: rename, drop, ~, |, alias, join on an expression, sort by desc."""
    rich = (
        t.raw("customer")
        .withColumn("in_debt", F.col("c_acctbal") < 0)
        .withColumnRenamed("c_mktsegment", "market")
        .drop("c_name")
        .filter(~F.col("in_debt") | (F.col("c_nationkey") == 3))
        .alias("c")
    )
    nations = t.raw("nation").alias("n")
    return (
        rich.join(nations, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
        .groupBy("market", F.col("n.n_regionkey").alias("region"))
        .agg(F.count(F.lit(1)).alias("customers"), F.min("c_acctbal").alias("least"),
             F.max("c_acctbal").alias("most"))
        .orderBy(F.desc("customers"), "market", "region")
    )


BOUND: dict[str, Callable[[TestbedTables], DataFrame]] = {
    # the queries
    "q00_sales_by_category": lambda t: plans.q00(t),
    "q01_items_sold_together": lambda t: plans.q01(t, category_ids=range(1, 9), stores=range(100), min_count=1),
    "q02_items_viewed_together": lambda t: plans.q02(t, item_sk=ITEM, timeout=SESSION_GAP),
    "q03_views_before_purchase": lambda t: plans.q03(t, purchased_item=ITEM, category_ids=(1, 2, 3, 4)),
    "q04_abandoned_carts": lambda t: plans.q04(t, timeout=SESSION_GAP),
    "q05_interest_features": lambda t: plans.q05_features(t, category="PROMO", education=("BUILDING", "MACHINERY")),
    "q05_interest_classifier": lambda t: plans.q05(t, category="PROMO", education=("BUILDING", "MACHINERY")),
    "q05_classifier_weights": lambda t: plans.q05_weights(
        t, category="PROMO", education=("BUILDING", "MACHINERY")).withColumn("weight", F.round("weight", 8)),
    "q05_classifier_facts": _classifier_facts,
    "q06_web_growth_by_margin": lambda t: plans.q06(t, year=1996),
    "q07_states_buying_dear_items": lambda t: plans.q07(t, price_ratio=1.03, year=1998, month=7, min_count=3),
    "q08_sales_after_reviews": lambda t: plans.q08(t, start="1997-01-01", end="1997-12-31"),
    "q09_quantity_in_bands": lambda t: plans.q09(t, year=1996, buyers=BUYERS, places=PLACES),
    "q10_review_sentiment": lambda t: plans.q10(t, lexicon=_lexicon(t)),
    "q11_reviews_and_ratings": lambda t: plans.q11(t, start="1997-01-01", end="1997-06-30"),
    "q12_viewed_then_bought": lambda t: plans.q12(t, categories=("PROMO", "SMALL"), first_day=9862),
    "q12_viewed_then_bought_by_day": lambda t: plans.q12(
        _clicks_by_day(t), categories=("PROMO", "SMALL"), first_day=9862),
    "q13_web_growth_by_payment": lambda t: plans.q13(t, year=1996),
    "q14_morning_to_evening": lambda t: plans.q14(t),
    "q15_falling_categories": lambda t: plans.q15(t, start=ALL_DAYS[0], end=ALL_DAYS[1]),
    "q16_sales_around_date": lambda t: plans.q16(t, date="1997-06-01"),
    "q17_promoted_share": lambda t: plans.q17(t, year=1996, categories=("PROMO", "SMALL")),
    "q18_bad_words_on_falling_stores": lambda t: plans.q18(t, start="1997-01-01", end="1999-12-31", lexicon=_lexicon(t)),
    "q19_bad_words_on_returned_items": lambda t: plans.q19(
        t, store_dates=RETURN_DATES, web_dates=RETURN_DATES, tolerance=0.1, lexicon=_lexicon(t)),
    "q20_return_features": lambda t: plans.q20_features(t),
    "q20_return_clusters": lambda t: plans.q20(t).assignments,
    "q20_return_cluster_centers": _cluster_centers,
    "q20_cluster_facts": lambda t: models.cluster_facts(
        plans.q20_features(t), plans.q20(t, iterations=200), key="user_sk"),
    "q21_returned_and_rebought": lambda t: plans.q21(t, year=1996, month=2),
    "q22_stock_around_date": lambda t: plans.q22(t, date="1997-06-01", price_min=900, price_max=901),
    "q23_uneven_stock": lambda t: plans.q23(t, year=1997, coefficient=0.5),
    "q24_price_elasticity": lambda t: plans.q24(t, item_sk=558),
    "q25_recency_features": lambda t: plans.q25_features(t, date="1998-01-02", today=11535),
    "q25_recency_clusters": lambda t: plans.q25(t, date="1998-01-02", today=11535).assignments,
    "q25_cluster_facts": lambda t: models.cluster_facts(
        plans.q25_features(t, date="1998-01-02", today=11535),
        plans.q25(t, date="1998-01-02", today=11535, iterations=200), key="cid"),
    "q26_class_features": lambda t: plans.q26_features(t, categories=("PROMO",), min_count=2),
    "q26_class_clusters": lambda t: plans.q26(t, categories=("PROMO",), min_count=2).assignments,
    "q26_cluster_facts": lambda t: models.cluster_facts(
        plans.q26_features(t, categories=("PROMO",), min_count=2),
        plans.q26(t, categories=("PROMO",), min_count=2, iterations=200), key="cid"),
    "q27_company_names": lambda t: plans.q27(t, item_sk=ITEM),
    "q28_review_split": _splits,
    "q28_review_classes": lambda t: plans.q28(t).predictions,
    "q28_review_classifier_quality": lambda t: plans.q28(t).quality,
    "q29_categories_bought_together": lambda t: plans.q29(t),
    "q30_categories_viewed_together": lambda t: plans.q30(t, timeout=SESSION_GAP),
    # the operators
    "sessionize": lambda t: _sessions(t).select("wcs_user_sk", "ts", "wcs_item_sk", "session_no", "session_id"),
    "last_views_before_purchase": lambda t: clicks.last_views_before_purchase(
        _timed_clicks(t), user="wcs_user_sk", ts="ts", item="wcs_item_sk", sale="wcs_sales_sk",
        purchased=ITEM, within_seconds=432000, views=7),
    "abandoned_sessions": lambda t: clicks.abandoned_sessions(
        _sessions(t), session=["session_id"], ts="ts", page_type="wp_type"),
    "abandoned_carts": lambda t: clicks.abandoned_carts(
        _typed_clicks(t), user="wcs_user_sk", ts="ts", page_type="wp_type", timeout=SESSION_GAP),
    "sales_after_page": lambda t: clicks.sales_after_page(
        _typed_clicks(t), user="wcs_user_sk", ts="ts", sale="wcs_sales_sk", page_type="wp_type",
        wanted="review", within_seconds=SESSION_GAP),
    "seen_with": _seen_with,
    "make_pairs": _pairs,
    "frequent_pairs": _frequent_pairs,
    "extract_sentiment": _sentiment,
    "extract_negative_sentiment": lambda t: _sentiment(t, "NEG"),
    "find_company": lambda t: text.find_company(
        t["product_reviews"], keep=["pr_review_sk"], text="pr_review_content"),
    "find_known_company": lambda t: text.find_company(
        t["product_reviews"], keep=["pr_review_sk"], text="pr_review_content", known=_known(t)),
    "mentions": _mentions,
    "linear_fit": _fit,
    "declining_stores": lambda t: declining_stores(t, "1997-01-01", "1999-12-31"),
    "correlation": _correlation,
    "variation": _variation,
    "growth_of_two_channels": _growth,
    "before_and_after": _around,
    "quantity_around_price_change": _price_change,
    "rebought_quantities": lambda t: rebought_quantities(
        t, t["store_sales"], t["store_returns"], t["web_sales"]),
    "dear_items": lambda t: dear_items(t["item"], 1.03),
    "class_counts": lambda t: features.class_counts(
        t["web_sales"].join(t["item"], F.col("ws_item_sk") == F.col("i_item_sk")),
        key="ws_bill_customer_sk", class_id="i_category_id", classes=range(1, 9), min_count=5),
    # the notebook's calls
    "dropna_any": lambda t: _with_gaps(t).dropna(),
    "dropna_subset": lambda t: _with_gaps(t).dropna(subset=["c_nationkey"]),
    "fillna": lambda t: _with_gaps(t).fillna(0),
    "describe": _describe,
    "customers_per_market": _per_market,
    # the text sink
    "delimited_output": _delimited,
}


def queries() -> dict[str, Query]:
    def bind(run) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(run(TestbedTables(configure(spark), sf_dir)))

        return query

    return {name: bind(run) for name, run in BOUND.items()}


__all__ = ["BOUND", "queries"]
