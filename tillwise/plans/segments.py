"""Who the customers are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.features import (
    class_counts,
    clicks_per_category,
    recency_frequency_money,
    return_behaviour,
)
from tillwise.operators.models import Clusters, cluster, interest_classifier, interest_weights

# Education levels that count as college.
COLLEGE = ("Advanced Degree", "College", "4 yr Degree", "2 yr Degree")


def q05_features(t, *, category="Movies & TV", education=COLLEGE, gender="M") -> DataFrame:
    """Clicks of each visitor by category, with two facts about the visitor."""
    clicks = clicks_per_category(
        t["web_clickstreams"], t["item"], category=category, category_ids=range(1, 8)
    )
    people = t["customer"].join(
        t["customer_demographics"], F.col("c_current_cdemo_sk") == F.col("cd_demo_sk")
    )

    def flag(condition):
        return F.when(condition, 1).otherwise(0).cast("long")

    return clicks.join(people, F.col("wcs_user_sk") == F.col("c_customer_sk")).select(
        "clicks_in_category",
        flag(F.col("cd_education_status").isin(*education)).alias("college_education"),
        flag(F.col("cd_gender") == gender).alias("male"),
        *[f"clicks_in_{c}" for c in range(1, 8)],
    )


def q05(t, *, threshold: float | None = None, iterations=20, tolerance=1e-9, **features) -> DataFrame:
    """Quality of a classifier for interest in a category."""
    return interest_classifier(
        q05_features(t, **features), count="clicks_in_category", threshold=threshold,
        iterations=iterations, tolerance=tolerance,
    )


def q05_weights(t, *, threshold: float | None = None, iterations=20, tolerance=1e-9, **features) -> DataFrame:
    """Weights of the classifier of ``q05``: feature (null: the intercept), weight."""
    return interest_weights(
        q05_features(t, **features), count="clicks_in_category", threshold=threshold,
        iterations=iterations, tolerance=tolerance,
    )


def q20_features(t) -> DataFrame:
    """How each customer returns goods."""
    orders = t["store_sales"].select(
        F.col("ss_customer_sk").alias("cid"),
        F.col("ss_ticket_number").alias("order_no"),
        F.col("ss_item_sk").alias("item"),
        F.col("ss_net_paid").alias("money"),
    )
    returns = t["store_returns"].select(
        F.col("sr_customer_sk").alias("cid"),
        F.col("sr_ticket_number").alias("order_no"),
        F.col("sr_item_sk").alias("item"),
        F.col("sr_return_amt").alias("money"),
    )
    return return_behaviour(orders, returns)


def q20(t, *, k=8, iterations=20, seed=1) -> Clusters:
    """Customers clustered by how they return goods."""
    return cluster(q20_features(t), key="user_sk", k=k, iterations=iterations, seed=seed)


def q25_features(t, *, date="2002-01-02", today=37621, recent_days=60) -> DataFrame:
    """How recently, how often and for how much each customer buys in both channels."""
    days = t["date_dim"].filter(F.col("d_date") > date).select("d_date_sk")

    def channel(rows: DataFrame, day: str, cid: str, order_no: str, paid: str) -> DataFrame:
        return rows.join(days, F.col(day) == F.col("d_date_sk"), "left_semi").select(
            F.col(cid).alias("cid"),
            F.col(order_no).alias("order_no"),
            F.col(day).alias("day"),
            F.col(paid).alias("paid"),
        )

    return recency_frequency_money(
        [
            channel(t["store_sales"], "ss_sold_date_sk", "ss_customer_sk", "ss_ticket_number", "ss_net_paid"),
            channel(t["web_sales"], "ws_sold_date_sk", "ws_bill_customer_sk", "ws_order_number", "ws_net_paid"),
        ],
        today=today,
        recent_days=recent_days,
    )


def q25(t, *, k=8, iterations=20, seed=1, **features) -> Clusters:
    """Customers clustered by recency, frequency and money."""
    return cluster(q25_features(t, **features), key="cid", k=k, iterations=iterations, seed=seed)


def q26_features(t, *, categories=("Books",), min_count=5) -> DataFrame:
    """What classes of some categories each customer buys in stores."""
    items = t["item"].filter(F.col("i_category").isin(*categories))
    sold = t["store_sales"].join(items, F.col("ss_item_sk") == F.col("i_item_sk"))
    return class_counts(
        sold, key="ss_customer_sk", class_id="i_class_id", classes=range(1, 16), min_count=min_count
    )


def q26(t, *, k=8, iterations=20, seed=1, **features) -> Clusters:
    """Customers clustered by the classes they buy."""
    return cluster(q26_features(t, **features), key="cid", k=k, iterations=iterations, seed=seed)
