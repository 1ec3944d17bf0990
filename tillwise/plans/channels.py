"""Store and web sales compared over time, place, price and promotion."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.expressions import count_if, ratio
from tillwise.operators.periods import (
    before_and_after,
    days_around,
    growth_of_two_channels,
    two_year_totals,
)


def _amount(prefix: str):
    """Twice the margin-adjusted amount; the half cancels in a ratio."""
    price, cost, discount, sales = (
        F.col(f"{prefix}_ext_{c}") for c in ("list_price", "wholesale_cost", "discount_amt", "sales_price")
    )
    return price - cost - discount + sales


def _growth(t, year: int, store_amount, web_amount) -> DataFrame:
    store = two_year_totals(
        t["store_sales"], t["date_dim"], sold="ss_sold_date_sk", key="ss_customer_sk",
        amount=store_amount, year=year,
    )
    web = two_year_totals(
        t["web_sales"], t["date_dim"], sold="ws_sold_date_sk", key="ws_bill_customer_sk",
        amount=web_amount, year=year,
    )
    return growth_of_two_channels(store, web).join(
        t["customer"], F.col("key") == F.col("c_customer_sk")
    )


def q06(t, *, year=2001, limit=100) -> DataFrame:
    """Customers whose margin-adjusted web spending grew faster than that in stores."""
    who = ["c_customer_sk", "c_first_name", "c_last_name", "c_preferred_cust_flag",
           "c_birth_country", "c_login"]
    return (
        _growth(t, year, _amount("ss"), _amount("ws"))
        .select("web_ratio", *who, "c_email_address")
        .orderBy(F.desc("web_ratio"), *who)
        .limit(limit)
        .select(
            F.col("web_ratio").cast("decimal(15,1)").alias("web_sales_increase_ratio"),
            *who,
            "c_email_address",
        )
    )


def q13(t, *, year=2001, limit=100) -> DataFrame:
    """Customers whose net web payments grew faster than those in stores."""
    return (
        _growth(t, year, F.col("ss_net_paid"), F.col("ws_net_paid"))
        .select("c_customer_sk", "c_first_name", "c_last_name", "store_ratio", "web_ratio")
        .orderBy(F.desc("web_ratio"), "c_customer_sk", "c_first_name", "c_last_name")
        .limit(limit)
        .select(
            F.col("c_customer_sk").alias("customer_id"),
            F.col("c_first_name").alias("customer_first_name"),
            F.col("c_last_name").alias("customer_last_name"),
            F.col("store_ratio").cast("decimal(15,2)").alias("storeSalesIncreaseRatio"),
            F.col("web_ratio").cast("decimal(15,2)").alias("webSalesIncreaseRatio"),
        )
    )


def dear_items(item: DataFrame, price_ratio) -> DataFrame:
    """Items dearer than ``price_ratio`` times the mean price of their category."""
    mean = item.groupBy("i_category").agg((F.avg("i_current_price") * Decimal(str(price_ratio))).alias("bar"))
    return (
        item.join(mean, "i_category").filter(F.col("i_current_price") > F.col("bar")).select("i_item_sk")
    )


def q07(t, *, price_ratio=1.2, year=2004, month=7, min_count=10, limit=10) -> DataFrame:
    """States with at least ``min_count`` sales of dear items in a month."""
    days = t["date_dim"].filter((F.col("d_year") == year) & (F.col("d_moy") == month)).select("d_date_sk")
    per_customer = (
        t["store_sales"]
        .join(days, F.col("ss_sold_date_sk") == F.col("d_date_sk"), "left_semi")
        .join(dear_items(t["item"], price_ratio), F.col("ss_item_sk") == F.col("i_item_sk"), "left_semi")
        .groupBy("ss_customer_sk")
        .agg(F.count(F.lit(1)).alias("sales"))
    )
    return (
        per_customer.join(t["customer"], F.col("ss_customer_sk") == F.col("c_customer_sk"))
        .join(
            t["customer_address"].filter(F.col("ca_state").isNotNull()),
            F.col("c_current_addr_sk") == F.col("ca_address_sk"),
        )
        .groupBy("ca_state")
        .agg(F.sum("sales").alias("cnt"))
        .filter(F.col("cnt") >= min_count)
        .orderBy(F.desc("cnt"), "ca_state")
        .limit(limit)
    )


@dataclass(frozen=True)
class BuyerBand:
    marital_status: str
    education_status: str
    price_min: float
    price_max: float


@dataclass(frozen=True)
class PlaceBand:
    country: str
    states: tuple[str, ...]
    profit_min: float
    profit_max: float


# The default bands.
BUYER_BANDS = (
    BuyerBand("M", "4 yr Degree", 100, 150),
    BuyerBand("M", "4 yr Degree", 50, 200),
    BuyerBand("M", "4 yr Degree", 150, 200),
)
PLACE_BANDS = (
    PlaceBand("United States", ("KY", "GA", "NM"), 0, 2000),
    PlaceBand("United States", ("MT", "OR", "IN"), 150, 3000),
    PlaceBand("United States", ("WI", "MO", "WV"), 50, 25000),
)


def _any_of(conditions):
    result = F.lit(False)
    for c in conditions:
        result = result | c
    return result


def q09(t, *, year=2001, buyers=BUYER_BANDS, places=PLACE_BANDS) -> DataFrame:
    """Quantity sold in a year within buyer and price bands and place and profit bands."""
    price, profit = F.col("ss_sales_price"), F.col("ss_net_profit")
    buyer = _any_of(
        (F.col("cd_marital_status") == b.marital_status)
        & (F.col("cd_education_status") == b.education_status)
        & price.between(b.price_min, b.price_max)
        for b in buyers
    )
    place = _any_of(
        (F.col("ca_country") == p.country)
        & F.col("ca_state").isin(*p.states)
        & profit.between(p.profit_min, p.profit_max)
        for p in places
    )
    days = t["date_dim"].filter(F.col("d_year") == year).select("d_date_sk")
    stores = t["store"].select("s_store_sk")
    return (
        t["store_sales"]
        .join(days, F.col("ss_sold_date_sk") == F.col("d_date_sk"))
        .join(stores, F.col("ss_store_sk") == F.col("s_store_sk"))
        .join(t["customer_demographics"], F.col("ss_cdemo_sk") == F.col("cd_demo_sk"))
        .join(t["customer_address"], F.col("ss_addr_sk") == F.col("ca_address_sk"))
        .filter(buyer & place)
        .agg(F.sum("ss_quantity").cast("decimal(15,0)").alias("totalSales"))
    )


def q14(
    t, *, dependents=5, morning=(7, 8), evening=(19, 20), content_length=(5000, 6000)
) -> DataFrame:
    """Web sales in the morning per web sale in the evening; -1 without the latter."""
    hours = t["time_dim"].filter(F.col("t_hour").isin(*morning, *evening))
    homes = t["household_demographics"].filter(F.col("hd_dep_count") == dependents)
    pages = t["web_page"].filter(F.col("wp_char_count").between(*content_length))
    counts = (
        t["web_sales"]
        .join(pages, F.col("ws_web_page_sk") == F.col("wp_web_page_sk"))
        .join(hours, F.col("ws_sold_time_sk") == F.col("t_time_sk"))
        .join(homes, F.col("ws_ship_hdemo_sk") == F.col("hd_demo_sk"))
        .agg(
            count_if(F.col("t_hour").between(*morning)).alias("am"),
            count_if(F.col("t_hour").between(*evening)).alias("pm"),
        )
    )
    return counts.select(
        F.coalesce(ratio(F.col("am"), F.col("pm")), F.lit(-1.0)).cast("decimal(15,4)").alias("am_pm_ratio")
    )


def q16(t, *, date="2001-03-16", days=30, limit=100) -> DataFrame:
    """Web sales less refunds before and after a date, per warehouse state and item."""
    around = days_around(t["date_dim"], date, days)
    # A line joins once per refund of its order and item. One row per order and item,
    # holding the number of refunds and their sum, gives the same total.
    # Only refunds of lines sold around the date are grouped.
    sold = t["web_sales"].join(around, F.col("ws_sold_date_sk") == F.col("d_date_sk"))
    lines = sold.select(F.col("ws_order_number").alias("wr_order_number"), F.col("ws_item_sk").alias("wr_item_sk"))
    refunds = t["web_returns"].join(lines, ["wr_order_number", "wr_item_sk"], "left_semi").groupBy("wr_order_number", "wr_item_sk").agg(
        F.count(F.lit(1)).alias("refunds"),
        F.sum(F.coalesce("wr_refunded_cash", F.lit(0))).alias("refunded"),
    )
    sales = (
        sold.join(
            refunds,
            (F.col("ws_order_number") == F.col("wr_order_number"))
            & (F.col("ws_item_sk") == F.col("wr_item_sk")),
            "left",
        )
        .join(t["item"], F.col("ws_item_sk") == F.col("i_item_sk"))
        .join(t["warehouse"], F.col("ws_warehouse_sk") == F.col("w_warehouse_sk"))
    )
    value = F.col("ws_sales_price") * F.coalesce("refunds", F.lit(1)) - F.coalesce("refunded", F.lit(0))
    return (
        before_and_after(sales, group=["w_state", "i_item_id"], value=value)
        .orderBy("w_state", "i_item_id")
        .limit(limit)
        .select(
            "w_state",
            "i_item_id",
            F.col("sum_before").cast("decimal(15,2)").alias("sales_before"),
            F.col("sum_after").cast("decimal(15,2)").alias("sales_after"),
        )
    )


def q17(
    t, *, gmt_offset=-5, year=2001, month=12, categories=("Books", "Music"), limit=100
) -> DataFrame:
    """Share of store sales that ran under a promotion channel."""
    days = t["date_dim"].filter((F.col("d_year") == year) & (F.col("d_moy") == month))
    items = t["item"].filter(F.col("i_category").isin(*categories))
    stores = t["store"].filter(F.col("s_gmt_offset") == gmt_offset)
    addresses = t["customer_address"].filter(F.col("ca_gmt_offset") == gmt_offset)
    customers = t["customer"].join(
        addresses, F.col("c_current_addr_sk") == F.col("ca_address_sk"), "left_semi"
    )
    per_promotion = (
        t["store_sales"]
        .join(days, F.col("ss_sold_date_sk") == F.col("d_date_sk"), "left_semi")
        .join(stores, F.col("ss_store_sk") == F.col("s_store_sk"), "left_semi")
        .join(items, F.col("ss_item_sk") == F.col("i_item_sk"), "left_semi")
        .join(customers, F.col("ss_customer_sk") == F.col("c_customer_sk"), "left_semi")
        .groupBy("ss_promo_sk")
        .agg(F.sum("ss_ext_sales_price").alias("amount"))
    )
    promoted = (
        (F.col("p_channel_dmail") == "Y") | (F.col("p_channel_email") == "Y") | (F.col("p_channel_tv") == "Y")
    )
    promotional = F.sum(F.when(promoted, F.col("amount")).otherwise(0))
    total = F.sum("amount")
    return (
        per_promotion.join(t["promotion"], F.col("ss_promo_sk") == F.col("p_promo_sk"))
        .agg(
            promotional.cast("decimal(15,2)").alias("promotional"),
            total.cast("decimal(15,2)").alias("total"),
            F.when(total > 0, ratio(100 * promotional, total))
            .otherwise(0.0)
            .cast("decimal(15,2)")
            .alias("promo_percent"),
        )
        .orderBy("promotional", "total")
        .limit(limit)
    )


def rebought_quantities(t, sold: DataFrame, returned: DataFrame, rebought: DataFrame) -> DataFrame:
    """Quantities sold in stores, returned, and bought again on the web by the same
    customer, per item and store.

    A row-by-row join repeats every quantity once per matching row of the other two
    sides. Here each side is one row per key with its number of rows, and the
    repetition is a multiplication. Returns are by far the smallest side, so sales are
    reduced to their keys before they are grouped.
    """
    line, buyer = ["ticket", "item_sk", "customer_sk"], ["item_sk", "customer_sk"]
    returned = (
        returned.groupBy(
            F.col("sr_ticket_number").alias("ticket"),
            F.col("sr_item_sk").alias("item_sk"),
            F.col("sr_customer_sk").alias("customer_sk"),
        )
        .agg(F.count(F.lit(1)).alias("n_r"), F.sum("sr_return_quantity").alias("q_r"))
        .dropna(subset=line)
    )
    sold = (
        sold.select(
            F.col("ss_ticket_number").alias("ticket"),
            F.col("ss_item_sk").alias("item_sk"),
            F.col("ss_customer_sk").alias("customer_sk"),
            F.col("ss_store_sk").alias("store_sk"),
            "ss_quantity",
        )
        .join(returned.select(*line), line, "left_semi")
        .groupBy(*line, "store_sk")
        .agg(F.count(F.lit(1)).alias("n_s"), F.sum("ss_quantity").alias("q_s"))
    )
    rebought = (
        rebought.select(
            F.col("ws_item_sk").alias("item_sk"), F.col("ws_bill_customer_sk").alias("customer_sk"), "ws_quantity"
        )
        .join(returned.select(*buyer), buyer, "left_semi")
        .groupBy(*buyer)
        .agg(F.count(F.lit(1)).alias("n_w"), F.sum("ws_quantity").alias("q_w"))
    )
    return (
        sold.join(returned, line)
        .join(rebought, buyer)
        .join(t["store"], F.col("store_sk") == F.col("s_store_sk"))
        .join(t["item"], F.col("item_sk") == F.col("i_item_sk"))
        .groupBy(
            F.col("i_item_id").alias("item_id"),
            F.col("i_item_desc").alias("item_desc"),
            F.col("s_store_id").alias("store_id"),
            F.col("s_store_name").alias("store_name"),
        )
        .agg(
            F.sum(F.col("q_s") * F.col("n_r") * F.col("n_w")).alias("store_sales_quantity"),
            F.sum(F.col("q_r") * F.col("n_s") * F.col("n_w")).alias("store_returns_quantity"),
            F.sum(F.col("q_w") * F.col("n_s") * F.col("n_r")).alias("web_sales_quantity"),
        )
    )


def q21(t, *, year=2003, month=1, months_to_return=6, years_to_rebuy=2, limit=100) -> DataFrame:
    """Items sold in a month, returned soon after and bought again on the web."""
    dates = t["date_dim"]
    in_year, moy = F.col("d_year") == year, F.col("d_moy")

    def on_days(rows: DataFrame, day: str, condition) -> DataFrame:
        return rows.join(dates.filter(condition), F.col(day) == F.col("d_date_sk"), "left_semi")

    return (
        rebought_quantities(
            t,
            on_days(t["store_sales"], "ss_sold_date_sk", in_year & (moy == month)),
            on_days(
                t["store_returns"], "sr_returned_date_sk",
                in_year & moy.between(month, month + months_to_return),
            ),
            on_days(
                t["web_sales"], "ws_sold_date_sk",
                F.col("d_year").between(year, year + years_to_rebuy),
            ),
        )
        .orderBy("item_id", "item_desc", "store_id", "store_name")
        .limit(limit)
    )


# 2.0 / 3.0 as a decimal division gives it, six places: a fall from 3 to 2 is above it.
LEAST_STOCK_RATIO = Decimal("0.666667")


def q22(t, *, date="2001-05-08", days=30, price_min=0.98, price_max=1.5, limit=100) -> DataFrame:
    """Stock per warehouse and item that changed by no more than half around a date."""
    price = F.col("i_current_price").cast("float")
    items = t["item"].filter(
        price.between(F.lit(price_min).cast("float"), F.lit(price_max).cast("float"))
    )
    stock = before_and_after(
        t["inventory"]
        .join(days_around(t["date_dim"], date, days), F.col("inv_date_sk") == F.col("d_date_sk"))
        .join(items.select("i_item_sk"), F.col("inv_item_sk") == F.col("i_item_sk"), "left_semi"),
        group=["inv_warehouse_sk", "inv_item_sk"],
        value=F.col("inv_quantity_on_hand"),
    )
    change = ratio(F.col("inv_after"), F.col("inv_before")).cast("float")
    return (
        stock.join(items, F.col("inv_item_sk") == F.col("i_item_sk"))
        .join(t["warehouse"], F.col("inv_warehouse_sk") == F.col("w_warehouse_sk"))
        .groupBy("w_warehouse_name", "i_item_id")
        .agg(F.sum("sum_before").alias("inv_before"), F.sum("sum_after").alias("inv_after"))
        .filter(
            (F.col("inv_before") > 0)
            & (change >= F.lit(LEAST_STOCK_RATIO).cast("float"))
            & (change <= F.lit(3.0 / 2.0).cast("float"))
        )
        .orderBy("w_warehouse_name", "i_item_id")
        .limit(limit)
    )
