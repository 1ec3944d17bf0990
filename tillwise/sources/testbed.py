"""The retail tables as views over the test tables.

The test data is an order book (orders, lineitem, part, customer, supplier), an event
log and a set of documents. Each retail table is a projection of them; nothing is
materialised, so filters and column pruning reach the parquet scans.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
# Events are from 2024, orders end in 2001: event days move back by this much, so
# that 2024-01-01 falls on 1997-01-01.
EVENT_DAYS_BACK = 9861
# Declared, so that no job has to look into the files first.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}
CALENDAR = (7305, 14610)  # 1990-01-01 and the number of days from there
CATEGORIES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "SMALL": 4, "STANDARD": 5, "PROMO": 8}
PAGE_TYPES = ["dynamic", "order", "review", "purchase", "error"]
EVENT_PAGES = {"click": 1, "signup": 2, "view": 3, "purchase": 4, "error": 5}
# Store names are put together from syllables that occur in the documents.
FIRST = "Th Er On An Re He In Ed Nd Ha".split()
MIDDLE = "the ing ion ent ati hat ter was est ers".split()


def _day(column: str) -> Column:
    return F.unix_date(F.to_date(F.col(column))).cast("long")


def _money(cents: Column) -> Column:
    return (cents / 100).cast(MONEY)


def _lookup(values: list[str], position: Column) -> Column:
    """The value at a 0-based position of a short fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


class TestbedTables:
    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    def _lines(self, status: str) -> DataFrame:
        """Order lines of one channel. Money is worked out in whole cents."""
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        percent = F.round(F.col("l_discount") * 100).cast("long")
        quantity = F.col("l_quantity").cast("int")
        discount = F.expr("(cents * percent + 50) div 100")
        cost = F.expr("(cents * 6 + 5) div 10")
        lines = self.raw("lineitem").filter(F.col("l_linestatus") == status)
        return (
            lines
            .withColumns({"cents": cents, "percent": percent, "quantity": quantity})
            .select(
                "*",
                _money(F.col("cents")).alias("price"),
                _money(F.expr("cents div quantity")).alias("unit_price"),
                _money(discount).alias("discount"),
                _money(cost).alias("cost"),
                _money(F.col("cents") + discount).alias("list_price"),
                _money(F.col("cents") - discount).alias("paid"),
                _money(F.col("cents") - discount - cost).alias("profit"),
            )
        )

    def _sold(self, status: str) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return self._lines(status).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _store_sales(self) -> DataFrame:
        return self._sold("O").select(
            _day("o_orderdate").alias("ss_sold_date_sk"),
            F.col("l_partkey").alias("ss_item_sk"),
            F.col("o_custkey").alias("ss_customer_sk"),
            F.col("o_custkey").alias("ss_cdemo_sk"),
            F.col("o_custkey").alias("ss_addr_sk"),
            F.col("l_suppkey").alias("ss_store_sk"),
            F.col("percent").alias("ss_promo_sk"),
            F.col("l_orderkey").alias("ss_ticket_number"),
            F.col("quantity").alias("ss_quantity"),
            F.col("unit_price").alias("ss_sales_price"),
            F.col("discount").alias("ss_ext_discount_amt"),
            F.col("price").alias("ss_ext_sales_price"),
            F.col("cost").alias("ss_ext_wholesale_cost"),
            F.col("list_price").alias("ss_ext_list_price"),
            F.col("paid").alias("ss_net_paid"),
            F.col("profit").alias("ss_net_profit"),
        )

    def _web_sales(self) -> DataFrame:
        return self._sold("F").select(
            _day("o_orderdate").alias("ws_sold_date_sk"),
            ((F.col("l_orderkey") * 37 + F.col("l_partkey") * 11) % 86400).alias("ws_sold_time_sk"),
            F.col("l_partkey").alias("ws_item_sk"),
            F.col("o_custkey").alias("ws_bill_customer_sk"),
            F.col("o_custkey").alias("ws_ship_hdemo_sk"),
            (F.col("l_partkey") % 5 + 1).alias("ws_web_page_sk"),
            F.col("l_suppkey").alias("ws_warehouse_sk"),
            F.col("l_orderkey").alias("ws_order_number"),
            F.col("quantity").alias("ws_quantity"),
            F.col("unit_price").alias("ws_sales_price"),
            F.col("discount").alias("ws_ext_discount_amt"),
            F.col("price").alias("ws_ext_sales_price"),
            F.col("cost").alias("ws_ext_wholesale_cost"),
            F.col("list_price").alias("ws_ext_list_price"),
            F.col("paid").alias("ws_net_paid"),
        )

    def _store_returns(self) -> DataFrame:
        return self._sold("O").filter(F.col("l_returnflag") == "R").select(
            _day("l_shipdate").alias("sr_returned_date_sk"),
            F.col("l_partkey").alias("sr_item_sk"),
            F.col("o_custkey").alias("sr_customer_sk"),
            F.col("l_orderkey").alias("sr_ticket_number"),
            F.col("quantity").alias("sr_return_quantity"),
            F.col("price").alias("sr_return_amt"),
        )

    def _web_returns(self) -> DataFrame:
        return self._lines("F").filter(F.col("l_returnflag") == "R").select(
            _day("l_shipdate").alias("wr_returned_date_sk"),
            F.col("l_partkey").alias("wr_item_sk"),
            F.col("l_orderkey").alias("wr_order_number"),
            F.col("quantity").alias("wr_return_quantity"),
            F.col("unit_price").alias("wr_refunded_cash"),
        )

    def _inventory(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_orderdate")
        return (
            self.raw("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                _day("o_orderdate").alias("inv_date_sk"),
                (F.col("l_partkey") % 20).alias("inv_item_sk"),
                (F.col("l_suppkey") % 10).alias("inv_warehouse_sk"),
                F.col("l_quantity").cast("int").alias("inv_quantity_on_hand"),
            )
        )

    def _item(self) -> DataFrame:
        code = F.coalesce(*[F.when(F.col("p_type") == c, F.lit(n)) for c, n in CATEGORIES.items()])
        return self.raw("part").select(
            F.col("p_partkey").alias("i_item_sk"),
            F.concat(F.lit("I"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")).alias("i_item_id"),
            F.col("p_name").alias("i_item_desc"),
            F.col("p_retailprice").cast("decimal(7,2)").alias("i_current_price"),
            (F.col("p_size") % 15 + 1).alias("i_class_id"),
            code.alias("i_category_id"),
            F.col("p_type").alias("i_category"),
        )

    def _item_marketprices(self) -> DataFrame:
        sk = F.col("p_partkey")
        factor = F.lit(Decimal("0.8")) + (sk % 5 + F.col("n")).cast("decimal(2,0)") * Decimal("0.1")
        return (
            self.raw("part")
            .select("p_partkey", "p_retailprice", F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
            .select(
                (sk * 2 + F.col("n")).alias("imp_sk"),
                sk.alias("imp_item_sk"),
                (F.col("p_retailprice").cast("decimal(7,2)") * factor)
                .cast("decimal(7,2)")
                .alias("imp_competitor_price"),
                (9862 + sk % 300 + F.col("n") * 365).alias("imp_start_date"),
                (9862 + sk % 300 + F.col("n") * 365 + 180 + sk % 200).alias("imp_end_date"),
            )
        )

    def _date_dim(self) -> DataFrame:
        first, days = CALENDAR
        sk = F.col("id")
        date = F.date_from_unix_date(sk.cast("int"))
        return self.spark.range(first, first + days).select(
            sk.alias("d_date_sk"),
            date.cast("string").alias("d_date"),
            F.floor((sk + 3) / 7).cast("int").alias("d_week_seq"),
            F.year(date).alias("d_year"),
            F.month(date).alias("d_moy"),
        )

    def _time_dim(self) -> DataFrame:
        return self.spark.range(86400).select(
            F.col("id").alias("t_time_sk"), F.floor(F.col("id") / 3600).cast("int").alias("t_hour")
        )

    def _customer(self) -> DataFrame:
        sk = F.col("c_custkey")
        return self.raw("customer").select(
            sk.alias("c_customer_sk"),
            sk.alias("c_current_cdemo_sk"),
            sk.alias("c_current_addr_sk"),
            F.substring("c_name", 1, 8).alias("c_first_name"),
            F.substring("c_name", 10, 9).alias("c_last_name"),
            F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N").alias("c_preferred_cust_flag"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("c_birth_country"),
            F.lower("c_name").alias("c_login"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("c_email_address"),
        )

    def _places(self) -> DataFrame:
        return (
            self.raw("nation")
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                "n_nationkey",
                "n_name",
                "r_name",
                (F.lit(-5) - F.col("n_regionkey") % 2).cast("decimal(5,2)").alias("gmt_offset"),
            )
        )

    def _customer_address(self) -> DataFrame:
        return (
            self.raw("customer")
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("ca_address_sk"),
                F.col("n_name").alias("ca_state"),
                F.col("r_name").alias("ca_country"),
                F.col("gmt_offset").alias("ca_gmt_offset"),
            )
        )

    def _customer_demographics(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("cd_demo_sk"),
            F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("cd_gender"),
            _lookup(["M", "S", "D"], F.col("c_nationkey") % 3).alias("cd_marital_status"),
            F.col("c_mktsegment").alias("cd_education_status"),
        )

    def _household_demographics(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("hd_demo_sk"), (F.col("c_custkey") % 10).cast("int").alias("hd_dep_count")
        )

    def _store(self) -> DataFrame:
        sk = F.col("s_suppkey")
        name = F.concat(
            F.when(sk % 7 == 3, "Of ").otherwise(""),
            _lookup(FIRST, sk % 10),
            _lookup(MIDDLE, F.floor(sk / 10) % 10),
            F.when(sk < 100, "").otherwise(F.lower(_lookup(FIRST, F.floor(sk / 100) % 10))),
        )
        return (
            self.raw("supplier")
            .join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("s_store_sk"),
                F.col("s_name").alias("s_store_id"),
                name.alias("s_store_name"),
                F.col("gmt_offset").alias("s_gmt_offset"),
            )
        )

    def _warehouse(self) -> DataFrame:
        return (
            self.raw("supplier")
            .join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("w_warehouse_sk"),
                F.col("s_name").alias("w_warehouse_name"),
                F.col("n_name").alias("w_state"),
            )
        )

    def _promotion(self) -> DataFrame:
        sk = F.col("id")

        def channel(on: Column) -> Column:
            return F.when(on, "Y").otherwise("N")

        return self.spark.range(11).select(
            sk.alias("p_promo_sk"),
            channel(sk >= 5).alias("p_channel_dmail"),
            channel(sk % 3 == 0).alias("p_channel_email"),
            channel(sk == 10).alias("p_channel_tv"),
        )

    def _web_page(self) -> DataFrame:
        sk = F.col("id")
        return self.spark.range(1, 6).select(
            sk.alias("wp_web_page_sk"),
            _lookup(PAGE_TYPES, sk - 1).alias("wp_type"),
            (4500 + sk * 500).cast("int").alias("wp_char_count"),
        )

    def _web_clickstreams(self) -> DataFrame:
        ts = F.col("ts")
        page = F.coalesce(
            *[F.when(F.col("event_type") == e, F.lit(p).cast("long")) for e, p in EVENT_PAGES.items()]
        )
        return self.raw("events").select(
            (_day("ts") - EVENT_DAYS_BACK).alias("wcs_click_date_sk"),
            (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long").alias("wcs_click_time_sk"),
            F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("wcs_sales_sk"),
            F.get_json_object("props", "$.k").cast("long").alias("wcs_item_sk"),
            page.alias("wcs_web_page_sk"),
            F.col("user_id").alias("wcs_user_sk"),
        )

    def _product_reviews(self) -> DataFrame:
        """Documents with the rating of their label; unlabelled ones have none. Grouped labels have
        one row a document, so that the join goes where no rating is read."""
        rating = (
            F.when(F.col("quality").isNull(), None)
            .when(F.col("quality") == 0, 1)
            .when(F.col("toxic") == 1, 3)
            .otherwise(5)
        )
        days = (F.lit(9862) + F.col("doc_id") % 365).cast("int")
        labels = self.raw("labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
        return (
            self.raw("documents")
            .join(labels, "doc_id", "left")
            .select(
                F.col("doc_id").alias("pr_review_sk"),
                F.date_from_unix_date(days).cast("string").alias("pr_review_date"),
                rating.cast("int").alias("pr_review_rating"),
                (F.col("n_chars") % 100).alias("pr_item_sk"),
                F.col("text").alias("pr_review_content"),
            )
        )
