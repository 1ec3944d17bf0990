"""Facts laid out by day: the same rows, and only the days asked for are read."""

import pytest
from pyspark.sql import functions as F

from tests.test_plans import Tables, money, serial
from tillwise import ParquetTables
from tillwise.sources import write_by_day


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Sales of ten days, one of them with most rows and one null; the calendar as a table."""
    days = [serial("2001-03-01") + i for i in range(10)]
    sales = [
        dict(ss_sold_date_sk=days[3] if i % 3 else days[i % 10], ss_item_sk=i % 4, ss_customer_sk=i % 7,
             ss_ticket_number=i, ss_quantity=i % 5)
        for i in range(300)
    ]
    sales.append(dict(ss_item_sk=1, ss_ticket_number=999))
    made = Tables(spark, store_sales=sales, item=[
        dict(i_item_sk=k, i_item_id=str(k), i_current_price=money(k + 1), i_category="Books") for k in range(4)])
    root = str(tmp_path_factory.mktemp("plain"))
    for name, table in made.items():
        table.write.parquet(f"{root}/{name}")
    plain = ParquetTables(spark, root)
    return plain, write_by_day(plain, str(tmp_path_factory.mktemp("days")) + "/facts", ("store_sales",))


def in_first_days(t):
    days = t["date_dim"].filter((F.col("d_date") >= "2001-03-02") & (F.col("d_date") <= "2001-03-04"))
    return t["store_sales"].join(days.select("d_date_sk"), F.col("ss_sold_date_sk") == F.col("d_date_sk"), "left_semi")


def test_rows_and_types_stay(tables):
    plain, by_day = tables
    names = plain["store_sales"].columns
    assert sorted(by_day["store_sales"].dtypes) == sorted(plain["store_sales"].dtypes)
    mine, theirs = (sorted(map(str, t["store_sales"].select(names).collect())) for t in (by_day, plain))
    assert mine == theirs and len(mine) == 301
    assert by_day["item"].count() == 4


def test_the_days_of_a_join_prune_the_scan(tables):
    plain, by_day = tables
    found = in_first_days(by_day)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert found.count() == in_first_days(plain).count()
    one = by_day["store_sales"].filter(F.col("ss_sold_date_sk") == serial("2001-03-04"))
    files = [r[0] for r in one.select(F.input_file_name()).distinct().collect()]
    assert files and all(f"ss_sold_date_sk={serial('2001-03-04')}/" in f for f in files)


def test_a_day_with_most_rows_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.lit(5).cast("long").alias("inv_date_sk"), F.col("id").alias("inv_item_sk"),
        F.col("id").alias("inv_warehouse_sk"), F.lit(1).alias("inv_quantity_on_hand"))
    source = {"inventory": rows}
    # So few rows would be coalesced into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = write_by_day(_Named(spark, source), str(tmp_path / "facts"), ("inventory",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(made["inventory"].inputFiles()) > 1 and made["inventory"].count() == 20_000


class _Named(dict):
    def __init__(self, spark, tables):
        super().__init__(tables)
        self.spark = spark
