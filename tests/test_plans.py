"""Edge cases of whole queries on hand-made tables."""

import math
import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwise import ParquetTables, plans, session
from tillwise.operators import fanout, text
from tillwise.operators.features import return_behaviour, split_by_id
from tillwise.operators.models import (
    Clusters,
    classifier_facts,
    cluster,
    cluster_facts,
    interest_classifier,
    interest_weights,
    logistic_weights,
    review_classifier,
)
from tillwise.operators.periods import quantity_around_price_change
from tillwise.operators.statistics import correlation, linear_fit, variation
from tillwise.plans import reviews
from tillwise.sources import write_delimited
from tillwise.sources.schemas import SCHEMAS


class Tables(dict):
    """Hand-made tables; missing columns are NULL."""

    def __init__(self, spark, **rows):
        super().__init__()
        self.spark = spark
        rows.setdefault("date_dim", calendar())
        for name, data in rows.items():
            schema = spark.createDataFrame([], SCHEMAS[name]).schema
            full = [tuple(r.get(f.name) for f in schema) for r in data]
            for f in schema:
                f.nullable = True
            self[name] = spark.createDataFrame(full, schema)


def serial(day: str) -> int:
    return (date.fromisoformat(day) - date(1900, 1, 1)).days


def calendar(first="2000-12-25", days=800):
    start = date.fromisoformat(first)
    result = []
    for i in range(days):
        d = start + timedelta(i)
        sk = serial(d.isoformat())
        result.append(dict(d_date_sk=sk, d_date=d.isoformat(), d_week_seq=sk // 7, d_year=d.year, d_moy=d.month))
    return result


def money(x):
    return Decimal(str(x))


def test_q16_two_refunds_repeat_the_sale(spark):
    day = serial("2001-03-16")
    t = Tables(
        spark,
        web_sales=[
            dict(ws_sold_date_sk=day, ws_item_sk=1, ws_order_number=7, ws_warehouse_sk=3, ws_sales_price=money(10)),
            dict(ws_sold_date_sk=day - 30, ws_item_sk=1, ws_order_number=8, ws_warehouse_sk=3, ws_sales_price=money(5)),
            dict(ws_sold_date_sk=day - 31, ws_item_sk=1, ws_order_number=9, ws_warehouse_sk=3, ws_sales_price=money(5)),
        ],
        web_returns=[
            dict(wr_order_number=7, wr_item_sk=1, wr_refunded_cash=money(2)),
            dict(wr_order_number=7, wr_item_sk=1, wr_refunded_cash=None),
        ],
        item=[dict(i_item_sk=1, i_item_id="A")],
        warehouse=[dict(w_warehouse_sk=3, w_state="TN")],
    )
    assert [tuple(r) for r in plans.q16(t).collect()] == [("TN", "A", money("5.00"), money("18.00"))]


def test_q19_a_week_listed_twice_counts_twice(spark):
    monday = next(d for d in calendar() if d["d_date_sk"] % 7 == 0)["d_date_sk"]
    day = (date(1900, 1, 1) + timedelta(monday)).isoformat()
    next_day = (date(1900, 1, 1) + timedelta(monday + 1)).isoformat()
    t = Tables(
        spark,
        store_returns=[dict(sr_returned_date_sk=monday + 3, sr_item_sk=1, sr_ticket_number=1, sr_return_quantity=5)],
        web_returns=[dict(wr_returned_date_sk=monday, wr_item_sk=1, wr_order_number=1, wr_return_quantity=10)],
        product_reviews=[dict(pr_review_sk=1, pr_item_sk=1, pr_review_rating=1, pr_review_content="So bad.")],
    )
    assert plans.q19(t, store_dates=[day], web_dates=[day]).count() == 0
    twice = plans.q19(t, store_dates=[day, next_day], web_dates=[day])
    assert [tuple(r) for r in twice.collect()] == [(1, "So bad.", "NEG", "bad")]


def test_q14_without_evening_sales(spark):
    t = Tables(
        spark,
        web_sales=[dict(ws_sold_time_sk=7 * 3600, ws_ship_hdemo_sk=1, ws_web_page_sk=1, ws_item_sk=1, ws_order_number=1)],
        household_demographics=[dict(hd_demo_sk=1, hd_dep_count=5)],
        web_page=[dict(wp_web_page_sk=1, wp_char_count=5000)],
        time_dim=[dict(t_time_sk=7 * 3600, t_hour=7)],
    )
    assert plans.q14(t).first()["am_pm_ratio"] == money("-1.0000")


def test_q12_needs_a_view_before_the_purchase(spark):
    def view(user, day, sale=None):
        return dict(wcs_user_sk=user, wcs_click_date_sk=day, wcs_item_sk=1, wcs_sales_sk=sale)

    def sale(user, day):
        return dict(ss_customer_sk=user, ss_sold_date_sk=day, ss_item_sk=1, ss_ticket_number=1)

    t = Tables(
        spark,
        web_clickstreams=[view(1, 100), view(1, 105), view(2, 110), view(3, 100, sale=9), view(4, 131), view(5, 130)],
        store_sales=[sale(1, 90), sale(1, 103), sale(2, 110), sale(3, 120), sale(4, 140), sale(5, 190), sale(5, 191)],
        item=[dict(i_item_sk=1, i_item_id="A", i_category="Books")],
    )
    assert [r["u_id"] for r in plans.q12(t, first_day=100).collect()] == [1, 5]


def test_q24_zero_divisors_are_left_out(spark):
    def change(sk, price):
        return dict(imp_sk=sk, imp_item_sk=1, imp_competitor_price=money(price), imp_start_date=100, imp_end_date=110)

    t = Tables(
        spark,
        item=[dict(i_item_sk=1, i_item_id="A", i_current_price=money(10))],
        item_marketprices=[change(1, 12), change(2, 10)],
        web_sales=[
            dict(ws_item_sk=1, ws_order_number=1, ws_sold_date_sk=d, ws_quantity=q)
            for d, q in [(100, 6), (109, 1), (110, 99), (90, 4), (89, 99)]
        ],
        store_sales=[dict(ss_item_sk=1, ss_ticket_number=1, ss_sold_date_sk=99, ss_quantity=1)],
    )
    assert [tuple(r) for r in plans.q24(t, item_sk=1).collect()] == [(1, money("2.0000000"))]


def test_q21_repeats_quantities_per_match(spark):
    day = serial("2001-01-05")
    sold = dict(ss_sold_date_sk=day, ss_item_sk=1, ss_customer_sk=2, ss_ticket_number=3, ss_store_sk=4)
    t = Tables(
        spark,
        store_sales=[sold | dict(ss_quantity=5), sold | dict(ss_quantity=7)],
        store_returns=[
            dict(sr_returned_date_sk=day + 9, sr_item_sk=1, sr_customer_sk=2, sr_ticket_number=3, sr_return_quantity=2)
        ],
        web_sales=[
            dict(ws_sold_date_sk=day + n, ws_item_sk=1, ws_bill_customer_sk=2, ws_order_number=n, ws_quantity=10)
            for n in (0, 1, 2)
        ],
        store=[dict(s_store_sk=4, s_store_id="S", s_store_name="Forest")],
        item=[dict(i_item_sk=1, i_item_id="A", i_item_desc="a")],
    )
    row = plans.q21(t, year=2001, month=1).first()
    assert tuple(row) == ("A", "a", "S", "Forest", 36, 12, 60)


def test_q18_names_are_matched_as_substrings(spark):
    days = [serial("2001-05-02") + n for n in range(3)]

    def sales(store, paid):
        return [
            dict(ss_sold_date_sk=d, ss_store_sk=store, ss_item_sk=1, ss_ticket_number=1, ss_net_paid=money(p))
            for d, p in zip(days, paid)
        ]

    t = Tables(
        spark,
        store_sales=sales(1, [30, 20, 10]) + sales(2, [10, 20, 30]) + sales(3, [5, 5, 5]) + sales(4, [9])[:1],
        store=[dict(s_store_sk=k, s_store_id=str(k), s_store_name=n) for k, n in
               [(1, "Forest "), (2, "Lake"), (3, "oak hill"), (4, "Forest")]],
        product_reviews=[
            dict(pr_review_sk=1, pr_item_sk=1, pr_review_rating=1, pr_review_date="2001-05-05",
                 pr_review_content="The FOREST is bad. Lake is nice."),
            dict(pr_review_sk=2, pr_item_sk=1, pr_review_rating=1, pr_review_date="2001-05-06",
                 pr_review_content="Oak Hill? Never, so sad"),
        ],
    )
    expected = [
        ("1_Forest ", "2001-05-05", "The FOREST is bad.", "NEG", "bad"),
        ("3_oak hill", "2001-05-06", "Never, so sad", "NEG", "never"),
        ("3_oak hill", "2001-05-06", "Never, so sad", "NEG", "sad"),
    ]
    assert [tuple(r) for r in plans.q18(t).collect()] == expected


def test_q18_does_not_move_its_whole_result(spark, monkeypatch):
    """A sentence goes to each part of the names once, not to each store, and is not written for each either."""
    written = []

    def counted(table, by=None):
        out = session.durable(table, by)
        written.append(out.count())
        return out

    for module in (reviews, text, fanout):
        monkeypatch.setattr(module, "durable", counted)
    days = [serial("2001-05-02"), serial("2001-05-03")]
    stores = range(1, 1001)
    t = Tables(
        spark,
        store_sales=[dict(ss_sold_date_sk=d, ss_store_sk=k, ss_item_sk=1, ss_ticket_number=1, ss_net_paid=money(5)) for k in stores for d in days],
        store=[dict(s_store_sk=k, s_store_id=str(k), s_store_name="Forest") for k in stores],
        product_reviews=[
            dict(pr_review_sk=1, pr_item_sk=1, pr_review_rating=1, pr_review_date="2001-05-05",
                 pr_review_content="The forest is bad. " + " ".join(f"Number {i} is bad." for i in range(49)))
        ],
    )
    found = plans.q18(t)
    assert found.count() == 50 * 1000 and max(written) <= 1000
    moved = found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert "Exchange" not in moved and "Sort" not in moved


def test_linear_fit_of_one_day_is_null(spark):
    df = spark.createDataFrame(
        [(1, 10, money(1)), (1, 20, money(3)), (1, 30, money(5)), (2, 10, money(9))],
        "g int, x long, y decimal(20,2)",
    )
    fits = {r["g"]: (r["slope"], r["intercept"]) for r in linear_fit(df, group=["g"], x="x", y="y").collect()}
    assert fits == {1: (pytest.approx(0.2), pytest.approx(-1.0)), 2: (None, None)}


def test_correlation_without_spread_is_null(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, None)], "x int, y double")
    assert correlation(df, x="x", y="y").first()["correlation"] is None


def test_variation_skips_zero_mean(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 3), (3, 4)], "g int, v int")
    rows = {r["g"]: r["cov"] for r in variation(df, group=["g"], value="v").collect()}
    assert rows.keys() == {2, 3} and float(rows[2]) == pytest.approx(0.707105) and rows[3] is None


def test_customers_without_returns_get_zeros(spark):
    schema = "cid long, order_no long, item long, money decimal(7,2)"
    orders = spark.createDataFrame([(1, 1, 1, money(10)), (1, 2, 1, money(30)), (2, 3, 1, money(0))], schema)
    returns = spark.createDataFrame([(1, 1, 1, money(10))], schema)
    rows = sorted(tuple(r) for r in return_behaviour(orders, returns).collect())
    assert rows == [(1, 0.5, 0.5, 0.25, 1.0), (2, 0.0, 0.0, 0.0, 0.0)]


def test_split_by_id(spark):
    train, test = split_by_id(spark.range(-10, 25), "id")
    assert sorted(r["id"] for r in test.collect()) == [-10, 0, 10, 20]
    assert train.count() == 31


def test_clusters_cover_all_rows(spark):
    rows = [(i, float(i % 4 * 100), float(i % 4)) for i in range(200)]
    result = cluster(spark.createDataFrame(rows, "id long, a double, b double"), key="id", k=4, seed=3)
    again = cluster(spark.createDataFrame(rows, "id long, a double, b double"), key="id", k=4, seed=3)
    assert result.assignments.count() == 200
    assert sum(r["size"] for r in result.centers.collect()) == 200
    assert result.cost == again.cost >= 0


def test_cluster_facts_see_wrong_clusters(spark):
    rows = [(i, float(i % 4 * 100), float(i % 4)) for i in range(200)]
    features = spark.createDataFrame(rows, "id long, a double, b double")
    result = cluster(features, key="id", k=4, seed=3)
    right = cluster_facts(features, result, key="id").first()
    assert tuple(right[c] for c in ("n_rows", "n_keys", "n_sized")) == (200, 200, 200)
    assert right["misplaced"] == right["off_center"] == 0 and right["cost_agrees"]
    k = result.centers.count()
    assert k > 1
    moved = result.assignments.selectExpr("id", f"cast((cluster + 1) % {k} as int) as cluster")
    wrong = cluster_facts(features, Clusters(moved, result.centers, result.cost + 5), key="id").first()
    assert wrong["misplaced"] > 0 and wrong["off_center"] > 0 and not wrong["cost_agrees"]


def test_classifier_facts(spark):
    rows = [(i % 10, (i * 7) % 3, (i * i) % 11) for i in range(300)]
    features = spark.createDataFrame(rows, "clicks long, male long, other long")
    quality = interest_classifier(features, count="clicks", threshold=6, iterations=200, tolerance=1e-10)
    row = classifier_facts(quality).first()
    assert (row["negatives"], row["positives"]) == (210, 90)
    assert row["accuracy_agrees"] and row["better_than_chance"] and row["calibrated"]


def naive_bayes(train, text, smoothing):
    """Class by plain loops."""
    counts = {c: Counter(w for l, t in train if l == c for w in t.lower().split()) for c, _ in train}
    vocabulary = set().union(*counts.values())

    def log(v):
        return math.log(v) if v > 0 else -math.inf

    def score(c):
        whole = log(sum(counts[c].values()) + smoothing * len(vocabulary))
        docs = sum(l == c for l, _ in train)
        prior = log(docs + smoothing) - log(len(train) + smoothing * len(counts))
        return prior + sum(log(counts[c][w] + smoothing) - whole for w in text.lower().split() if w in vocabulary)

    return max(sorted(counts), key=lambda c: round(score(c), 9))


@pytest.mark.parametrize("smoothing", [0.0, 0.3, 1.0])
def test_review_classes_equal_a_plain_naive_bayes(spark, smoothing):
    rnd = random.Random(4)
    rating_of = {"NEG": 1, "NEUT": 3, "POS": 5}
    train = [(rnd.choice(list(rating_of)), " ".join(rnd.choices("abcdefghijk", k=rnd.randrange(1, 9)))) for _ in range(60)]
    train += [(c, "A b c d e f g h i j K") for c in rating_of]
    tests = [" ".join(rnd.choices("abcdefghijkxyz", k=rnd.randrange(0, 12))) for _ in range(40)] + ["", "zz zz"]
    schema = "id long, rating int, body string"
    result = review_classifier(
        spark.createDataFrame([(i, rating_of[c], t) for i, (c, t) in enumerate(train)], schema),
        spark.createDataFrame([(i, 3, t) for i, t in enumerate(tests)] + [(99, 5, None)], schema),
        key="id", rating="rating", text="body", smoothing=smoothing,
    )
    classes = {r["review_sk"]: r["class"] for r in result.predictions.collect()}
    assert classes.pop(99) == naive_bayes(train, "", smoothing)
    assert classes == {i: naive_bayes(train, t, smoothing) for i, t in enumerate(tests)}


def test_word_unseen_in_a_class_rules_it_out(spark):
    schema = "id long, rating int, body string"
    train = spark.createDataFrame([(1, 1, "bad bad bad"), (2, 5, "good thing"), (3, 5, "good")], schema)
    test = spark.createDataFrame([(10, 5, "bad bad"), (20, 1, "good"), (30, 1, "new")], schema)
    result = review_classifier(train, test, key="id", rating="rating", text="body", smoothing=0.0)
    found = {r["review_sk"]: r["class"] for r in result.predictions.collect()}
    assert found == {10: "NEG", 20: "POS", 30: "POS"}


def test_logistic_weights_have_no_gradient_left(spark):
    turn = random.Random(5)
    rows = [(turn.gauss(0, 1), turn.randrange(4), 7, turn.random()) for _ in range(400)]
    rows = [(a, b, c, 2 * a - b, int(turn.random() < 1 / (1 + math.exp(-a - 0.5 * b + 1)))) for a, b, c, _ in rows]
    df = spark.createDataFrame([*rows, (None, 1, 7, 0.0, 1)], "a double, b int, `c.c` int, d double, label int")
    weights = logistic_weights(df, ["a", "b", "c.c", "d"], "label")
    assert weights[3] == weights[4] == 0.0  # constant, and determined by a and b
    gradient = [0.0] * 3
    for a, b, _, _, label in rows:
        p = 1 / (1 + math.exp(-(weights[0] + weights[1] * a + weights[2] * b)))
        for i, v in enumerate((1.0, a, b)):
            gradient[i] += (label - p) * v
    assert max(map(abs, gradient)) < 1e-8
    assert logistic_weights(df.limit(0), ["a"], "label") == [0.0, 0.0]


def test_interest_weights_name_their_features(spark):
    rows = [(i % 10, (i * 7) % 3, (i * i) % 11) for i in range(300)]
    found = interest_weights(spark.createDataFrame(rows, "clicks long, male long, other long"), count="clicks")
    assert [r["feature"] for r in found.collect()] == [None, "male", "other"]


def test_interest_classifier_counts(spark):
    rows = [(i % 10, i % 2, (i % 10) * 2) for i in range(100)]
    row = interest_classifier(
        spark.createDataFrame(rows, "clicks long, male long, other long"), count="clicks"
    ).first()
    assert row["n_00"] + row["n_01"] + row["n_10"] + row["n_11"] == 100
    assert row["accuracy"] > 0.9 and row["auc"] > 0.9


def test_review_classifier(spark):
    words = {1: "awful broken", 3: "plain middling", 5: "great happy"}
    rows = [(i, r, f"{words[r]} thing {i}") for i, r in enumerate([1, 3, 5] * 40)] + [(999, None, "x")]
    train, test = split_by_id(spark.createDataFrame(rows, "id long, rating int, body string"), "id")
    result = review_classifier(train, test, key="id", rating="rating", text="body")
    assert {r["class"] for r in result.predictions.collect()} == {"NEG", "NEUT", "POS"}
    quality = {r["label"]: r for r in result.quality.collect()}
    assert all(q["f1"] == 1.0 and q["accuracy"] == 1.0 for q in quality.values())


def test_parquet_tables_and_text_output(spark, tmp_path):
    t = Tables(
        spark,
        store_sales=[dict(ss_item_sk=i % 2, ss_store_sk=10, ss_ticket_number=i) for i in range(5)],
        item=[dict(i_item_sk=k, i_item_id=str(k), i_category_id=k + 1, i_category=n)
              for k, n in enumerate(["Home", "Music"])],
    )
    for name, df in t.items():
        df.write.parquet(f"{tmp_path}/{name}")
    tables = ParquetTables(spark, str(tmp_path))
    result = plans.q00(tables)
    assert sorted(map(tuple, result.collect())) == [("Home", 3), ("Music", 2)]
    assert tables["store_sales"].columns == t["store_sales"].columns

    rows = spark.createDataFrame(
        [(1, money("1.50000"), "a,b"), (2, None, None), (3, money("20.00000"), "")],
        "id int, ratio decimal(15,5), text string",
    )
    out = str(tmp_path / "out")
    write_delimited(rows, out)
    write_delimited(rows.filter("id = 1"), out)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["1,1.5,a,b", "1,1.5,a,b", "2,\\N,\\N", "3,20,"]
    write_delimited(rows.filter("id = 2"), out, mode="overwrite", delimiter="|")
    assert [r["value"] for r in spark.read.text(out).collect()] == ["2|\\N|\\N"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_reads_once(spark, tmp_path):
    spark.range(100).withColumn("body", F.lit("x")).write.parquet(str(tmp_path / "rows"))
    train, test = split_by_id(spark.read.parquet(str(tmp_path / "rows")), "id")
    for part in (train, test):
        assert str(tmp_path / "rows") not in plan_of(part)
        assert "PartitionFilters: [isnotnull(_part" in plan_of(part)
        assert part.columns == ["id", "body"]
    assert (train.count(), test.count()) == (90, 10)
    assert split_by_id(spark.range(0), "id")[1].count() == 0


def test_intervals_by_running_sums(spark):
    rnd = random.Random(6)
    sales = [(rnd.randrange(4), rnd.choice([None, *range(60)]), rnd.choice([None, 1, 2, 5])) for _ in range(300)] + [(None, 3, 9)]
    changes = [
        (rnd.randrange(6), i, 0.5, rnd.choice([None, *range(70)]), rnd.choice([None, -3, 0, 1, 7, 100])) for i in range(80)
    ]
    changes += [changes[0]] * 2 + [(None, 99, 0.5, 3, 3)]
    want = {}
    for item, imp, _, start, n in changes:
        if not any(s[0] == item for s in sales) or item is None:
            continue
        now = past = 0
        if start is not None and n is not None:
            own = [(d, q or 0) for i, d, q in sales if i == item and d is not None]
            now = sum(q for d, q in own if start <= d < start + n)
            past = sum(q for d, q in own if start - n <= d < start)
        a, b = want.get((item, imp), (0, 0))
        want[item, imp] = (a + now, b + past)
    found = quantity_around_price_change(
        spark.createDataFrame(sales, "item long, day long, quantity int"),
        spark.createDataFrame(changes, "i_item_sk long, imp_sk long, price_change double, imp_start_date long, no_days long"),
        item="item", day="day", quantity="quantity",
    )
    assert {(r.i_item_sk, r.imp_sk): (r.current, r.previous) for r in found.collect()} == want
    assert "Join" not in plan_of(found)
