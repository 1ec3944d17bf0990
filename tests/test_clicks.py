import random

import pytest
from pyspark.sql import functions as F

from tillwise.operators.baskets import seen_with
from tillwise.streaming import (
    abandoned_carts,
    abandoned_sessions,
    last_views_before_purchase,
    sales_after_page,
    seen_in_session_with,
    session_totals,
    sessionize,
)
from tillwise.streaming.ranges import TASK, in_ranges

CLICKS = "user long, ts long, item long, sale long, page string"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def random_clicks(seed, users=4, n=600, span=5000):
    """Clicks with many equal times; user 0 owns more than a third of them."""
    rnd = random.Random(seed)
    result = []
    for _ in range(n):
        user = 0 if rnd.random() < 0.4 else rnd.randrange(users)
        sale = rnd.randrange(1000) if rnd.random() < 0.2 else None
        page = rnd.choice(["dynamic", "order", "review", "other", None])
        result.append((user, 10 + rnd.randrange(span), rnd.randrange(6), sale, page))
    return result


def nulls_first(value):
    return (value is not None, value if value is not None else 0)


def by_user(clicks, key):
    users = {}
    for c in sorted(clicks, key=key):
        users.setdefault(c[0], []).append(c)
    return users


@pytest.mark.parametrize("chunk", [1, 25, 400, 86400])
def test_sessionize_by_hand(spark, chunk):
    """Two visits an hour and a half apart, one visit in short steps, and a lone click."""
    visits = [
        (5, 7200, "a1"), (5, 7290, "a1"), (5, 1800, "a0"), (5, 1800, "a0"),
        (8, 400, "b0"), (8, 1000, "b0"), (8, 1600, "b0"), (8, 2200, "b0"), (9, 55, "c0"),
    ]
    df = spark.createDataFrame(visits, "user long, ts long, visit string").repartition(3)
    found = sessionize(df, user="user", ts="ts", timeout=600)
    number = {"a0": "5_1", "a1": "5_2", "b0": "8_1", "c0": "9_1"}
    assert sorted((r["visit"], r["session_id"]) for r in found.collect()) == sorted(
        (v, number[v]) for _, _, v in visits
    )


@pytest.mark.parametrize("chunk", [3, 50, 86400])
def test_gap_of_exactly_the_timeout_stays(spark, chunk):
    df = spark.createDataFrame([(1, 100), (1, 110), (1, 121), (1, 121), (None, 5)], "user long, ts long")
    found = sessionize(df, user="user", ts="ts", timeout=10)
    assert rows(found, "ts", "session_no") == [(100, 1), (110, 1), (121, 2), (121, 2)]


@pytest.mark.parametrize("chunk", [5, 64, 10**6])
def test_sessionize_against_a_loop(spark, chunk):
    clicks = random_clicks(1)
    expected = []
    for user, mine in by_user(clicks, key=lambda c: c[1]).items():
        number, before = 1, None
        for c in mine:
            if before is not None and c[1] - before > 20:
                number += 1
            before = c[1]
            expected.append((user, c[1], c[2], number))
    df = spark.createDataFrame(clicks, CLICKS)
    found = sessionize(df, user="user", ts="ts", timeout=20)
    assert rows(found, "user", "ts", "item", "session_no") == sorted(expected)


def views_by_loop(clicks, item, views, seconds):
    found = []
    for mine in by_user(clicks, key=lambda c: (c[1], nulls_first(c[3]), c[2])).values():
        for at, c in enumerate(mine):
            if c[2] == item and c[3] is not None:
                found += [v[2] for v in mine[max(0, at - views):at] if c[1] - v[1] <= seconds]
    return sorted(found)


@pytest.mark.parametrize("chunk", [4, 100, 10**6])
@pytest.mark.parametrize(("views", "seconds"), [(5, 60), (1, 10**6), (40, 10**6)])
def test_last_views_against_a_loop(spark, chunk, views, seconds):
    clicks = random_clicks(2)
    df = spark.createDataFrame(clicks, CLICKS)
    found = last_views_before_purchase(
        df, user="user", ts="ts", item="item", sale="sale", purchased=2,
        within_seconds=seconds, views=views, chunk_seconds=chunk,
    )
    expected = views_by_loop(clicks, 2, views, seconds)
    assert sorted(r["lastviewed_item"] for r in found.collect()) == expected
    assert expected


def test_last_views_of_a_purchase_as_first_click(spark):
    df = spark.createDataFrame([(1, 5, 2, 9, None)], CLICKS)
    found = last_views_before_purchase(
        df, user="user", ts="ts", item="item", sale="sale", purchased=2, within_seconds=10, views=5
    )
    assert found.count() == 0


def sales_by_loop(clicks, seconds):
    found = set()
    key = lambda c: (c[1], nulls_first(c[3]), (c[4] is not None, c[4] or ""))
    for mine in by_user(clicks, key=key).values():
        seen = None
        for c in mine:
            if c[4] == "review":
                seen = c[1]
            elif c[3] is not None and seen is not None and c[1] - seen <= seconds:
                found.add(c[3])
    return sorted(found)


@pytest.mark.parametrize("chunk", [6, 200, 10**6])
@pytest.mark.parametrize("seconds", [0, 15, 10**6])
def test_sales_after_page_against_a_loop(spark, chunk, seconds):
    clicks = random_clicks(3)
    found = sales_after_page(
        spark.createDataFrame(clicks, CLICKS), user="user", ts="ts", sale="sale", page_type="page",
        wanted="review", within_seconds=seconds,
    )
    assert sorted(r["sale"] for r in found.collect()) == sales_by_loop(clicks, seconds)


@pytest.mark.parametrize(("seconds", "expected"), [(30, [71, 73]), (90, [71, 72, 73])])
def test_sales_after_page_by_hand(spark, seconds, expected):
    clicks = [
        (4, 100, 1, 70, "other"),  # before any review
        (4, 120, 1, None, "review"),
        (4, 150, 2, 71, "order"),
        (4, 200, 2, 72, "order"),
        (6, 140, 3, 74, "order"),  # another user's review does not count
        (6, 500, 3, None, "review"),
        (6, 500, 3, 73, "order"),
    ]
    found = sales_after_page(
        spark.createDataFrame(clicks, CLICKS), user="user", ts="ts", sale="sale", page_type="page",
        wanted="review", within_seconds=seconds,
    )
    assert sorted(r["sale"] for r in found.collect()) == expected


def test_abandoned_sessions(spark):
    pages = {
        1: ["dynamic", "other"],
        2: ["dynamic", "order"],
        3: ["order", "dynamic", "other"],
        4: ["other"],
    }
    data = [(s, at, p) for s, kinds in pages.items() for at, p in enumerate(kinds)]
    data += [(5, 0, "dynamic"), (5, 0, "order")]  # equal times: sorted by type
    df = spark.createDataFrame(data, "session int, ts long, page string")
    found = abandoned_sessions(df, session=["session"], ts="ts", page_type="page")
    assert rows(found, "session", "pagecount") == [(1, 2), (3, 3)]


@pytest.mark.parametrize("chunk", [5, 64, 10**6])
def test_abandoned_carts_equal_abandoned_sessions(spark, chunk):
    df = spark.createDataFrame(random_clicks(4), CLICKS)
    sessions = sessionize(df, user="user", ts="ts", timeout=20)
    expected = abandoned_sessions(sessions, session=["user", "session_no"], ts="ts", page_type="page")
    found = abandoned_carts(df, user="user", ts="ts", page_type="page", timeout=20, chunk_seconds=chunk)
    columns = ("user", "session_no", "pagecount")
    assert rows(found, *columns) == rows(expected, *columns) != []


def test_session_totals_shuffle_the_clicks_once(spark):
    """One exchange of clicks by user and chunk, one of session parts by user."""
    df = spark.createDataFrame(random_clicks(5), CLICKS)
    found = session_totals(
        df, user="user", ts="ts", timeout=20,
        partial=[F.count(F.lit(1)).alias("n")], merge=[F.sum("n").alias("n")],
    )
    assert sum(r["n"] for r in found.collect()) == 600
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_seen_in_session_with(spark, seed):
    """As sessions and their items counted apart; the clicks are written in parts once."""
    df = spark.createDataFrame(random_clicks(seed), CLICKS)
    sessions = sessionize(df.filter("item IS NOT NULL"), user="user", ts="ts", timeout=20)
    expected = seen_with(sessions, basket=["user", "session_no"], item="item", target=2)
    found = seen_in_session_with(
        df, user="user", ts="ts", item="item", target=2, timeout=20, chunk_seconds=50
    )
    assert rows(found, "item", "cnt") == rows(expected, "item", "cnt") != []


@pytest.fixture(params=[3, 10_000])
def batches(spark, request):
    """Rows that a task sees at once, in partitions that stay apart."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def plain_sessions(clicks, timeout):
    numbers = []
    for user, own in by_user(clicks, lambda c: c[1]).items():
        no, last = 0, None
        for c in own:
            no += last is None or c[1] - last > timeout
            last = c[1]
            numbers.append((user, c[1], no))
    return sorted(numbers)


@pytest.mark.parametrize("users", [1, 2, 40])
def test_sessions_cross_partitions(spark, batches, users):
    """One user with all clicks of one day fills many partitions."""
    clicks = random_clicks(users, users=users, n=400, span=3000)
    df = spark.createDataFrame(clicks, CLICKS).repartition(3)
    for timeout in (0, 5, 30, 5000):
        found = sessionize(df, user="user", ts="ts", timeout=timeout)
        assert rows(found, "user", "ts", "session_no") == plain_sessions(clicks, timeout)


def test_one_exchange_of_clicks(spark, batches):
    clicks = spark.createDataFrame(random_clicks(1, users=1, n=5000, span=86400), CLICKS)
    ordered = in_ranges(clicks, ["user", "ts"])
    assert ordered.select(TASK).distinct().count() == 4
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    result = sessionize(clicks, user="user", ts="ts", timeout=20)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1
    assert sessionize(clicks.filter("false"), user="user", ts="ts", timeout=20).count() == 0


def test_sales_cross_partitions(spark, batches):
    clicks = random_clicks(8, users=2, n=500, span=4000)
    want = set()
    for own in by_user(clicks, lambda c: (c[1], nulls_first(c[3]), (c[4] is not None, c[4] or ""))).values():
        latest = None
        for _, ts, _, sale, page in own:
            if page == "review":
                latest = ts
            elif sale is not None and latest is not None and ts - latest <= 40:
                want.add(sale)
    df = spark.createDataFrame(clicks, CLICKS).repartition(3)
    found = sales_after_page(df, user="user", ts="ts", sale="sale", page_type="page", wanted="review", within_seconds=40)
    assert rows(found, "sale") == sorted((s,) for s in want)
