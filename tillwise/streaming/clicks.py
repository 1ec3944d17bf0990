"""Ordered passes over each user's click stream.

A pass over one user's clicks in time order is a window over the user. One user,
a crawler say, may own a third of all clicks, and a plain window would put them
into one task. Sessions and sales after a page are passes over range partitions (``ranges``).
The other passes run over (user, time chunk) instead and then hands a
small state from chunk to chunk:

1. window over (user, chunk): the state inside the chunk;
2. one row per (user, chunk), its length bounded by the span of the log and not by
   the number of clicks: window over the user, giving the state at chunk start;
3. join on (user, chunk), which finds the clicks already partitioned that way.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwise.functions.expressions import SECONDS_PER_DAY
from tillwise.session import durable
from tillwise.streaming.ranges import TASK, brought, in_ranges, pass_over

CHUNK = "_chunk"


def _with_chunk(clicks: DataFrame, ts: str, chunk_seconds: int) -> DataFrame:
    time = F.col(ts)
    return clicks.withColumn(CHUNK, time - F.pmod(time, F.lit(chunk_seconds).cast("long")))


def _break_up(clicks: DataFrame, user: str, ts: str, timeout: int, chunk_seconds: int) -> DataFrame:
    """Add the chunk and ``_piece``: how many gaps longer than ``timeout`` lie before the
    click within its chunk. Rows without user or time are dropped."""
    clicks = clicks.filter(F.col(user).isNotNull() & F.col(ts).isNotNull())
    in_chunk = Window.partitionBy(user, CHUNK).orderBy(ts)
    gap = F.col(ts) - F.lag(ts).over(in_chunk)
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        _with_chunk(clicks, ts, chunk_seconds)
        .withColumn("_break", F.when(gap > timeout, 1).otherwise(0))
        .withColumn("_piece", F.sum("_break").over(so_far))
        .drop("_break")
    )


def sessionize(clicks: DataFrame, *, user: str, ts: str, timeout: int) -> DataFrame:
    """Add ``session_no`` (1, 2, … per user) and ``session_id`` (``user_no``).

    A session ends where the gap to the next click is longer than ``timeout``; a gap of
    exactly ``timeout`` stays inside. Rows without user or time are dropped. The clicks are
    shuffled once, over ranges of (user, time): one user's clicks, of one day even, may fill
    many partitions (see ``ranges``). They are written with their numbers.
    """
    columns = clicks.columns
    ordered = in_ranges(clicks.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()), [user, ts])

    def make():
        left = {"first_ts": None, "first_no": None, "last_ts": None, "last_no": 0}

        def step(batch, starts):
            at = batch.column(ts).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.concatenate(([at[0] if left["last_ts"] is None else left["last_ts"]], at[:-1]))
            opens = starts | (at - before > timeout)
            # Sessions since the user's first click here.
            total = np.cumsum(opens)
            base = np.maximum.accumulate(np.where(starts, total - 1, 0))
            number = total - base + np.where(np.maximum.accumulate(starts), 0, left["last_no"])
            if left["first_ts"] is None:
                left["first_ts"] = int(at[0])
            if left["first_no"] is None and left["last_ts"] is not None and starts[0]:
                left["first_no"] = left["last_no"]
            elif left["first_no"] is None and starts[1:].any():
                left["first_no"] = int(number[np.argmax(starts[1:])])
            left["last_ts"], left["last_no"] = int(at[-1]), int(number[-1])
            return None, [number.astype(np.int64)]

        def leave():
            return left | {"first_no": left["last_no"] if left["first_no"] is None else left["first_no"]}

        return step, leave

    rows, states = pass_over(ordered, user, columns, "_no bigint", make, ["first_ts", "first_no", "last_ts", "last_no"])
    carried, known = [], None
    for s in states:
        offset = 0
        if known is not None and known[0] == s["first"]:
            offset = known[2] - (0 if s["first_ts"] - known[1] > timeout else 1)
        carried.append((s[TASK], offset))
        known = (s["last"], s["last_ts"], s["last_no"] + (offset if s["first"] == s["last"] else 0))
    numbered = brought(rows, carried, "_offset").withColumn("session_no", F.col("_no") + F.coalesce("_offset", F.lit(0)))
    return numbered.withColumn("session_id", F.concat_ws("_", F.col(user), F.col("session_no"))).select(
        *columns, "session_no", "session_id"
    )


def session_totals(
    clicks: DataFrame,
    *,
    user: str,
    ts: str,
    timeout: int,
    partial: list[Column],
    merge: list[Column],
    chunk_seconds: int = SECONDS_PER_DAY,
) -> DataFrame:
    """Aggregates per session: (user, session_no, the merged columns).

    ``partial`` aggregates the clicks of one chunk's part of a session, ``merge`` puts
    the parts together. The clicks are shuffled once and never joined back: sessions
    are numbered on the parts, of which a user has few, whatever the number of clicks.
    """
    parts = (
        _break_up(clicks, user, ts, timeout, chunk_seconds)
        .groupBy(user, CHUNK, "_piece")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *partial)
    )
    per_user = Window.partitionBy(user).orderBy(CHUNK, "_piece")
    before = F.lag("_last").over(per_user)
    opened = F.when(before.isNull() | (F.col("_first") - before > timeout), 1).otherwise(0)
    return (
        parts.withColumn("_opened", opened)
        .withColumn("session_no", F.sum("_opened").over(
            per_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(user, "session_no")
        .agg(*merge)
    )


def seen_in_session_with(
    clicks: DataFrame,
    *,
    user: str,
    ts: str,
    item: str,
    target: int,
    timeout: int,
    chunk_seconds: int = SECONDS_PER_DAY,
) -> DataFrame:
    """(item, cnt): number of sessions that hold both the item and ``target``.

    The clicks are shuffled once. The parts of sessions, with their distinct items (as
    many as a user sees in one chunk), are written to the checkpoint folder; sessions are
    numbered on the parts' times alone, so no user's items meet in one task.
    """
    clicks = clicks.select(user, ts, item).filter(F.col(user).isNotNull() & F.col(item).isNotNull())
    # Sessions belong to one user, so other users' clicks cannot contribute.
    viewers = clicks.filter(F.col(item) == target).select(user).distinct()
    parts = durable(
        _break_up(clicks.join(viewers, user, "left_semi"), user, ts, timeout, chunk_seconds)
        .groupBy(user, CHUNK, "_piece")
        .agg(
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
            F.max(F.col(item) == target).alias("_has"),
            F.collect_set(item).alias("_items"),
        )
    )
    per_user = Window.partitionBy(user).orderBy(CHUNK, "_piece")
    before = F.lag("_last").over(per_user)
    opened = F.when(before.isNull() | (F.col("_first") - before > timeout), 1).otherwise(0)
    so_far = per_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holding = (
        parts.select(user, CHUNK, "_piece", "_first", "_last", "_has")
        .withColumn("_opened", opened)
        .withColumn("session_no", F.sum("_opened").over(so_far))
        .withColumn("_has", F.max("_has").over(Window.partitionBy(user, "session_no")))
        .filter("_has")
        .select(user, CHUNK, "_piece", "session_no")
    )
    return (
        parts.join(holding, [user, CHUNK, "_piece"])
        .select(user, "session_no", F.explode("_items").alias(item))
        .filter(F.col(item) != target)
        .distinct()
        .groupBy(item)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def last_views_before_purchase(
    clicks: DataFrame,
    *,
    user: str,
    ts: str,
    item: str,
    sale: str,
    purchased: int,
    within_seconds: int,
    views: int,
    chunk_seconds: int = SECONDS_PER_DAY,
) -> DataFrame:
    """(purchased_item, lastviewed_item) rows: for each sale of ``purchased``, the
    user's last ``views`` clicks of any kind that are at most ``within_seconds`` old.

    The clicks are shuffled and ordered once; the sales and the last clicks of every chunk
    are written to the checkpoint folder.
    """
    clicks = clicks.select(user, ts, item, sale).filter(
        F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(ts).isNotNull()
    )
    is_purchase = (F.col(item) == purchased) & F.col(sale).isNotNull()
    # Only buyers' clicks matter: keep the others out of the shuffle.
    buyers = clicks.filter(is_purchase).select(user).distinct()
    order = [F.col(ts), F.col(sale), F.col(item)]
    in_chunk = Window.partitionBy(user, CHUNK).orderBy(*order)
    seen = F.struct(F.col(item).alias("item"), F.col(ts).alias("at"))
    local = (
        _with_chunk(clicks.join(buyers, user, "left_semi"), ts, chunk_seconds)
        .withColumn("_row", F.row_number().over(in_chunk))
        .withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(user, CHUNK)))
        .withColumn("_seen", F.collect_list(seen).over(in_chunk.rowsBetween(-views, -1)))
    )

    # The last `views` clicks of every chunk are all that later chunks can see.
    first_kept = F.greatest(F.lit(1), F.col("_rows") - views + 1)
    kept = durable(
        local.select(
            user, CHUNK, ts, item, "_row", first_kept.alias("_from"), is_purchase.alias("_bought"),
            F.when(is_purchase, F.col("_seen")).alias("_seen"),
        ).filter(F.col("_bought") | (F.col("_row") >= F.col("_from")))
    )
    per_user = Window.partitionBy(user).orderBy(CHUNK, "_row").rowsBetween(-views, -1)
    carried = (
        kept.filter(F.col("_row") >= F.col("_from"))
        .select(user, CHUNK, ts, item, "_row", "_from")
        .withColumn("_carry", F.collect_list(seen).over(per_user))
        .filter(F.col("_row") == F.col("_from"))
        .select(user, CHUNK, "_carry")
    )
    return (
        kept.filter("_bought")
        .join(carried, [user, CHUNK])
        .withColumn("_all", F.concat("_carry", "_seen"))
        .withColumn(
            "_view",
            F.explode(
                F.slice("_all", F.greatest(F.lit(1), F.size("_all") - views + 1), views)
            ),
        )
        .filter(F.col("_view.at") >= F.col(ts) - within_seconds)
        .select(F.col(item).alias("purchased_item"), F.col("_view.item").alias("lastviewed_item"))
    )


def _last_cart_page(ts: str, page_type: str, cart: str, order: str) -> Column:
    """Aggregate: the last cart or order page, by time and then by type."""
    page = F.struct(F.col(ts).alias("at"), F.col(page_type).alias("type"))
    return F.max(F.when(F.col(page_type).isin(cart, order), page))


def abandoned_sessions(
    pages: DataFrame,
    *,
    session: list[str],
    ts: str,
    page_type: str,
    cart: str = "dynamic",
    order: str = "order",
) -> DataFrame:
    """``pagecount`` of each session whose last cart page comes after its last order
    page. Pages are ordered by time, then by type."""
    last = _last_cart_page(ts, page_type, cart, order).alias("_last_page")
    return (
        pages.groupBy(*session)
        .agg(F.count(F.lit(1)).alias("pagecount"), last)
        .filter(F.col("_last_page.type") == cart)
        .drop("_last_page")
    )


def abandoned_carts(
    clicks: DataFrame,
    *,
    user: str,
    ts: str,
    page_type: str,
    timeout: int,
    cart: str = "dynamic",
    order: str = "order",
    chunk_seconds: int = SECONDS_PER_DAY,
) -> DataFrame:
    """``abandoned_sessions`` straight from the clicks: (user, session_no, pagecount)."""
    sessions = session_totals(
        clicks,
        user=user,
        ts=ts,
        timeout=timeout,
        partial=[
            F.count(F.lit(1)).alias("pages"),
            _last_cart_page(ts, page_type, cart, order).alias("_last_page"),
        ],
        merge=[F.sum("pages").alias("pagecount"), F.max("_last_page").alias("_last_page")],
        chunk_seconds=chunk_seconds,
    )
    return sessions.filter(F.col("_last_page.type") == cart).drop("_last_page")


def _is(column: str, value: str) -> Column:
    return F.col(column).eqNullSafe(F.lit(value))


def sales_after_page(
    clicks: DataFrame,
    *,
    user: str,
    ts: str,
    sale: str,
    page_type: str,
    wanted: str,
    within_seconds: int,
) -> DataFrame:
    """Distinct sales made at most ``within_seconds`` after the user's latest click
    on a ``wanted`` page. A click on such a page never counts as a sale itself. The clicks are
    shuffled once, over ranges of (user, time), and sales written with that latest click."""
    relevant = clicks.filter(
        F.col(user).isNotNull() & F.col(ts).isNotNull() & (_is(page_type, wanted) | F.col(sale).isNotNull())
    ).select(user, ts, sale, page_type, _is(page_type, wanted).alias("_page"))
    ordered = in_ranges(relevant, [user, ts, sale, page_type])
    never = np.iinfo(np.int64).min

    def make():
        left = {"first_latest": None, "last_latest": never}

        def step(batch, starts):
            at = batch.column(ts).to_numpy(zero_copy_only=False).astype(np.int64)
            page = batch.column("_page").to_numpy(zero_copy_only=False)
            # The latest page so far: times grow within a user, so its row is the latest one.
            place = np.arange(len(at))
            here = np.maximum.accumulate(np.where(page, place, -1))
            start = np.maximum.accumulate(np.where(starts, place, -1))
            latest = np.where(here >= np.maximum(start, 0), at[np.maximum(here, 0)], never)
            latest = np.where((here < 0) & (start < 0), left["last_latest"], latest)
            if left["first_latest"] is None and "seen" in left and starts[0]:
                left["first_latest"] = left["last_latest"]
            elif left["first_latest"] is None and starts[1:].any():
                left["first_latest"] = int(latest[np.argmax(starts[1:])])
            left["last_latest"], left["seen"] = int(latest[-1]), 1
            return ~page, [latest]

        def leave():
            return left | {"first_latest": left["last_latest"] if left["first_latest"] is None else left["first_latest"]}

        return step, leave

    rows, states = pass_over(ordered, user, [ts, sale], "_latest bigint", make, ["first_latest", "last_latest"])
    carried, known = [], (None, never)
    for s in states:
        before = known[1] if known[0] == s["first"] else never
        carried.append((s[TASK], before))
        known = (s["last"], max(s["last_latest"], before) if s["first"] == s["last"] else s["last_latest"])
    latest = F.greatest("_latest", F.coalesce("_before", F.lit(never)))
    return (
        brought(rows, carried, "_before")
        .filter((latest > never) & (F.col(ts) - latest <= within_seconds))
        .select(sale)
        .distinct()
    )
