"""Ordered passes over range partitions.

Rows are sorted by (user, time) over range partitions, one shuffle in all; a user with a third
of all rows fills many of them, whatever the time span. Each task carries its state along its
own rows and leaves one row that says what came in and what goes out. These rows, one a
partition, are put together on the driver, in order; what a partition's first user brings
along from partitions before is a column of a broadcast table with one row a partition.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import durable

TASK = "_task"


def in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """Sorted over range partitions, with the partition's number. One exchange."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(TASK, F.spark_partition_id())


def user_starts(user: np.ndarray, before) -> np.ndarray:
    """Where a row's user differs from that of the row before (``before``: of the batch before, or
    None)."""
    starts = np.ones(len(user), bool)
    starts[1:] = user[1:] != user[:-1]
    if before is not None:
        starts[0] = user[0] != before
    return starts


def pass_over(
    ordered: DataFrame, user: str, keep: list[str], extra: str, make: Callable, state: list[str]
) -> tuple[DataFrame, list]:
    """Run ``make()``, once per partition, over the batches of ``ordered``.

    ``make()`` gives ``step(batch, starts) -> (mask or None, extra columns)`` and ``leave() -> dict``
    of numbers named by ``state``, for the partition's first and last user. The written rows
    (the columns ``keep``, the extra ones, TASK, and ``_lead``, true for rows of the partition's first
    user) come with the states: (task, first user, last user, the numbers), in order.
    """
    kind = {f.name: f.dataType.simpleString() for f in ordered.schema}
    numbers = ", ".join(f"{s}: bigint" for s in state)
    schema = ", ".join(
        [f"`{c}` {kind[c]}" for c in keep]
        + [extra, f"{TASK} int", "_lead boolean", f"_state struct<first: {kind[user]}, last: {kind[user]}, {numbers}>"]
    )

    def run(batches):
        step, leave = make()
        before = first = None
        leading = True
        for batch in batches:
            if not batch.num_rows:
                continue
            users = batch.column(user).to_numpy(zero_copy_only=False)
            starts = user_starts(users, before)
            if before is None:
                first, task, sample = users[0], batch.column(TASK)[0].as_py(), batch.slice(0, 1)
            lead = leading & (np.cumsum(starts) - starts[0] == 0) & (users[0] == first)
            leading, before = bool(lead[-1]), users[-1]
            mask, columns = step(batch, starts)
            arrays = [batch.column(c) for c in keep] + [pa.array(c) for c in columns]
            arrays += [batch.column(TASK), pa.array(lead), pa.nulls(batch.num_rows, state_type(batch))]
            out = pa.RecordBatch.from_arrays(arrays, names=names)
            yield out if mask is None else out.filter(pa.array(mask))
        if before is not None:
            numbers = leave()
            left = {"first": _plain(first), "last": _plain(before), **{s: numbers[s] for s in state}}
            arrays = [sample.column(c) for c in keep] + [pa.nulls(1, t) for t in extra_types]
            arrays += [pa.array([task], pa.int32()), pa.array([False]), pa.array([left], state_type(sample))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def state_type(batch):
        own = batch.schema.field(user).type
        return pa.struct([("first", own), ("last", own)] + [(s, pa.int64()) for s in state])

    extra_names = [c.split()[0] for c in extra.split(", ")]
    extra_types = [pa.int64()] * len(extra_names)
    names = [*keep, *extra_names, TASK, "_lead", "_state"]
    written = durable(ordered.mapInArrow(run, schema))
    states = written.filter("_state IS NOT NULL").select(TASK, "_state.*").orderBy(TASK).collect()
    return written.filter("_state IS NULL").drop("_state"), states


def _plain(value):
    return value.item() if hasattr(value, "item") else value


def brought(rows: DataFrame, carried: list[tuple[int, int | None]], name: str) -> DataFrame:
    """Add ``name``: what the first user of a row's partition brings along; null elsewhere."""
    table = rows.sparkSession.createDataFrame(carried, f"{TASK} int, `{name}` bigint")
    lead = F.when(F.col("_lead"), F.col(TASK))
    return rows.withColumn(TASK, lead).join(F.broadcast(table), TASK, "left").drop(TASK, "_lead")
