"""Column expressions shared by the operators. All of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def virtual_seconds(day: Column, second: Column) -> Column:
    """One 64-bit event time out of a day serial and a second of the day."""
    return day.cast("long") * F.lit(SECONDS_PER_DAY).cast("long") + second


def day_offset(date_text: Column, anchor: str) -> Column:
    """Whole days from ``anchor`` to an ISO date string."""
    return F.datediff(F.to_date(date_text), F.to_date(F.lit(anchor)))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero divisor, also under ANSI mode."""
    return F.try_divide(numerator, denominator)


def make_pairs(items: Column) -> Column:
    """All (left, right) pairs of an array, left standing before right."""
    return F.flatten(
        F.transform(
            items,
            lambda left, at: F.transform(
                F.slice(items, at + 2, F.size(items)),
                lambda right: F.struct(left.alias("left"), right.alias("right")),
            ),
        )
    )
