"""The first n rows in an order, on tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.values import field, unused
from feedmill.operators.ordinals import with_ordinals
from feedmill.sources.scratch import stage

# So few rows of every task meet in one task; for more, the last row to take is looked up first.
TAKEN_ROWS = 1_000


def ordered_cap(df: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``rows`` rows by ascending ``order_by`` columns, nulls first, in that order.

    Up to ``TAKEN_ROWS`` rows, every task keeps its first ones and one task merges them. For
    more, the order columns alone are numbered by range blocks, which gives the order values of the last row to take;
    a filter keeps the rows before it, and of rows that tie with it as many as are missing.
    They are sorted in ranges, so no task takes more than a block.
    """
    order = [field(name) for name in order_by]
    if rows <= TAKEN_ROWS:
        return df.orderBy(*order).limit(rows)
    number, bounds = unused(df, "_number"), [unused(df, f"_bound{place}") for place in range(len(order))]
    values = df.select(*[column.alias(bound) for column, bound in zip(order, bounds)])
    numbered = with_ordinals(values, bounds, number)
    last = stage(numbered.where(F.col(number) == rows - 1).select(*bounds), "cap-bound")
    if last.isEmpty():
        return df.orderBy(*order)
    names = [unused(values, f"_value{place}") for place in range(len(order))]
    tied = numbered.toDF(*names, number).join(F.broadcast(last), equal(names, bounds))  # one row
    missing = rows - tied.agg(F.min(number).alias("first")).first()["first"]
    bounded = df.join(F.broadcast(last))
    before = bounded.where(lower(order, bounds)).drop(*bounds)
    at = bounded.where(equal(order_by, bounds)).drop(*bounds)
    if missing > TAKEN_ROWS:
        at = with_ordinals(at, order, number).where(F.col(number) < missing).drop(number)
    else:
        at = at.limit(missing)
    return before.unionByName(at).orderBy(*order)


def equal(names: Sequence[str], bounds: Sequence[str]) -> Column:
    """Whether all columns have the bounds' values."""
    met = F.lit(True)
    for name, bound in zip(names, bounds):
        met &= field(name).eqNullSafe(field(bound))
    return met


def lower(order: Sequence[Column], bounds: Sequence[str]) -> Column:
    """Whether a row comes before the bounds: by the first column that differs, nulls first."""
    before, same = F.lit(False), F.lit(True)
    for column, bound in zip(order, bounds):
        less = F.coalesce(column < field(bound), column.isNull() & field(bound).isNotNull())
        before |= same & less
        same &= column.eqNullSafe(field(bound))
    return before
