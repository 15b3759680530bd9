"""Zero-filled pivots with known output columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.values import as_column, field
from feedmill.operators.counting import on_domain


def pivot_counts(
    df: DataFrame,
    key: str,
    by: Column | str,
    columns: Mapping[str, object],
    count: str | None = None,
    domain: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key and one count per listed value of ``by``; no cell is null.

    ``columns`` maps output names to values; other values are left out but
    their key stays. ``count`` names a column of ready counts (a mart), without
    it rows are counted. ``domain`` fixes the keys: entries without rows appear
    with zeros, keys outside it are left out.
    """
    if domain is not None:
        df = df.where(field(key).isin(list(domain)))
    weight = F.lit(1) if count is None else field(count)
    weight = weight.cast("bigint")
    side = as_column(by)
    # Sums over conditions rather than pivot(): same single shuffle of the keys
    # with partial sums, no null key trouble and output names of our choice.
    cells = [
        F.sum(F.when(side == F.lit(value), weight).otherwise(F.lit(0).cast("bigint"))).alias(name)
        for name, value in columns.items()
    ]
    wide = df.groupBy(field(key)).agg(*cells)
    if domain is None:
        return wide
    return on_domain(wide, key, domain).na.fill(0, subset=list(columns))
