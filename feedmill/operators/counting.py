"""Grouped counts and fixed-width histograms.

Each is a partial count on the map side, one shuffle of the distinct keys and
a final count, so a key that holds a third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.functions.values import bucket_floor, field


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per combination of the keys."""
    return df.groupBy(*[field(key) for key in keys]).agg(F.count(F.lit(1)).alias("count"))


def histogram(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    width: int = fixed.BALANCE_WIDTH,
    name: str = "balance_range",
) -> DataFrame:
    """Rows per bucket of ``value`` and further keys; the bucket is text."""
    keys = [bucket_floor(value, width).alias(name), *[field(key) for key in by]]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def sum_counts(df: DataFrame, group, name: str, domain: Sequence[str], count: str = "count") -> DataFrame:
    """Sum a mart's counts into a fixed list of groups; empty groups give 0."""
    sums = (
        df.groupBy(group.alias(name))
        .agg(F.sum(F.col(count).cast("bigint")).alias("_sum"))
        .where(F.col(name).isin(list(domain)))
    )
    return on_domain(sums, name, domain).select(name, F.coalesce("_sum", F.lit(0).cast("bigint")).alias("count"))


def on_domain(df: DataFrame, key: str, domain: Sequence[str]) -> DataFrame:
    """One row per entry of a fixed list, joined to the frame's row for it.

    The frame has at most one row per entry, so the broadcast side is never
    longer than the list.
    """
    spark = df.sparkSession
    entries = spark.range(1).select(F.explode(F.array(*[F.lit(entry) for entry in domain])).alias(key))
    return entries.join(F.broadcast(df), key, "left")
