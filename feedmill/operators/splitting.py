"""Training and holdout rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.functions.values import as_column, field

BUCKETS = 10_000


def key_bucket(key: Column | str, seed: int = fixed.SPLIT_SEED, buckets: int = BUCKETS) -> Column:
    """A number in [0, buckets) that depends on the key and the seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), as_column(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def row_key(df: DataFrame) -> Column:
    """A number that follows from the values of the row."""
    return F.xxhash64(*[field(name) for name in df.columns])


def split_rows(
    df: DataFrame,
    weights: Sequence[float] = tuple(fixed.SPLIT_WEIGHTS),
    seed: int = fixed.SPLIT_SEED,
    key: Column | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) by weight.

    With a row key the side follows from the key, whatever the file layout,
    as a plain filter without a shuffle or sort. Without a key Spark's
    ``randomSplit`` draws rows; its result depends on the partitioning.
    """
    if key is None:
        train, holdout = df.randomSplit(list(weights), seed=seed)
        return train, holdout
    edge = round(BUCKETS * weights[0] / sum(weights))
    bucket = key_bucket(key, seed)
    return df.where(bucket < edge), df.where(bucket >= edge)
