"""Null policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def apply_null_policy(
    df: DataFrame,
    required: Sequence[str] = (),
    zero_fill: Sequence[str] = (),
    text_fill: str | None = None,
) -> DataFrame:
    """Drop rows without the required values, then fill numbers, then texts.

    NaN counts as missing in both the drop and the numeric fill.
    """
    if required:
        df = df.na.drop(subset=list(required))
    if zero_fill:
        df = df.na.fill(0.0, subset=list(zero_fill))
    if text_fill is not None:
        df = df.na.fill(text_fill)
    return df
