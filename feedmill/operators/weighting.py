"""Class balance weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.values import field


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: total, positives, and negatives per positive.

    A table without positives has no weight; evaluating it is an error.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(field(label) == 1).alias("positives"),
    )
    ratio = F.when(
        F.col("positives") == 0, F.raise_error(F.lit("class weight: no rows with label 1"))
    ).otherwise((F.col("total") - F.col("positives")) / F.col("positives"))
    return counts.select("total", "positives", ratio.cast("double").alias("ratio"))


def with_class_weight(df: DataFrame, label: str = "label", name: str = "classWeight", fit_rows: DataFrame | None = None) -> DataFrame:
    """Weight the positives so that both classes count the same.

    The ratio is a scalar subquery over the label column alone: one narrow
    aggregate, no join, nothing through the driver's Python. ``fit_rows``
    takes it from other rows, such as the training part.
    """
    ratio = class_balance(df if fit_rows is None else fit_rows, label).select("ratio").scalar()
    return df.withColumn(name, F.when(field(label) == 1, ratio).otherwise(F.lit(1.0)))
