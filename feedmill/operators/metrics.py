"""Classifier quality as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.values import as_column, field

METRICS = ["rows", "accuracy", "weighted_precision", "weighted_recall"]
# Blocks of scores per model, a power of two.
SCORE_BLOCKS = 1 << 10


def positive_score(raw: str = "rawPrediction") -> Column:
    """The score of class 1 out of a model's raw prediction vector."""
    return F.get(vector_to_array(field(raw)), F.lit(1))


def class_metrics(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """rows, accuracy, weighted precision and weighted recall: one row, or one per value of ``by``.

    One aggregate over the scored rows gives the confusion counts; the rest
    works on one row per pair of classes. Rows without a label are left out.
    """
    groups = [field(name) for name in by]
    cells = scored.where(field(label).isNotNull()).groupBy(
        *groups, field(label).cast("double").alias("_label"), field(prediction).cast("double").alias("_prediction")
    ).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_label") == F.col("_prediction"), F.col("_n")).otherwise(F.lit(0))

    def side(name: str, actual: Column, predicted: Column, hits: Column) -> Column:
        parts = {"_actual": actual, "_predicted": predicted, "_hits": hits}
        return F.struct(F.col(name).alias("_class"), *[part.cast("bigint").alias(key) for key, part in parts.items()])

    none = F.lit(0)
    sides = F.array(side("_label", F.col("_n"), none, hit), side("_prediction", none, F.col("_n"), none))
    classes = (
        cells.select(*groups, F.inline(sides))
        .groupBy(*groups, "_class")
        .agg(*[F.sum(name).alias(name) for name in ("_actual", "_predicted", "_hits")])
    )
    total = F.sum("_actual")
    precision = F.when(F.col("_predicted") > 0, F.col("_hits") / F.col("_predicted")).otherwise(0.0)
    recall = F.when(F.col("_actual") > 0, F.col("_hits") / F.col("_actual")).otherwise(0.0)
    return classes.groupBy(*groups).agg(
        total.alias("rows"),
        F.try_divide(F.sum("_hits"), total).alias("accuracy"),
        F.try_divide(F.sum(precision * F.col("_actual")), total).alias("weighted_precision"),
        F.try_divide(F.sum(recall * F.col("_actual")), total).alias("weighted_recall"),
    )


def as_map(frame: DataFrame, keys: Sequence[str], value: str) -> Column:
    """A small table as one map, for all rows of another: a scalar subquery in place of a join."""
    entry = F.struct(F.struct(*[field(key) for key in keys]).alias("key"), field(value).alias("value"))
    return frame.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def score_block(edges: str = "_edges", score: str = "_score") -> Column:
    """How many of the sorted edges lie below the score, by halving."""
    steps = F.array(*[F.lit(SCORE_BLOCKS >> bit) for bit in range(1, SCORE_BLOCKS.bit_length())])
    start = F.struct(F.lit(0).alias("at"), F.col(edges).alias("edges"))

    def halve(state: Column, step: Column) -> Column:
        at = state["at"]
        moved = at + F.when(F.get(state["edges"], at + step - 1) < F.col(score), step).otherwise(F.lit(0))
        return F.struct(moved.alias("at"), state["edges"].alias("edges"))

    return F.aggregate(steps, start, halve, lambda state: state["at"])


def area_under_roc(scored: DataFrame, score: Column | str, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """``auc``, the exact area under the ROC curve with ties counted half: one row, or one per value of ``by``.

    Rows first combine per distinct score, which takes care of hot scores. Quantiles of
    these cut them into blocks; each block counts the pairs it holds itself, and the
    negatives of all earlier blocks are added per block. So the scores are shuffled twice, whatever
    the number of groups; quantiles and blocks are a bounded number of rows per group.
    Rows without a label, and rows whose score is null or NaN, are left out.
    """
    groups = [field(name) for name in by]
    positive = F.count_if(field(label) == 1)
    ranked = scored.select(*groups, as_column(score).cast("double").alias("_score"), field(label))
    ranked = ranked.where(field(label).isNotNull() & F.col("_score").isNotNull() & ~F.isnan("_score"))
    per_score = ranked.groupBy(*groups, "_score").agg(
        positive.alias("_pos"), (F.count(F.lit(1)) - positive).alias("_neg")
    )
    quantiles = F.percentile_approx("_score", [place / SCORE_BLOCKS for place in range(1, SCORE_BLOCKS)])
    sketches = per_score.groupBy(*groups).agg(quantiles.alias("_edges"))
    if by:
        edges = F.try_element_at(as_map(sketches, by, "_edges"), F.struct(*groups))
    else:
        edges = sketches.scalar()
    # A column of its own, since a lambda function takes no subquery.
    blocks = per_score.withColumn("_edges", edges).withColumn("_block", score_block())
    lower = Window.partitionBy(*groups, "_block").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("_pos") * (F.coalesce(F.sum("_neg").over(lower), F.lit(0)) + F.col("_neg") / 2)
    per_block = (
        blocks.select(*groups, "_block", "_pos", "_neg", won.cast("double").alias("_won"))
        .groupBy(*groups, "_block")
        .agg(*[F.sum(name).alias(name) for name in ("_pos", "_neg", "_won")])
    )
    # At most SCORE_BLOCKS rows per group.
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    with_earlier = per_block.withColumn("_before", F.coalesce(F.sum("_neg").over(earlier), F.lit(0)))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    wins = F.sum(F.col("_won") + F.col("_pos").cast("double") * F.col("_before"))
    return with_earlier.groupBy(*groups).agg(F.try_divide(wins, pairs).alias("auc"))


def model_report(scored: DataFrame, model: str, label: str = "label", prediction: str = "prediction",
                 score: Column | str = "score") -> DataFrame:
    """One row of one model: name, rows, accuracy, precision, recall and area under ROC."""
    auc = area_under_roc(scored, score, label).scalar()
    return class_metrics(scored, label, prediction).select(F.lit(model).alias("model"), "*", auc.alias("auc"))


def model_reports(scored: DataFrame, by: str = "model", label: str = "label", prediction: str = "prediction",
                  score: Column | str = "score") -> DataFrame:
    """A report row per model of a table that holds the scored rows of all, each with its model's name in ``by``.

    Two scans and the same number of shuffles whatever the number of models.
    """
    areas = as_map(area_under_roc(scored, score, label, [by]), [by], "auc")
    return class_metrics(scored, label, prediction, [by]).select(
        field(by).alias("model"), *METRICS, F.try_element_at(areas, F.struct(field(by))).alias("auc")
    )
