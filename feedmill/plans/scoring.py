"""What both training plans share: score once, then report and results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators.metrics import model_reports, positive_score
from feedmill.sources.scratch import stage


@dataclass(frozen=True)
class Trained:
    """Fitted models, one report row per model, and the result table."""

    models: dict[str, Model] = field(repr=False)
    report: DataFrame
    results: DataFrame


def score_rows(model: Model, rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The result columns and the score of class 1, computed once and staged.

    The report reads the scores twice and the result table once; none of
    them runs the model again.
    """
    inputs = [column for column in columns if column != "prediction"]
    scored = model.transform(rows.select(*inputs, "features"))
    return stage(scored.select(*columns, positive_score().alias("score")), f"scored-{name}")


def report_on(scored: dict[str, DataFrame]) -> DataFrame:
    """One quality row per model, all of them out of one evaluation."""
    rows = [
        frame.select(F.lit(name).alias("model"), "label", "prediction", "score") for name, frame in scored.items()
    ]
    return model_reports(reduce(DataFrame.unionByName, rows))
