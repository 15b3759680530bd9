"""Loans: bronze to silver to gold to scored results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.functions.encoding import decode_json, text_schema
from feedmill.functions.values import label_unless, lenient_double
from feedmill.operators.cleaning import apply_null_policy
from feedmill.operators.features import add_features
from feedmill.operators.models import fit_forest, fit_logistic, kept_for_training, training_partitions
from feedmill.operators.splitting import row_key, split_rows
from feedmill.operators.weighting import with_class_weight
from feedmill.plans.scoring import Trained, report_on, score_rows
from feedmill.sources.tables import read_table, replace_table
from feedmill.streaming.ingest import bronze_table


def silver(bronze: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Settled loans with a label, numbers as doubles and no nulls.

    With ``columns`` only these fields, the status and the required numbers are
    parsed and returned.
    """
    wanted = {*(fixed.LOAN_FIELDS if columns is None else columns), "loan_status", *fixed.LOAN_REQUIRED}
    numeric = [name for name in fixed.LOAN_NUMERIC if name in wanted]
    rows = decode_json(bronze, text_schema([name for name in fixed.LOAN_FIELDS if name in wanted]))
    settled = rows.where(F.col("loan_status").isin(fixed.LOAN_STATUS_PAID, fixed.LOAN_STATUS_LOST))
    typed = settled.withColumns(
        {
            "label": label_unless("loan_status", fixed.LOAN_STATUS_PAID),
            **{name: lenient_double(name) for name in numeric},
        }
    )
    return apply_null_policy(typed, fixed.LOAN_REQUIRED, numeric, fixed.MISSING_TEXT)


def gold(silver_rows: DataFrame, fit_rows: DataFrame | None = None) -> DataFrame:
    """Class weight, category indexes and the scaled feature vector.

    Weight, indexes and scale come from all silver rows. Pass the training
    rows as ``fit_rows`` to keep the holdout out of them.
    """
    weighted = with_class_weight(silver_rows, fit_rows=fit_rows)
    featured, _ = add_features(weighted, fixed.LOAN_NUMERIC, fixed.LOAN_CATEGORICAL, scale=True, fit_rows=fit_rows)
    return featured


def train_and_score(
    gold_rows: DataFrame, key: Column | str | None = None, result_model: str = "logistic", parallelism: int = 2,
    partitions: int | None = None, **forest: int,
) -> Trained:
    """Fit a forest and a cross-validated logistic regression, report on both.

    Results come from the logistic regression unless ``result_model`` says
    ``forest``. With a row ``key`` the split does not depend on file layout.
    Further arguments are settings of the forest.
    """
    train, holdout = split_rows(gold_rows, key=key)
    with kept_for_training(train, "label", "features", "classWeight", partitions=partitions) as rows:
        models = {"forest": fit_forest(rows, **forest), "logistic": fit_logistic(rows, parallelism=parallelism)}
    scored = {name: score_rows(model, holdout, fixed.LOAN_RESULT_COLUMNS, name) for name, model in models.items()}
    results = scored[result_model].select(*fixed.LOAN_RESULT_COLUMNS)
    return Trained(models, report_on(scored), results)


def run(spark: SparkSession, base: str, fmt: str = "parquet", fit_all: bool = False, **training) -> Trained:
    """Bronze under ``base`` to the silver, gold and results tables beside it.

    A hash of the silver row splits the rows before anything is fitted; weight,
    indexes and scale come from the training rows, or from all with ``fit_all``.
    ``training`` goes to ``train_and_score``.
    """
    training["partitions"] = training_partitions(spark, training.get("partitions"))
    bronze = bronze_table(spark, f"{base}/loan_bronze", fmt, ledger=f"{base}/loan_ledger")
    replace_table(silver(bronze), f"{base}/loan_silver", fmt)
    rows = read_table(spark, f"{base}/loan_silver", fmt)
    key = row_key(rows)
    replace_table(gold(rows, None if fit_all else split_rows(rows, key=key)[0]), f"{base}/loan_gold", fmt)
    trained = train_and_score(read_table(spark, f"{base}/loan_gold", fmt), key=key, **training)
    replace_table(trained.results, f"{base}/loan_results", fmt)
    return trained
