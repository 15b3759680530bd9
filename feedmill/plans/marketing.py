"""Marketing contacts: bronze to silver to gold to scored results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from feedmill import fixed_values as fixed
from feedmill.functions.encoding import decode_json, line_fields, only_value, sampled_schema
from feedmill.functions.values import field, label_if, lenient_double
from feedmill.operators.cleaning import apply_null_policy
from feedmill.operators.features import add_features
from feedmill.operators.models import fit_forest, kept_for_training, training_partitions
from feedmill.operators.splitting import row_key, split_rows
from feedmill.plans.scoring import Trained, report_on, score_rows
from feedmill.sources.tables import read_table, replace_table
from feedmill.streaming.ingest import bronze_table


def silver(bronze: DataFrame, schema_from_first_row: bool = False) -> DataFrame:
    """Contacts unpacked from lines, with a label; only age and job must be there.

    The JSON holds one field, named by a whole header line, and each row may
    have another name for it. With ``schema_from_first_row`` one row's name
    stands for the whole table, and rows under other names are lost.
    """
    lines = decode_json(bronze, sampled_schema(bronze)) if schema_from_first_row else only_value(bronze)
    contacts = lines.select(*line_fields(field(lines.columns[0]).cast("string"), fixed.MARKETING_FIELDS))
    typed = contacts.withColumns({name: lenient_double(name) for name in fixed.MARKETING_NUMERIC})
    return apply_null_policy(typed, fixed.MARKETING_REQUIRED).withColumn(
        "label", label_if("y", fixed.MARKETING_POSITIVE)
    )


def gold(silver_rows: DataFrame, fit_rows: DataFrame | None = None) -> DataFrame:
    """Category indexes and the feature vector; rows without all numbers are left out."""
    featured, _ = add_features(
        silver_rows, fixed.MARKETING_NUMERIC, fixed.MARKETING_CATEGORICAL, scale=False, fit_rows=fit_rows
    )
    return featured


def train_and_score(
    gold_rows: DataFrame, key: Column | str | None = None, partitions: int | None = None, **forest: int
) -> Trained:
    """Fit a forest on the training rows, score and report on the holdout.

    Further arguments are settings of the forest, such as ``maxBins`` where a
    category has more than 32 values.
    """
    train, holdout = split_rows(gold_rows, key=key)
    with kept_for_training(train, "label", "features", partitions=partitions) as rows:
        model = fit_forest(rows, **forest)
    scored = score_rows(model, holdout, fixed.MARKETING_RESULT_COLUMNS, "marketing-forest")
    return Trained({"forest": model}, report_on({"forest": scored}), scored.select(*fixed.MARKETING_RESULT_COLUMNS))


def run(
    spark: SparkSession, base: str, fmt: str = "parquet", fit_all: bool = False, schema_from_first_row: bool = False, **training
) -> Trained:
    """Bronze under ``base`` to the silver, gold and results tables beside it.

    A hash of the silver row splits the rows before anything is fitted; indexes
    come from the training rows, or from all with ``fit_all``. ``training`` goes to ``train_and_score``.
    """
    training["partitions"] = training_partitions(spark, training.get("partitions"))
    bronze = bronze_table(spark, f"{base}/mkt_bronze", fmt, ledger=f"{base}/mkt_ledger")
    replace_table(silver(bronze, schema_from_first_row), f"{base}/mkt_silver", fmt)
    rows = read_table(spark, f"{base}/mkt_silver", fmt)
    key = row_key(rows)
    replace_table(gold(rows, None if fit_all else split_rows(rows, key=key)[0]), f"{base}/mkt_gold", fmt)
    trained = train_and_score(read_table(spark, f"{base}/mkt_gold", fmt), key=key, **training)
    replace_table(trained.results, f"{base}/marketing_results", fmt)
    return trained
