"""Classifiers. MLlib spreads the training rows; the driver holds the model only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from feedmill import fixed_values as fixed
from feedmill.functions.values import field
from feedmill.operators.metrics import area_under_roc, positive_score
from feedmill.operators.splitting import key_bucket
from feedmill.sources.scratch import new_path

# Fitted models follow the partitions of their rows, so their number is fixed on one machine;
# a cluster's table may not fit so few tasks, so there the number must be given.
TRAINING_PARTITIONS = 16
# Rows of a partition where the number follows from the table.
TRAINING_ROWS = 250_000


def training_partitions(spark: SparkSession, given: int | None) -> int:
    """The number given, or the fixed one of a local session."""
    if given is not None:
        return given
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("say into how many partitions the training rows go: models depend on it, and each must fit a task")
    return TRAINING_PARTITIONS


def partitions_by_rows(rows: DataFrame) -> int:
    """A number of partitions that the rows of a written table alone decide, the same on one machine and on a cluster."""
    return max(TRAINING_PARTITIONS, -(-rows.count() // TRAINING_ROWS))


@contextmanager
def kept_for_training(train: DataFrame, *columns: str, partitions: int | None = None):
    """The training columns, held in memory and on disk while models are fitted.

    Rows are dealt out and ordered by a hash of their values, so that the same
    rows give the same model from any file layout, at any size and on any number of cores.
    """
    partitions = training_partitions(train.sparkSession, partitions)
    rows = train.select(*columns)
    values = [vector_to_array(field(name)) if isinstance(rows.schema[name].dataType, VectorUDT) else field(name) for name in columns]
    place = F.xxhash64(*values)
    kept = rows.repartition(partitions, place).sortWithinPartitions(place).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def without_summary(spark: SparkSession, model: Model) -> Model:
    """The fitted model, saved and loaded.

    A fitted model has a training summary that holds the session, and goes to the tasks with it;
    a session that has used an ``Observation`` cannot go there, a loaded model always can.
    """
    path = new_path(spark, "model")
    model.save(path)
    return type(model).load(path)


def fit_forest(
    train: DataFrame, trees: int = fixed.FOREST_TREES, seed: int = fixed.SPLIT_SEED, **params
) -> RandomForestClassificationModel:
    """Random forest; depth 5 and 32 bins unless given."""
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, seed=seed, **params)
    return without_summary(train.sparkSession, forest.fit(train))


def fold_number(rows: DataFrame, folds: int, seed: int = fixed.SPLIT_SEED, key: Column | None = None) -> Column:
    """The fold of a row, from its key or else its values alone; equal rows share a fold."""
    values = [vector_to_array(field(part.name)) if isinstance(part.dataType, VectorUDT) else field(part.name) for part in rows.schema]
    return key_bucket(F.xxhash64(*values) if key is None else key, seed, folds)


def at_once[Item, Result](
    spark: SparkSession, task: Callable[[Item], Result], items: Sequence[Item], parallelism: int
) -> list[Result]:
    """What the task makes of each item, in order; so many run at once, with the local properties of the caller.

    A pool of ``multiprocessing`` would need semaphores, which some machines do not grant. Where
    Python threads have no JVM threads of their own (``PYSPARK_PIN_THREAD``), there are no
    properties to hand on, and ``inheritable_thread_target`` returns what it got.
    """
    workers = min(parallelism, len(items))
    if workers < 2:
        return [task(item) for item in items]
    handed_on = inheritable_thread_target(spark)
    target = task if handed_on is spark else handed_on(task)
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(target, items))


def fit_logistic(
    train: DataFrame,
    weight: str | None = "classWeight",
    reg_params: Sequence[float] = tuple(fixed.LOGIT_REG_PARAMS),
    folds: int = fixed.LOGIT_FOLDS,
    seed: int = fixed.SPLIT_SEED,
    parallelism: int = 2,
) -> LogisticRegressionModel:
    """Logistic regression, its regularization chosen by exact area under ROC over folds.

    A row's fold is a hash of its values, so the choice does not follow the layout of the
    files, and a fold is a filter on the rows: no copy of it is kept. All settings and folds are
    evaluated together. A fold without both
    classes has no area and no say; of equal settings the first is taken. The
    best setting is fitted again on all rows.
    """
    columns = ["label", "features", *([weight] if weight else [])]
    rows = train.select(*columns)
    number = fold_number(rows, folds, seed)
    settings = dict.fromkeys(reg_params)

    def fitted(reg_param: float, part: DataFrame) -> LogisticRegressionModel:
        logistic = LogisticRegression(featuresCol="features", labelCol="label", regParam=reg_param)
        model = (logistic.setWeightCol(weight) if weight else logistic).fit(part)
        return without_summary(train.sparkSession, model)

    def scores(task: tuple[float, int]) -> DataFrame:
        reg_param, fold = task
        model = fitted(reg_param, rows.where(number != fold))
        scored = model.transform(rows.where(number == fold)).select("label", positive_score().alias("score"))
        return scored.select(F.lit(reg_param).alias("setting"), F.lit(fold).alias("fold"), "*")

    tasks = [(reg_param, fold) for reg_param in settings for fold in range(folds)] if len(settings) > 1 else []
    scored = at_once(train.sparkSession, scores, tasks, parallelism)
    areas = area_under_roc(reduce(DataFrame.unionByName, scored), "score", by=["setting", "fold"]).collect() if tasks else []
    for reg_param in settings:
        own = [row["auc"] for row in areas if row["setting"] == reg_param and row["auc"] is not None]
        settings[reg_param] = sum(own) / len(own) if own else 0.0
    return fitted(max(settings, key=settings.get), rows)
