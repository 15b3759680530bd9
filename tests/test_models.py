import random
from types import SimpleNamespace

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.operators import features
from feedmill.operators.features import add_features, category_counts, category_places, with_places
from feedmill.operators import metrics, models as training
from feedmill.operators.metrics import area_under_roc, class_metrics, model_report, model_reports
from feedmill.operators.models import TRAINING_PARTITIONS, at_once, fit_forest, fit_logistic, fold_number, kept_for_training, partitions_by_rows, training_partitions
from feedmill.plans import loan, marketing
from workloads import catalog


def attribute_kinds(frame):
    return frame.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})


def test_category_index_order(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string").withColumn("n", F.lit(1.0))
    indexed, _ = add_features(rows, ["n"], ["v"])
    assert {row["v"]: row["v_idx"] for row in indexed.collect()} == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}


def test_rare_labels_get_the_same_index_as_frequent_ones(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["hot", "hot", None, f"v{draw.randrange(40)}"]), float(place)) for place in range(800)]
    frame = spark.createDataFrame(rows, "v string, n double")
    narrow, wide = [add_features(frame, ["n"], ["v"], hot_labels=hot)[0] for hot in (10_000, 2)]
    assert attribute_kinds(narrow) == attribute_kinds(wide) and "nominal" in attribute_kinds(wide)
    narrow, wide = [{(row["n"], row["v_idx"]) for row in found.collect()} for found in (narrow, wide)]
    assert narrow == wide and len(wide) == 800


def test_long_labels(spark):
    rows = spark.createDataFrame([("x" * 600, 1.0, "s"), ("a", 1.0, "s"), ("a", 1.0, "s")], "v string, n double, w string")
    found, _ = add_features(rows, ["n"], ["v", "w"])
    assert sorted(row["v_idx"] for row in found.collect()) == [0.0, 0.0, 1.0]


def test_four_wide_columns_need_two_scans(spark, tmp_path):
    names = ["a", "b", "c", "d"]
    spark.range(600).selectExpr(*[f"string(id % {60 + at}) AS {name}" for at, name in enumerate(names)], "double(id) AS n").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    found = with_places(rows, names, *category_places(category_counts(rows, names)), hot_labels=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<a:string") == 2
    assert found.agg(*[F.countDistinct(f"{name}_idx") for name in names]).first()[:] == (60, 61, 62, 63)


def test_columns_of_the_names_used_inside(spark):
    rows = spark.createDataFrame([("a", 1.0, 5, 6, 7), ("b", 2.0, 5, 6, 7)], "v string, n double, _label_0 int, _place_0 int, _rare_0 int")
    found, _ = add_features(rows, ["n"], ["v"], hot_labels=1)
    assert {(row["v"], row["v_idx"], row["_place_0"]) for row in found.collect()} == {("a", 0.0, 6), ("b", 1.0, 6)}


@pytest.mark.parametrize("limit", [1, 100_000])
def test_unseen_category_gets_the_last_index(spark, limit):
    rows = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("new", 2.0)], "v string, n double")
    found, _ = add_features(rows, ["n"], ["v"], fit_rows=rows.where("n = 1"), hot_labels=limit)
    assert {row["v"]: row["v_idx"] for row in found.collect()} == {"a": 0.0, "b": 1.0, "new": 2.0}


def test_places_of_a_hot_category(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    found = with_places(rows, ["v"], *category_places(category_counts(rows, ["v"])), hot_labels=10)
    assert found.where("v = 'hot'").select("v_idx").distinct().collect() == [(0.0,)]
    assert found.agg(F.countDistinct("v_idx"), F.max("v_idx")).first()[:] == (601, 600.0)


def test_places_of_rare_and_long_categories(spark, monkeypatch):
    monkeypatch.setattr(features, "LONG_LABEL", 3)
    labels = ["hot"] * 9 + ["a long one"] * 5 + ["b"] * 4 + ["c"] * 2 + ["d", None, None]
    rows = spark.createDataFrame([(label,) for label in labels], "v string")
    found = with_places(rows, ["v"], *category_places(category_counts(rows, ["v"])), hot_labels=2)
    assert {tuple(row) for row in found.distinct().collect()} == {
        ("hot", 0.0), ("a long one", 1.0), ("b", 2.0), ("c", 3.0), ("d", 4.0), (None, 5.0)
    }
    assert found.count() == len(labels)


def test_constant_column_scales_to_zero(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaled, _ = add_features(rows, ["a", "b"], [], scale=True)
    values = [row["f"] for row in scaled.select(vector_to_array("features").alias("f")).collect()]
    assert {value[1] for value in values} == {0.0}
    assert values[2][0] == pytest.approx(4 / (7 / 3) ** 0.5)


def test_rows_without_numbers_are_left_out(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "a double")
    assert add_features(rows, ["a"], [])[0].count() == 1


def test_scaling_drops_the_category_mark(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "v string, n double")
    assert "nominal" in attribute_kinds(add_features(rows, ["n"], ["v"])[0])
    assert "nominal" not in attribute_kinds(add_features(rows, ["n"], ["v"], scale=True)[0])


def test_indexes_equal_the_fitted_indexer(spark):
    draw = random.Random(8)
    rows = [(draw.choice(["", "b", "B", "ä", "zz", None]), draw.choice([1, 1, 2, None])) for _ in range(500)]
    frame = spark.createDataFrame(rows, "v string, k int").withColumn("n", F.lit(1.0))
    ours, _ = add_features(frame, ["n"], ["v", "k"])
    indexer = StringIndexer(inputCols=["v", "k"], outputCols=["v_fit", "k_fit"], handleInvalid="keep")
    both = indexer.fit(frame).transform(ours)
    assert both.where("v_idx <> v_fit OR k_idx <> k_fit").count() == 0 and both.count() == 500


def test_category_without_any_value(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0)], "v string, n double")
    assert [row["v_idx"] for row in add_features(rows, ["n"], ["v"])[0].collect()] == [0.0, 0.0]


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(11)
    rows = [(float(draw.random() < 0.3), round(draw.random(), 2)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "label double, score double")
    return frame.withColumn("prediction", (F.col("score") + F.col("label") / 5 > 0.6).cast("double"))


def test_metrics_equal_evaluators(spark, scored):
    row = model_report(scored, "any").first()
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")]:
        assert row[name] == pytest.approx(multi.evaluate(scored, {multi.metricName: metric}), abs=1e-12)
    exact = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert row["auc"] == pytest.approx(exact.evaluate(scored), abs=1e-12)
    assert (row["model"], row["rows"]) == ("any", 3000)


def test_auc_against_all_pairs(spark):
    draw = random.Random(2)
    rows = [(float(draw.random() < 0.5), float(draw.choice([1, 1, 1, draw.randrange(9)]))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "label double, score double")
    highs = [score for label, score in rows if label == 1]
    lows = [score for label, score in rows if label == 0]
    wins = sum((high > low) + 0.5 * (high == low) for high in highs for low in lows)
    assert area_under_roc(frame, "score").first()["auc"] == pytest.approx(wins / len(highs) / len(lows), abs=1e-12)


def test_metrics_of_one_sided_rows(spark):
    frame = spark.createDataFrame([(1.0, 0.0, 0.4), (1.0, 1.0, 0.6)], "label double, prediction double, score double")
    row = class_metrics(frame).first()
    assert (row["accuracy"], row["weighted_precision"], row["weighted_recall"]) == (0.5, 1.0, 0.5)
    assert area_under_roc(frame, "score").first()["auc"] is None


@pytest.fixture(scope="module")
def loans(spark):
    return catalog.trained_loans(spark, "/root/testdata/sf0.01")


def test_loan_models_learn(spark, loans):
    rows = {row["model"]: row for row in loans.report.collect()}
    assert set(rows) == {"forest", "logistic"}
    assert rows["forest"]["auc"] > 0.7 and rows["logistic"]["auc"] > 0.7
    assert rows["forest"]["rows"] == rows["logistic"]["rows"] == loans.results.count()
    assert loans.results.columns == fixed.LOAN_RESULT_COLUMNS
    assert len(loans.models["forest"].trees) == fixed.FOREST_TREES
    assert {row["prediction"] for row in loans.results.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_marketing_forest_learns(spark):
    trained = catalog.trained_marketing(spark, "/root/testdata/sf0.01")
    row = trained.report.first()
    assert row["auc"] > 0.7 and row["rows"] == trained.results.count()
    assert trained.results.columns == fixed.MARKETING_RESULT_COLUMNS


def test_forest_result_on_request(spark, sf_dir):
    gold = loan.gold(catalog.loan_silver(spark, sf_dir))
    trained = loan.train_and_score(gold, result_model="forest", key=F.concat_ws("|", "loan_amnt", "fico_range_low"))
    assert trained.results.count() == trained.report.where("model = 'forest'").first()["rows"]


def test_fit_on_training_rows_only(spark, sf_dir):
    silver = catalog.marketing_silver(spark, sf_dir)
    some = silver.where("age < 60")
    assert marketing.gold(silver, fit_rows=some).count() == marketing.gold(silver).count()
    rows = catalog.loan_silver(spark, sf_dir)
    ratio = loan.gold(rows, fit_rows=rows.where("dti < 20")).where("label = 1").first()["classWeight"]
    part = rows.where("dti < 20").agg(F.count_if(F.col("label") == 0) / F.count_if(F.col("label") == 1)).first()[0]
    assert ratio == pytest.approx(part)


def test_forest_is_the_same_from_any_layout(spark, sf_dir):
    gold = marketing.gold(catalog.marketing_silver(spark, sf_dir)).persist()
    trees = []
    for layout in (1, 4, 8):
        with kept_for_training(gold.repartition(layout), "label", "features", partitions=4) as rows:
            trees.append(fit_forest(rows, trees=5).toDebugString.split("\n", 1)[1])
    gold.unpersist()
    assert trees[0] == trees[1] == trees[2]


def test_rows_without_label_or_score_are_left_out(spark):
    rows = [(1.0, 1.0, 0.9), (0.0, 0.0, 0.1), (None, 0.0, 0.95), (None, 1.0, 0.99), (1.0, 1.0, None), (0.0, 0.0, float("nan"))]
    frame = spark.createDataFrame(rows, "label double, prediction double, score double")
    row = model_report(frame, "m").first()
    assert (row["rows"], row["accuracy"], row["auc"]) == (4, 1.0, 1.0)


def test_setting_chosen_is_the_same_from_any_layout(spark):
    draw = random.Random(3)
    rows = [(float(draw.random() < 0.2 + 0.6 * (at % 7 > 3)), at % 7 + draw.random(), draw.random() * 5) for at in range(900)]
    frame = spark.createDataFrame(rows, "label double, a double, b double")
    frame = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame).withColumn("classWeight", F.lit(1.0))
    models, sizes = [], []
    for layout in (1, 4, 8):
        with kept_for_training(frame.repartition(layout, "b"), "label", "features", "classWeight", partitions=3) as kept:
            models.append(fit_logistic(kept, reg_params=[0.0, 0.1, 30.0]))
            sizes.append(kept.groupBy(fold_number(kept, 3).alias("fold")).count().orderBy("fold").collect())
    assert len({model.getRegParam() for model in models}) == 1 and models[0].getRegParam() < 30
    assert len({tuple(model.coefficients.toArray().round(9)) for model in models}) == 1
    assert sizes[0] == sizes[1] == sizes[2] and all(200 < row["count"] < 400 for row in sizes[0])


def test_folds_of_one_class_have_no_say(spark):
    frame = spark.createDataFrame([(1.0, float(at)) for at in range(5)] + [(0.0, -1.0)], "label double, a double")
    frame = VectorAssembler(inputCols=["a"], outputCol="features").transform(frame)
    assert fit_logistic(frame, weight=None, reg_params=[0.2, 0.1]).getRegParam() in (0.1, 0.2)
    assert fit_logistic(frame, weight=None, reg_params=[0.3]).getRegParam() == 0.3


def stacked(scored, models):
    names = F.explode(F.array(*[F.lit(f"m{number}") for number in range(models)])).alias("model")
    rows = scored.select(names, "label", "prediction", F.col("score").alias("raw"))
    turn = F.xxhash64("model", "raw") % 7 / 20
    return rows.select("model", "label", "prediction", (F.col("raw") + turn).alias("score"))


def test_all_models_in_one_evaluation(spark, scored):
    frame = stacked(scored, 3)
    none = spark.createDataFrame([("empty", None, 1.0, 0.5), ("flat", 1.0, 1.0, None)], frame.schema)
    rows = {row["model"]: row for row in model_reports(frame.unionByName(none)).collect()}
    assert set(rows) == {"m0", "m1", "m2", "flat"}  # no labels, no row
    assert (rows["flat"]["rows"], rows["flat"]["auc"]) == (1, None)
    for name in ("m0", "m1", "m2"):
        alone = model_report(frame.where(F.col("model") == name), name).first()
        assert rows[name][:5] == alone[:5]
        assert rows[name]["auc"] == pytest.approx(alone["auc"], abs=1e-12)
    assert len({row["auc"] for row in rows.values()}) > 2


def test_evaluation_shuffles_do_not_grow_with_the_models(spark, scored):
    def shuffles(models):
        frame = model_reports(stacked(scored, models))
        return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(1) == shuffles(5)


@pytest.mark.parametrize("blocks", [2, 8])
def test_area_over_few_blocks(spark, scored, blocks, monkeypatch):
    whole = area_under_roc(scored, "score").first()["auc"]
    monkeypatch.setattr(metrics, "SCORE_BLOCKS", blocks)
    assert area_under_roc(scored, "score").first()["auc"] == pytest.approx(whole, abs=1e-12)


def test_a_cluster_must_name_its_training_partitions(spark):
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn"))
    assert training_partitions(cluster, 400) == 400
    assert training_partitions(spark, None) == TRAINING_PARTITIONS
    with pytest.raises(ValueError, match="partitions"):
        training_partitions(cluster, None)


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(training, "TRAINING_ROWS", 100)
    assert [partitions_by_rows(spark.range(rows)) for rows in (0, 1600, 1601, 5000)] == [16, 16, 17, 50]


@pytest.mark.parametrize("name", ["forest_report", "rule_loan_score"])
def test_model_queries_run_on_a_cluster(spark, sf_dir, monkeypatch, tmp_path, name):
    """They say themselves into how many partitions their training rows go."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert catalog.ENTRIES[name].run(spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", ["logit_cv_score", "rule_loan_report"])
def test_loan_queries_run_on_a_cluster_after_an_observation(spark, sf_dir, monkeypatch, tmp_path, name):
    """What once stopped them together: a master that is not local, and a session that goes nowhere with a model."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    session = spark.newSession()
    session.range(3).observe(Observation("rows"), F.count(F.lit(1)).alias("n")).collect()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert catalog.ENTRIES[name].run(session, sf_dir).count() > 0


def test_models_go_to_tasks_of_a_session_that_has_used_an_observation(spark):
    session = spark.newSession()
    session.range(3).observe(Observation("rows"), F.count(F.lit(1)).alias("n")).collect()
    rows = [(float(place % 2), 1.0, Vectors.dense(float(place % 2), float(place % 7))) for place in range(60)]
    frame = session.createDataFrame(rows, ["label", "classWeight", "features"])
    for model in (fit_forest(frame, trees=3), fit_logistic(frame, reg_params=[0.01, 0.1])):
        assert model.transform(frame).where("prediction = label").count() == 60


@pytest.fixture
def halves(spark):
    rows = [(float(place % 2), 1.0, Vectors.dense(float(place % 2), float(place % 7))) for place in range(60)]
    return spark.createDataFrame(rows, ["label", "classWeight", "features"])


def test_settings_are_compared_without_semaphores(halves, monkeypatch):
    def refused(*arguments, **named):
        raise OSError(38, "Function not implemented")

    monkeypatch.setattr("multiprocessing.synchronize.SemLock.__init__", refused)
    assert fit_logistic(halves, reg_params=[0.01, 0.1]).transform(halves).where("prediction = label").count() == 60


def test_settings_are_compared_where_threads_are_not_pinned(halves, monkeypatch):
    """A gateway of another kind is what PySpark knows PYSPARK_PIN_THREAD=false by."""
    monkeypatch.setattr("py4j.clientserver.ClientServer", type("Other", (), {}))
    assert fit_logistic(halves, reg_params=[0.01, 0.1]).transform(halves).where("prediction = label").count() == 60


@pytest.mark.parametrize("parallelism", [1, 2, 9])
def test_tasks_at_once_keep_order_properties_and_errors(spark, parallelism):
    context = spark.sparkContext
    context.setLocalProperty("feedmill.test", "kept")
    try:
        found = at_once(spark, lambda item: (item, context.getLocalProperty("feedmill.test")), range(5), parallelism)
    finally:
        context.setLocalProperty("feedmill.test", None)
    assert found == [(item, "kept") for item in range(5)] and at_once(spark, str, [], parallelism) == []
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda item: 1 / item, [1, 0], parallelism)
