"""The composites over written tables, and the shape of their physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.operators.metrics import area_under_roc
from feedmill.plans import loan, marketing, marts, report
from feedmill.plans.feed import encode_feed, write_feed_files
from feedmill.sources.tables import Target, read_table
from feedmill.streaming.ingest import file_stream, ledger_table, start_ingest
from workloads import catalog
from workloads.feeds import loan_bronze, loan_rows, marketing_bronze, marketing_lines


@pytest.fixture(scope="module")
def base(spark, sf_dir, tmp_path_factory):
    """Feed files, streamed into bronze, through silver and gold to results and marts."""
    base = str(tmp_path_factory.mktemp("tables"))
    sources = {"loan": loan_rows(spark, sf_dir).drop("cut_off"), "mkt": marketing_lines(spark, sf_dir)}
    for name, rows in sources.items():
        feed = encode_feed(rows, [F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])], rows=None, chunk_rows=200)
        write_feed_files(feed, f"{base}/{name}_topic", 200)
        stream = file_stream(spark, f"{base}/{name}_topic", maxFilesPerTrigger="4")
        start_ingest(
            stream, f"{base}/{name}_bronze", f"{base}/{name}_ledger", f"{base}/{name}_checkpoint", trigger=None
        ).awaitTermination()
        total = ledger_table(spark, f"{base}/{name}_ledger").agg(F.max("total_rows")).first()[0]
        assert total == rows.count()
    loan.run(spark, base)
    marketing.run(spark, base)
    marts.run(spark, base, lambda name: [Target("parquet", f"{base}/{name}"), Target("json", f"{base}/copy/{name}")])
    return base


def count_sum(spark, path):
    return read_table(spark, path).agg(F.sum("count")).first()[0]


def test_mart_totals(spark, base):
    rows = {name: read_table(spark, f"{base}/{name}").count() for name in ("loan_results", "marketing_results", "loan_silver", "mkt_silver")}
    assert count_sum(spark, f"{base}/viz_loan_grade") == rows["loan_results"]
    assert count_sum(spark, f"{base}/viz_loan_home") == rows["loan_silver"]
    assert count_sum(spark, f"{base}/viz_mkt_balance") == rows["marketing_results"]
    assert count_sum(spark, f"{base}/viz_mkt_job") == rows["marketing_results"]
    assert count_sum(spark, f"{base}/viz_mkt_edu") == rows["mkt_silver"]
    assert read_table(spark, f"{base}/viz_loan_scatter").count() == rows["loan_results"]


def test_both_targets_hold_the_same(spark, base):
    for name in ("viz_loan_grade", "viz_loan_home", "viz_mkt_balance", "viz_mkt_job", "viz_mkt_edu", "viz_loan_scatter"):
        first = read_table(spark, f"{base}/{name}")
        second = read_table(spark, f"{base}/copy/{name}", "json", schema=first.schema)
        assert first.exceptAll(second).count() == second.exceptAll(first).count() == 0


def test_report_totals(spark, base):
    mart = {name: read_table(spark, f"{base}/{name}") for name in (
        "viz_loan_grade", "viz_loan_home", "viz_mkt_balance", "viz_mkt_job", "viz_mkt_edu", "viz_loan_scatter")}
    shown = mart["viz_loan_grade"].where(F.col("grade").isin(fixed.GRADES)).agg(F.sum("count")).first()[0]
    assert report.grade_risk(mart["viz_loan_grade"]).agg(F.sum(F.col("safe") + F.col("risky"))).first()[0] == shown
    jobs = report.job_groups(mart["viz_mkt_job"])
    assert jobs.count() == 3
    assert jobs.agg(F.sum("count")).first()[0] == count_sum(spark, f"{base}/viz_mkt_job")
    bands = report.asset_bands(mart["viz_mkt_balance"])
    assert bands.count() == 4
    assert bands.agg(F.sum("count")).first()[0] == count_sum(spark, f"{base}/viz_mkt_balance")
    points = sum(report.class_points(mart["viz_loan_scatter"], text).count() for text in fixed.CLASS_TEXTS)
    assert points == mart["viz_loan_scatter"].count()
    assert report.chart_rows(mart).count() == sum(frame.count() for frame in mart.values())


def test_scatter_is_the_same_at_every_run(spark, base):
    results = read_table(spark, f"{base}/loan_results")
    first = marts.loan_scatter(results, rows=20)
    second = marts.loan_scatter(results.repartition(7), rows=20)
    assert first.exceptAll(second).count() == 0 and first.count() == 20


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["loan_silver", "marketing_silver", "class_weight", "grade_risk", "asset_bands", "job_groups", "metrics_class",
     "metrics_auc", "model_report", "hot_key_ordinals", "category_index_wide", "chart_rows", "holdout_split"],
)
def test_plans_have_no_python_and_no_nested_loops(spark, sf_dir, name):
    plan = physical(catalog.ENTRIES[name].run(spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_scans_read_what_is_used(spark, base):
    results = read_table(spark, f"{base}/loan_results")
    assert "ReadSchema: struct<prediction:double,grade:string>" in physical(marts.loan_grade(results))
    silver = read_table(spark, f"{base}/loan_silver")
    assert "ReadSchema: struct<home_ownership:string>" in physical(marts.loan_home(silver))
    assert "PushedFilters: [In(grade" in physical(report.grade_risk(results.withColumn("count", F.lit(1))))


def test_json_is_parsed_once(spark, sf_dir):
    assert physical(loan.silver(loan_bronze(spark, sf_dir))).count("from_json(") == 1
    assert physical(marketing.silver(marketing_bronze(spark, sf_dir))).count("from_json(") == 1


def test_only_the_named_fields_are_parsed(spark):
    plan = physical(loan.silver(spark.createDataFrame([("{}",)], "value string"), ["grade"]))
    assert set(re.findall(r"StructField\((\w+),", plan)) == {"loan_status", "loan_amnt", "annual_inc", "grade"}


def test_hot_scores_combine_before_the_shuffle(spark):
    plan = physical(area_under_roc(spark.range(10).selectExpr("double(id % 2) AS label", "0.5D AS score"), "score"))
    assert plan.count("partial_count") >= 1
