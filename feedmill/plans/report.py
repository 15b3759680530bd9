"""Report tables and chart rows out of the marts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.functions.encoding import positional_json
from feedmill.functions.values import asset_band, class_text, job_group
from feedmill.operators.counting import sum_counts
from feedmill.operators.pivoting import pivot_counts

CLASS_COLUMNS = {"safe": "0.0", "risky": "1.0"}


def grade_risk(grade_mart: DataFrame) -> DataFrame:
    """Grades A to G with their safe and risky counts; other grades are not shown."""
    return pivot_counts(
        grade_mart, "grade", class_text("prediction"), CLASS_COLUMNS, count="count", domain=fixed.GRADES
    )


def job_groups(job_mart: DataFrame) -> DataFrame:
    """Counts of office, labor and other jobs."""
    return sum_counts(job_mart, job_group("job"), "job_group", fixed.JOB_GROUPS)


def asset_bands(balance_mart: DataFrame) -> DataFrame:
    """Counts of the four asset bands."""
    return sum_counts(balance_mart, asset_band("balance_range"), "band", fixed.ASSET_BANDS)


def education_outcome(education_mart: DataFrame) -> DataFrame:
    """Every education with its yes and no counts."""
    return pivot_counts(education_mart, "education", "y", {name: name for name in fixed.OUTCOMES}, count="count")


def class_points(scatter_mart: DataFrame, text: str) -> DataFrame:
    """Points of one predicted class as x and y."""
    return scatter_mart.where(class_text("prediction") == text).select(
        F.col("dti").alias("x"), F.col("loan_amnt").alias("y")
    )


def home_share(home_mart: DataFrame) -> DataFrame:
    """Label and count of every kind of home ownership."""
    return home_mart.select("home_ownership", "count")


def chart_rows(marts: Mapping[str, DataFrame]) -> DataFrame:
    """``chart`` and ``entry``: one JSON list per mart row, ready for a chart feed."""
    predicted = class_text("prediction")
    shapes = {
        "grade": ("viz_loan_grade", ["grade", predicted, "count"]),
        "scatter": ("viz_loan_scatter", ["dti", "loan_amnt", predicted]),
        "job": ("viz_mkt_job", ["job", predicted, "count"]),
        "balance": ("viz_mkt_balance", ["balance_range", predicted, "count"]),
        "home": ("viz_loan_home", ["home_ownership", "count"]),
        "edu": ("viz_mkt_edu", ["education", "y", "count"]),
    }
    feeds = [
        marts[mart].select(F.lit(chart).alias("chart"), positional_json(*values).alias("entry"))
        for chart, (mart, values) in shapes.items()
        if mart in marts
    ]
    return reduce(DataFrame.unionByName, feeds)
