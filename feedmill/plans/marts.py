"""The six summary marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.operators.caps import ordered_cap
from feedmill.operators.counting import count_by, histogram
from feedmill.sources.releases import Place, publish_together
from feedmill.sources.tables import Target, fan_out, read_table


def loan_grade(loan_results: DataFrame) -> DataFrame:
    """Loans per grade and predicted class."""
    return count_by(loan_results, "grade", "prediction")


def loan_home(loan_silver: DataFrame) -> DataFrame:
    """Loans per kind of home ownership."""
    return count_by(loan_silver, "home_ownership")


def loan_scatter(
    loan_results: DataFrame, rows: int | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """The points of a scatter chart: all, or ``rows`` of them, the same ones at every run.

    Without an order these follow a hash of their values, so they spread
    over the whole table instead of clustering at one end of an axis.
    """
    columns = ["dti", "loan_amnt", "prediction"]
    points = loan_results.select(*columns)
    if rows is None:
        return points
    if order_by is not None:
        return ordered_cap(points, rows, order_by)
    return ordered_cap(points.withColumn("_spread", F.xxhash64(*columns)), rows, ["_spread", *columns]).drop("_spread")


def marketing_balance(marketing_results: DataFrame) -> DataFrame:
    """Contacts per balance bucket and predicted class."""
    return histogram(marketing_results, "balance", ["prediction"])


def marketing_education(marketing_silver: DataFrame) -> DataFrame:
    """Contacts per education and true outcome."""
    return count_by(marketing_silver, "education", "y")


def marketing_job(marketing_results: DataFrame) -> DataFrame:
    """Contacts per job and predicted class."""
    return count_by(marketing_results, "job", "prediction")


def build_marts(
    loan_results: DataFrame,
    marketing_results: DataFrame,
    loan_silver: DataFrame,
    marketing_silver: DataFrame,
    scatter_rows: int | None = None,
) -> dict[str, DataFrame]:
    """All six marts by name. Each reads only the columns it counts. ``scatter_rows`` thins out the scatter."""
    return {
        "viz_loan_grade": loan_grade(loan_results),
        "viz_mkt_balance": marketing_balance(marketing_results),
        "viz_loan_home": loan_home(loan_silver),
        "viz_mkt_edu": marketing_education(marketing_silver),
        "viz_loan_scatter": loan_scatter(loan_results, scatter_rows),
        "viz_mkt_job": marketing_job(marketing_results),
    }


def marts_of(spark: SparkSession, base: str, fmt: str = "parquet", scatter_rows: int | None = None) -> dict[str, DataFrame]:
    """The marts of the tables under ``base``."""
    return build_marts(
        read_table(spark, f"{base}/loan_results", fmt),
        read_table(spark, f"{base}/marketing_results", fmt),
        read_table(spark, f"{base}/loan_silver", fmt),
        read_table(spark, f"{base}/mkt_silver", fmt),
        scatter_rows,
    )


def run(
    spark: SparkSession, base: str, targets: Callable[[str], Sequence[Target]], fmt: str = "parquet",
    scatter_rows: int | None = None,
) -> None:
    """Build the marts from the tables under ``base`` and write each to its targets, one after the other."""
    for name, mart in marts_of(spark, base, fmt, scatter_rows).items():
        fan_out(mart, targets(name))


def run_together(
    spark: SparkSession, base: str, places: Sequence[Place], fmt: str = "parquet", scatter_rows: int | None = None
) -> str:
    """Build the marts and let all places show all of them at once, or none; returns the release."""
    return publish_together(marts_of(spark, base, fmt, scatter_rows), places)
