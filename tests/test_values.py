import math

import pytest
from pyspark.sql import functions as F

from feedmill.functions import values


def one_column(spark, rows, kind, expression):
    frame = spark.createDataFrame([(place, row) for place, row in enumerate(rows)], f"place int, v {kind}")
    found = frame.select("place", expression.alias("out")).orderBy("place").collect()
    return [row["out"] for row in found]


@pytest.mark.parametrize(
    "value, bucket",
    [
        (7000.0, "5000"), (5000.0, "5000"), (3000.0, "0"), (-1.0, "-5000"), (-5000.0, "-5000"),
        (None, None), (float("nan"), "0"), (float("inf"), None), (1e300, None),
    ],
)
def test_bucket_floor(spark, value, bucket):
    assert one_column(spark, [value], "double", values.bucket_floor("v")) == [bucket]


def test_lenient_double(spark):
    texts = ["33", "x1", " 7 ", "NaN", "13.56%", "", None]
    found = one_column(spark, texts, "string", values.lenient_double("v"))
    assert found[:3] == [33.0, None, 7.0]
    assert math.isnan(found[3])
    assert found[4:] == [None, None, None]


def test_labels(spark):
    texts = ["Fully Paid", "Charged Off", None]
    assert one_column(spark, texts, "string", values.label_unless("v", "Fully Paid")) == [0.0, 1.0, 1.0]
    assert one_column(spark, ["yes", "no", None], "string", values.label_if("v", "yes")) == [1.0, 0.0, 0.0]


def test_class_text(spark):
    assert one_column(spark, [0.0, 1.0, None], "double", values.class_text("v")) == ["0.0", "1.0", "NaN"]
    assert one_column(spark, ["0.0", "1", "x", None], "string", values.class_text("v")) == ["0.0", "1.0", "NaN", "NaN"]


def test_job_group(spark):
    jobs = ["Admin.", "self-employed", "BLUE-COLLAR", "housemaid", "retired", "unknown", None]
    expected = ["office", "office", "labor", "labor", "other", "other", "other"]
    assert one_column(spark, jobs, "string", values.job_group("v")) == expected


def test_asset_band(spark):
    buckets = ["-5000", "0", "5000", "10000", "50000", "55000", None, "", "no number", "NaN"]
    expected = ["debt", "low", "low", "middle", "middle", "VIP", "low", "low", "VIP", "VIP"]
    assert one_column(spark, buckets, "string", values.asset_band("v")) == expected


def test_field_takes_any_name(spark):
    name = 'a;"b`.c"'
    frame = spark.createDataFrame([("x",)], ["plain"]).select(F.col("plain").alias(name))
    assert frame.select(values.field(name).alias("out")).first()["out"] == "x"
