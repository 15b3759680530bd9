import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from py4j.protocol import Py4JError

from feedmill.operators import caps
from feedmill.operators.caps import ordered_cap
from feedmill.operators.cleaning import apply_null_policy
from feedmill.operators.counting import count_by, histogram
from feedmill.operators.ordinals import ROW_BITS, slice_rows, with_chunks, with_ordinals
from feedmill.operators.pivoting import pivot_counts
from feedmill.operators.splitting import split_rows
from feedmill.operators.weighting import class_balance, with_class_weight
from feedmill.plans import report
from feedmill.plans.feed import encode_feed

NAN = float("nan")


def tuples(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_null_policy(spark):
    rows = spark.createDataFrame([(NAN, 1.0, "x"), (2.0, NAN, None), (3.0, None, "y"), (None, 1.0, "z")], "a double, b double, t string")
    found = apply_null_policy(rows, required=["a"], zero_fill=["a", "b"], text_fill="Unknown")
    assert tuples(found) == [(2.0, 0.0, "Unknown"), (3.0, 0.0, "y")]


@pytest.mark.parametrize("kind, zero, one", [("double", 0.0, 1.0), ("string", "0.0", "1.0")])
def test_histogram(spark, kind, zero, one):
    rows = spark.createDataFrame(
        [(7000.0, zero), (3000.0, one), (-1.0, zero), (None, zero), (NAN, one), (5000.0, zero)],
        f"balance double, prediction {kind}",
    )
    found = {tuple(row) for row in histogram(rows, "balance", ["prediction"]).collect()}
    assert found == {("5000", zero, 2), ("0", one, 2), ("-5000", zero, 1), (None, zero, 1)}


def test_count_by_keeps_null_keys(spark):
    rows = spark.createDataFrame([("A", 1.0), ("A", 1.0), (None, 0.0)], "grade string, prediction double")
    assert tuples(count_by(rows, "grade", "prediction")) == [("A", 1.0, 2), (None, 0.0, 1)]


def test_class_weight(spark):
    rows = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], ["label"])
    assert tuples(with_class_weight(rows)) == [(0.0, 1.0)] * 3 + [(1.0, 3.0)]
    assert class_balance(rows).first().asDict() == {"total": 4, "positives": 1, "ratio": 3.0}


def test_class_weight_from_training_rows(spark):
    rows = spark.createDataFrame([(0.0, 1), (0.0, 2), (0.0, 1), (1.0, 1)], "label double, part int")
    found = with_class_weight(rows, fit_rows=rows.where("part = 1")).where("label = 1").first()
    assert found["classWeight"] == 2.0


def test_class_weight_needs_positives(spark):
    rows = spark.createDataFrame([(0.0,), (0.0,)], ["label"])
    with pytest.raises((PySparkException, Py4JError), match="no rows with label 1"):
        with_class_weight(rows).collect()


def test_fixed_pivot_and_bands(spark):
    grades = spark.createDataFrame(
        [("A", 0.0, 5), ("A", 1.0, 2), ("C", 1.0, 1), ("Unknown", 0.0, 9)], "grade string, prediction double, count bigint"
    )
    found = {row["grade"]: (row["safe"], row["risky"]) for row in report.grade_risk(grades).collect()}
    assert found == {"A": (5, 2), "B": (0, 0), "C": (0, 1), "D": (0, 0), "E": (0, 0), "F": (0, 0), "G": (0, 0)}

    jobs = spark.createDataFrame([("Admin.", 0.0, 3), ("BLUE-COLLAR", 1.0, 4), ("management", 1.0, 1)], "job string, prediction double, count bigint")
    assert tuples(report.job_groups(jobs)) == [("labor", 4), ("office", 4), ("other", 0)]

    buckets = spark.createDataFrame(
        [("-5000", 1), ("0", 2), ("5000", 3), ("10000", 4), ("50000", 5), ("55000", 6), (None, 7), ("odd", 8)],
        "balance_range string, count bigint",
    )
    assert tuples(report.asset_bands(buckets)) == [("VIP", 14), ("debt", 1), ("low", 12), ("middle", 9)]


def test_open_pivot(spark):
    mart = spark.createDataFrame(
        [("primary", "yes", 1), ("primary", "no", 2), ("tertiary", "no", 3), ("unknown", None, 4)],
        "education string, y string, count bigint",
    )
    assert tuples(report.education_outcome(mart)) == [("primary", 1, 2), ("tertiary", 0, 3), ("unknown", 0, 0)]
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert tuples(pivot_counts(rows, "k", "v", {"one": 1, "two": 2})) == [("a", 1, 1), ("b", 0, 0)]


def test_class_points(spark):
    points = spark.createDataFrame([(1.0, 10.0, 0.0), (2.0, 20.0, 1.0), (3.0, 30.0, None)], "dti double, loan_amnt double, prediction double")
    assert tuples(report.class_points(points, "0.0")) == [(1.0, 10.0)]
    assert tuples(report.class_points(points, "1.0")) == [(2.0, 20.0)]


@pytest.mark.parametrize("unique", [True, False])
def test_ordinals_against_sorting(spark, unique):
    draw = random.Random(3)
    rows = [(draw.choice([0, 0, draw.randrange(50)]), place) for place in range(3000)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "hot bigint, id bigint").repartition(5)
    found = with_ordinals(frame, ["hot", "id"], unique=unique)
    assert found.columns == ["hot", "id", "ordinal"]
    in_order = [(row["hot"], row["id"]) for row in found.orderBy("ordinal").collect()]
    assert in_order == sorted(rows)
    assert found.agg(F.min("ordinal"), F.max("ordinal"), F.countDistinct("ordinal")).first()[:] == (0, 2999, 3000)


def test_ordinals_split_rows_that_are_all_the_same(spark):
    frame = spark.range(0, 20_000, 1, 4).select(F.lit(7).alias("same"))
    found = with_ordinals(frame, ["same"], blocks=8)
    assert found.agg(F.countDistinct("ordinal"), F.max("ordinal")).first()[:] == (20_000, 19_999)
    tagged = found.selectExpr("ordinal")
    assert tagged.count() == 20_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert str(ROW_BITS) in plan  # block numbers come from the staged placement
    placement = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [row["n"] for row in placement.groupBy(F.shiftright("_at", ROW_BITS)).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 20_000 / 3


def wide_rows(spark, path):
    """A third of all rows under one key, wide, in several Parquet files."""
    frame = spark.range(0, 9_000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).alias("hot"), F.sha2(F.col("id").cast("string"), 512).alias("wide"),
        F.lit("mine").alias("_file"), F.col("id").alias("_number"),
    )
    frame.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("stored", [True, False])
def test_ordinals_come_back_by_address(spark, tmp_path, stored):
    rows = wide_rows(spark, str(tmp_path / "rows"))
    found = with_ordinals(rows, ["hot"], blocks=8, stored=stored)
    assert found.columns == [*rows.columns, "ordinal"]
    numbered = found.orderBy("ordinal").collect()
    assert [row["ordinal"] for row in numbered] == list(range(9_000))
    assert [row["hot"] for row in numbered] == sorted(row["hot"] for row in numbered)
    assert found.drop("ordinal").exceptAll(rows).count() == 0 == rows.exceptAll(found.drop("ordinal")).count()
    placement = [folder for folder in {file.rsplit("/", 1)[0] for file in found.inputFiles()} if "ordinals-" in folder]
    placed = spark.read.parquet(*placement)
    assert not {"hot", "wide"} & set(placed.columns) and len(placed.columns) == 3
    sizes = [row["n"] for row in placed.groupBy(F.shiftright(placed.columns[2], ROW_BITS)).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 9_000 / 3


def test_wide_rows_are_read_once_and_only_joined(spark, tmp_path):
    rows = wide_rows(spark, str(tmp_path / "rows"))
    plan = with_ordinals(rows, ["hot"], stored=True)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len([line for line in scans if "wide" in line]) == 1
    assert "rangepartitioning" not in plan and "\nSort" not in plan
    part = rows.where("hot > 3").select("hot", "wide")
    kept = with_ordinals(part, [F.desc("hot")], stored=True)
    assert kept.where("ordinal = 0").first()["hot"] == 699 and kept.count() == part.count()


def test_ordinals_descending_and_empty(spark):
    frame = spark.createDataFrame([(1, "b"), (2, "a"), (2, "c")], "n int, t string")
    found = with_ordinals(frame, [F.desc("n"), "t"], unique=True).orderBy("ordinal").collect()
    assert [row["t"] for row in found] == ["a", "c", "b"]
    assert with_ordinals(frame.where("n > 9"), ["n"]).count() == 0


def test_chunks_and_slices(spark):
    numbered = with_ordinals(spark.range(2500), ["id"], unique=True)
    chunked = with_chunks(numbered, 1000)
    assert tuples(chunked.groupBy("chunk").count()) == [(0, 1000), (1, 1000), (2, 500)]
    assert tuples(slice_rows(numbered, 1000, 1002).select("id")) == [(1000,), (1001,)]


def test_encode_feed_caps_in_order(spark):
    feed = encode_feed(spark.range(100).select((99 - F.col("id")).alias("id")), ["id"], rows=25, chunk_rows=10, unique=True)
    rows = feed.orderBy("ordinal").collect()
    assert [row["value"] for row in rows] == [f'{{"id":{place}}}' for place in range(25)]
    assert [row["chunk"] for row in rows] == [place // 10 for place in range(25)]


def expected_cap(rows, count):
    def rank(value):
        return (0, 0) if value is None else (2, 0) if value != value else (1, value)

    return sorted(rows, key=lambda row: tuple(rank(value) for value in row))[:count]


@pytest.mark.parametrize("count", [1, 7, 60, 5000])
@pytest.mark.parametrize("shape", ["spread", "hot", "nulls", "floats"])
def test_cap_against_sorting(spark, count, shape, monkeypatch):
    draw = random.Random(f"{count}-{shape}")
    lead = {
        "spread": lambda: draw.randrange(100_000),
        "hot": lambda: draw.choice([5, 5, draw.randrange(10)]),
        "nulls": lambda: draw.choice([None, draw.randrange(1000)]),
        "floats": lambda: draw.choice([NAN, float("inf"), -0.5, draw.random()]),
    }[shape]
    kind = "double" if shape == "floats" else "bigint"
    rows = [(lead(), draw.randrange(1000)) for _ in range(4000)]
    frame = spark.createDataFrame(rows, f"a {kind}, b bigint").repartition(6)
    expected = list(map(repr, expected_cap(rows, count)))
    monkeypatch.setattr(caps, "TAKEN_ROWS", 20)
    found = [tuple(row) for row in ordered_cap(frame, count, ["a", "b"]).collect()]
    assert list(map(repr, found)) == expected


def test_cap_is_sorted_whatever_its_size(spark):
    frame = spark.range(0, 130_000, 1, 7).select((F.col("id") % 3).alias("hot"), F.xxhash64("id").alias("h"), F.lit(1).alias("_number"))
    expected = [tuple(row) for row in frame.orderBy("hot", "h").collect()]
    for count in (1_000, 1_001, 100_000, 100_001, 200_000):
        found = ordered_cap(frame, count, ["hot", "h"])
        assert found.columns == frame.columns
        assert [tuple(row) for row in found.collect()] == expected[:count]


def test_cap_among_ties(spark, monkeypatch):
    frame = spark.range(0, 5_000, 1, 5).select((F.col("id") % 2).alias("t"), "id")
    for taken in (10, 1_000):
        monkeypatch.setattr(caps, "TAKEN_ROWS", taken)
        for count in (1_500, 2_500, 2_501, 4_999):
            found = [row["t"] for row in ordered_cap(frame, count, ["t"]).collect()]
            assert found == [0] * min(count, 2_500) + [1] * max(0, count - 2_500)


def test_large_cap_takes_no_single_task(spark):
    plan = ordered_cap(spark.range(0, 10_000, 1, 4), 2_000, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "rangepartitioning" in plan and "Window" not in plan


def test_cap_by_text(spark):
    frame = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "t string, n int")
    assert [row["t"] for row in ordered_cap(frame, 2, ["t"]).collect()] == ["a", "b"]


def test_feed_has_all_rows_unless_told(spark):
    assert encode_feed(spark.range(60_000), ["id"], unique=True).count() == 60_000


def test_ordinals_keep_columns_of_the_names_used_inside(spark):
    frame = spark.createDataFrame([(2, 5, 6, 7, 8), (1, 5, 6, 7, 8)], "n int, _tie int, _at int, _block int, _offset int")
    assert tuples(with_ordinals(frame, ["n"])) == [(1, 5, 6, 7, 8, 0), (2, 5, 6, 7, 8, 1)]


def test_split_does_not_depend_on_layout(spark):
    rows = spark.range(10_000)
    first = {row["id"] for row in split_rows(rows.repartition(3), key="id")[0].collect()}
    train, holdout = split_rows(rows.repartition(8), key="id")
    second = {row["id"] for row in train.collect()}
    rest = {row["id"] for row in holdout.collect()}
    assert first == second
    assert not second & rest and len(second) + len(rest) == 10_000
    assert 0.78 < len(second) / 10_000 < 0.82
    other = {row["id"] for row in split_rows(rows, seed=1, key="id")[0].collect()}
    assert other != second


def test_random_split_covers_all_rows(spark):
    train, holdout = split_rows(spark.range(1000))
    assert train.count() + holdout.count() == 1000
    assert train.join(holdout, "id").count() == 0
