"""Generated inputs against plain Python."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedmill.functions.encoding import decode_json, line_fields, row_json, text_schema
from feedmill.functions.values import bucket_floor
from feedmill.operators.counting import count_by

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.text(st.characters(exclude_categories=("Cs",)), max_size=12)


@few
@given(values=st.lists(st.floats(-1e12, 1e12), min_size=1, max_size=40), width=st.integers(1, 10_000))
def test_buckets(spark, values, width):
    frame = spark.createDataFrame(list(enumerate(values)), "place int, v double")
    found = frame.select("place", bucket_floor("v", width).alias("b")).orderBy("place").collect()
    assert [row["b"] for row in found] == [str(math.floor(value / width) * width) for value in values]


@few
@given(rows=st.lists(st.tuples(st.none() | texts, st.none() | texts), min_size=1, max_size=20))
def test_json_there_and_back(spark, rows):
    names = ["a b", 'c"`;d']
    frame = spark.createDataFrame(rows, text_schema(names))
    found = decode_json(frame.select(row_json(names).alias("value")), text_schema(names)).collect()
    assert sorted(map(repr, (tuple(row) for row in found))) == sorted(map(repr, rows))


@few
@given(rows=st.lists(st.lists(st.text("ab 1.", max_size=5), min_size=1, max_size=5), min_size=1, max_size=20))
def test_lines(spark, rows):
    lines = [(place, ";".join(f'"{part}"' for part in row)) for place, row in enumerate(rows)]
    frame = spark.createDataFrame(lines, "place int, line string")
    found = frame.select("place", *line_fields("line", ["x", "y", "z"])).orderBy("place").collect()
    assert [tuple(row)[1:] for row in found] == [tuple((row + [None] * 3)[:3]) for row in rows]


@few
@given(rows=st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from([0.0, 1.0, None])), min_size=1, max_size=60))
def test_counts(spark, rows):
    frame = spark.createDataFrame(rows, "grade string, prediction double")
    found = {(row["grade"], row["prediction"]): row["count"] for row in count_by(frame, "grade", "prediction").collect()}
    assert found == {key: rows.count(key) for key in rows}
