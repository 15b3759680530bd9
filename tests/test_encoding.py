import json

import pytest

from feedmill import fixed_values as fixed
from feedmill.functions.encoding import (
    decode_json,
    decode_table,
    line_fields,
    only_value,
    positional_json,
    row_json,
    sampled_schema,
    table_schema,
    text_schema,
)
from feedmill.plans import marketing
from feedmill.plans.feed import encode_rows
from feedmill.sources.tables import read_csv

HEADER = ";".join(f'"{name}"' for name in fixed.MARKETING_FIELDS)


def values_frame(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_null_fields_are_left_out(spark):
    frame = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert json.loads(frame.select(row_json(frame.columns).alias("value")).first()["value"]) == {"a": 1, "c": "x"}


def test_fixed_schema_edges(spark):
    bronze = values_frame(
        spark, '{"a":5000.0,"b":" 36 months","c":{"x":1}}', "{bad", None, '[{"a":1}]', '{"a":null}', ""
    )
    rows = [tuple(row) for row in decode_json(bronze, text_schema(["a", "b", "c"])).collect()]
    assert rows == [("5000.0", " 36 months", '{"x":1}'), *[(None, None, None)] * 5]


def test_every_row_brings_its_own_field_name(spark):
    bronze = values_frame(spark, '{"odd":"1"}', '{"a":"x;y"}', '{"b":7}', "{bad", None, '["x"]', "{}", '{"a":null}')
    assert [row["line"] for row in only_value(bronze).collect()] == ["1", "x;y", "7", None, None, None, None, None]


def test_contacts_under_two_headers_are_all_found(spark):
    line = '58;management;married;tertiary;no;2143;yes;no;unknown;5;may;261;1;-1;0;unknown;yes'
    texts = ['{"odd":"1"}', "{bad", *[json.dumps({header: line}) for header in ("h1", "h2") for _ in range(30)]]
    found = marketing.silver(values_frame(spark, *texts))
    assert found.count() == 60
    first = marketing.silver(values_frame(spark, *texts[2:]).coalesce(1), schema_from_first_row=True)
    assert first.count() == 30


@pytest.mark.parametrize("text", ["7", "{bad", "[1]", "{}"])
def test_schema_of_one_row_needs_rows_and_objects(spark, text):
    with pytest.raises(ValueError):
        sampled_schema(spark.createDataFrame([], "value string"))
    with pytest.raises(ValueError, match="no JSON object"):
        sampled_schema(values_frame(spark, text))


def test_short_line_gives_nulls(spark):
    lines = spark.createDataFrame([('58;"management";"married"',), ("33",), (None,)], "line string")
    rows = [tuple(row) for row in lines.select(*line_fields("line", ["age", "job", "marital"])).collect()]
    assert rows == [("58", "management", "married"), ("33", None, None), (None, None, None)]


def test_positional_json(spark):
    frame = spark.createDataFrame([("A", 1.5, 3, None)], "a string, b double, c bigint, d string")
    assert frame.select(positional_json("a", "b", "c", "d").alias("j")).first()["j"] == '["A",1.5,3,null]'


def test_semicolon_file_read_as_comma_csv(spark, tmp_path):
    full = '58;"management";"married";"tertiary";"no";2143;"yes";"no";"unknown";5;"may";261;1;-1;0;"unknown";"yes"'
    (tmp_path / "bank.csv").write_text("\n".join([HEADER, full, "33", 'x1;"admin."', '44;"technician";"single"']) + "\n")
    lines = read_csv(spark, str(tmp_path / "bank.csv"))
    assert lines.columns == [HEADER]
    rows = marketing.silver(encode_rows(lines)).orderBy("age").collect()
    # The line without a job and the one without a number for the age are gone.
    assert [(row["age"], row["job"], row["balance"], row["y"], row["label"]) for row in rows] == [
        (44.0, "technician", None, None, 0.0), (58.0, "management", 2143.0, "yes", 1.0),
    ]


def test_semicolon_file_read_with_its_own_separator(spark, tmp_path):
    (tmp_path / "bank.csv").write_text('"age";"job"\n58;"management"\n')
    assert [tuple(row) for row in read_csv(spark, str(tmp_path / "bank.csv"), sep=";").collect()] == [("58", "management")]


def test_schema_of_the_whole_table(spark):
    rows = [
        '{"a":1,"b":"x","d":{"p":1}}', '{"a":2.5,"c":[1,2]}', '{"b":7,"d":{"q":"z"},"e":null}', "{bad", "[1]", "3", None, "", '{"odd name; \\"x\\"":true}',
        '{"c":["t"]}', '{"a":12345678901234}', "{}", '{"a":null}',
    ]
    bronze = spark.createDataFrame([(row,) for row in rows], "value string")
    decoded = decode_table(bronze)
    assert decoded.columns == ["a", "b", "c", "d", "e", 'odd name; "x"']
    types = {part.name: part.dataType.simpleString() for part in decoded.schema}
    assert types["b"] == types["e"] == "string" and types["c"] == "array<string>" and types["d"] == "struct<p:bigint,q:string>"
    found = decoded.collect()
    assert len(found) == len(rows)
    assert [None if row["a"] is None else float(row["a"]) for row in found] == [1, 2.5] + [None] * 8 + [12345678901234, None, None]
    assert [row["b"] for row in found][:3] == ["x", None, "7"]
    assert found[1]["c"] == ["1", "2"] and found[2]["d"].asDict() == {"p": None, "q": "z"} and found[8]['odd name; "x"'] is True
    assert all(value is None for at in (3, 4, 5, 6, 7) for value in found[at])


def test_whole_table_schema_needs_a_field(spark):
    for rows in ([], [(None,)], [("{}",)], [("[1]",), ("{bad",)]):
        with pytest.raises(ValueError, match="JSON object"):
            table_schema(spark.createDataFrame(rows, "value string"))
