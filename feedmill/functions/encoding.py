"""JSON rows and delimited lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.values import as_column, field


def row_json(columns: Sequence[str]) -> Column:
    """The named columns as one JSON object text; null columns are left out."""
    return F.to_json(F.struct(*[field(name) for name in columns]))


def text_schema(names: Sequence[str]) -> T.StructType:
    """Every field a nullable string, as raw feeds are read."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def positional_json(*values: Column | str) -> Column:
    """A JSON list of values of different types, in the given order."""
    return F.to_json(F.array(*[as_column(value).cast("variant") for value in values]))


def line_fields(line: Column | str, names: Sequence[str], sep: str = ";", quote: str = '"') -> list[Column]:
    """The parts of a delimited line under the given names, quotes removed.

    A short line gives null for the missing parts. The split appears once per
    name here; code generation evaluates it once per row.
    """
    parts = F.split(as_column(line), re.escape(sep))
    return [
        F.replace(F.get(parts, F.lit(place)), F.lit(quote), F.lit("")).alias(name)
        for place, name in enumerate(names)
    ]


def decode_json(bronze: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Parse the JSON text and spread its fields; text that fails gives nulls.

    The one-element inline keeps later filters above the parse. Spread by a
    plain select, a filter on a field would be moved below it, and every row
    would be parsed again for each filtered field.
    """
    return bronze.select(F.inline(F.array(F.from_json(field(value), schema))))


def only_value(bronze: DataFrame, name: str = "line", value: str = "value") -> DataFrame:
    """The value of one-field JSON objects, whatever the field is called; null where the text is no object.

    Rows under different names, odd rows and broken ones stand side by side;
    no schema is taken from any of them. Of several fields the first counts.
    """
    fields = F.map_values(F.from_json(field(value), "map<string,string>"))
    return bronze.select(F.inline(F.array(F.struct(F.get(fields, F.lit(0)).alias(name)))))


def table_schema(bronze: DataFrame, value: str = "value") -> T.StructType:
    """The fields of all JSON objects of the table, each of a type that holds all its values, in order of their names.

    One aggregate merges the types of all rows, a few at a time, and only the merged
    type comes to the driver. Text that is no JSON, or no object, has no say. Whole
    numbers are bigint, other ones double; fields whose values agree on no type are text, and
    so are those that are null everywhere. Fails where no row holds a field.
    """
    parsed = F.try_parse_json(field(value))
    objects = F.when(F.schema_of_variant(parsed).startswith("OBJECT<"), parsed)
    merged = bronze.agg(F.schema_of_variant_agg(objects).alias("merged")).first()["merged"]
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        raise ValueError("no row holds a JSON object with fields")
    return as_text_where_mixed(T.DataType.fromDDL(merged.replace("OBJECT<", "STRUCT<")))


def as_text_where_mixed(kind: T.DataType) -> T.DataType:
    """The type, with text for values of several types (variant) and for nothing but nulls (void), and double for decimals."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(part.name, as_text_where_mixed(part.dataType)) for part in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text_where_mixed(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def decode_table(bronze: DataFrame, value: str = "value") -> DataFrame:
    """All fields of JSON objects whose fields are not known beforehand.

    Every row is parsed once more with the merged types; fields that a row lacks are null, and so are
    all fields of text that is no object. No row is lost.
    """
    return decode_json(bronze, table_schema(bronze, value), value)


def sampled_schema(bronze: DataFrame, value: str = "value") -> T.StructType:
    """Schema of one row's JSON, which then stands for the whole table; for parity with feeds read that way.

    Only that row comes to the driver.
    """
    first = bronze.select(field(value).alias("value")).where("value IS NOT NULL").first()
    if first is None:
        raise ValueError("no rows to take a JSON schema from")
    try:
        ddl = bronze.sparkSession.range(1).select(F.schema_of_json(F.lit(first["value"])).alias("ddl")).first()["ddl"]
        schema = T.DataType.fromDDL(ddl)
    except (PySparkException, Py4JJavaError):
        schema = None
    if not isinstance(schema, T.StructType) or not schema.names:
        raise ValueError(f"the sampled row holds no JSON object: {first['value'][:200]!r}")
    return schema
