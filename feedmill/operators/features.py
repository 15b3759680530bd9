"""Category indexes, feature vectors and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.values import field, unused
from feedmill.operators.ordinals import with_ordinals
from feedmill.sources.scratch import stage

INDEX_SUFFIX = "_idx"

# This many of the most frequent labels of a column go to all tasks; a label
# longer than LONG_LABEL goes as its checksum, so the broadcast has a bound.
HOT_LABELS = 10_000
LONG_LABEL = 64


def feature_stages(numeric: Sequence[str], categorical: Sequence[str], scale: bool) -> Pipeline:
    """Assemble numbers and category indexes to one vector, scale it if asked to.

    Rows with a null or NaN number are left out. Scaling divides by the sample
    standard deviation and does not centre. It also drops the mark that index
    columns are categories, so forests on scaled vectors treat them as numbers.
    """
    indexes = [name + INDEX_SUFFIX for name in categorical]
    assembled = "unscaled_features" if scale else "features"
    stages = [VectorAssembler(inputCols=[*numeric, *indexes], outputCol=assembled, handleInvalid="skip")]
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withStd=True, withMean=False))
    return Pipeline(stages=stages)


def add_features(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    scale: bool = False,
    fit_rows: DataFrame | None = None,
    hot_labels: int = HOT_LABELS,
) -> tuple[DataFrame, PipelineModel]:
    """The frame with its features, and the fitted stages behind the indexes.

    Fitted on all rows of the frame unless ``fit_rows`` names others, such as
    the training part alone. Categories are numbered by ``with_places``, the
    same way whatever their number.
    """
    seen = df if fit_rows is None else fit_rows
    if categorical:
        places, sizes = category_places(category_counts(seen, categorical))
        df = with_places(df, categorical, places, sizes, hot_labels)
        seen = df if fit_rows is None else with_places(seen, categorical, places, sizes, hot_labels)
    source = seen.select(*[field(name) for name in [*numeric, *[name + INDEX_SUFFIX for name in categorical]]])
    model = feature_stages(numeric, categorical, scale).fit(source)
    return model.transform(df), model


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Staged rows per column and category, nulls left out; one pass for all columns.

    Counts combine before a shuffle that spreads the categories. Fitting an
    indexer would send the category table of every task to a single one.
    """
    pairs = [
        F.struct(F.lit(name).alias("_column"), field(name).cast("string").alias("_value")) for name in columns
    ]
    categories = df.select(F.inline(F.array(*pairs))).where(F.col("_value").isNotNull())
    return stage(categories.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n")), "categories")


def category_places(counts: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Every category with its number in its column, by falling count, then text; and the categories per column.

    All columns are numbered in one go; one row per column comes to the driver.
    """
    numbered = with_ordinals(counts, ["_column", F.desc("_n"), "_value"], name="_ordinal", unique=True)
    numbered = stage(numbered.select("_column", "_value", "_ordinal"), "places")
    ranges = numbered.groupBy("_column").agg(F.min("_ordinal").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    if not ranges:
        return numbered.select("_column", "_value", F.lit(0.0).alias("_place")), {}
    first = F.create_map(*[F.lit(item) for row in ranges for item in (row["_column"], row["first"])])
    place = (F.col("_ordinal") - F.element_at(first, F.col("_column"))).cast("double")
    return numbered.select("_column", "_value", place.alias("_place")), {row["_column"]: row["n"] for row in ranges}


def label_key(text: Column) -> Column:
    """The text, or a checksum in its place where it is long."""
    return F.when(F.length(text) <= LONG_LABEL, text).otherwise(F.concat(F.lit("\u0000md5 "), F.md5(text)))


def with_places(
    df: DataFrame, columns: Sequence[str], places: DataFrame, sizes: Mapping[str, int], hot_labels: int = HOT_LABELS
) -> DataFrame:
    """The frame with the number of each category; unseen and null share the one after the last.

    The frequent labels of all columns are joined by broadcast in one pass, so
    rows of a hot value are not shuffled. Only rows with a label that is not
    among them go through a second pass, in which the rare labels are joined by
    a shuffle, column after column; what such a row has found already gets a
    key of its own there, so that it does not meet in one task. Two passes,
    however many columns there are.
    """
    salt = F.xxhash64(*[field(name).cast("string") for name in columns]).cast("string")
    keyed, found, last = df, {}, {}
    for at, column in enumerate(columns):
        text, label, place = field(column).cast("string"), unused(df, f"_label_{at}"), unused(df, f"_place_{at}")
        own = places.where((F.col("_column") == column) & (F.col("_place") < hot_labels))
        hot = own.select(label_key(F.col("_value")).alias(label), F.col("_place").alias(place))
        keyed = keyed.join(F.broadcast(hot), label_key(text) == F.col(label), "left").drop(label)
        last[column] = F.lit(float(sizes.get(column, 0)))
        found[column] = F.when(text.isNull(), last[column]).otherwise(F.col(place))
    open_ = reduce(or_, [number.isNull() for number in found.values()])
    done = keyed.where(~open_).select(*_indexed(df, found))
    rest, rare = keyed.where(open_), {}
    for at, column in enumerate(columns):
        rare[column] = F.coalesce(found[column], last[column])
        if sizes.get(column, 0) > hot_labels:
            label, place = unused(df, f"_rare_{at}"), unused(df, f"_rare_place_{at}")
            own = places.where((F.col("_column") == column) & (F.col("_place") >= hot_labels))
            cold = own.select(F.col("_value").alias(label), F.col("_place").alias(place))
            missing = found[column].isNull()
            key = F.when(missing, field(column).cast("string")).otherwise(F.concat(F.lit("\u0000"), salt))
            rest = rest.join(cold, (key == F.col(label)) & missing, "left").drop(label)
            rare[column] = F.coalesce(found[column], F.col(place), last[column])
    both = done.unionByName(rest.select(*_indexed(df, rare)))
    # Learners take a column with this mark for a category of so many values.
    marks = {
        name + INDEX_SUFFIX: {"ml_attr": {"type": "nominal", "name": name + INDEX_SUFFIX, "num_vals": sizes.get(name, 0) + 1}}
        for name in columns
    }
    return both.select(*[field(name).alias(name, metadata=marks[name]) if name in marks else field(name) for name in both.columns])


def _indexed(df: DataFrame, numbers: Mapping[str, Column]) -> list[Column]:
    return [field(name) for name in df.columns] + [number.alias(name + INDEX_SUFFIX) for name, number in numbers.items()]
