"""Lenient numbers, labels, buckets and bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed


def as_column(value: Column | str) -> Column:
    """A Column as it is; a name as a column, whatever characters it holds."""
    return field(value) if isinstance(value, str) else value


def field(name: str) -> Column:
    """Column by its exact name; dots, ``;``, quotes and backticks are allowed."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of the frame has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lenient_double(value: Column | str) -> Column:
    """Double, or null where the text is no number. Blanks around it are fine."""
    return as_column(value).try_cast("double")


def label_unless(value: Column | str, good: str) -> Column:
    """0.0 for the ``good`` text, 1.0 for anything else, null included."""
    return F.when(as_column(value) == good, 0.0).otherwise(1.0)


def label_if(value: Column | str, positive: str) -> Column:
    """1.0 for the ``positive`` text, 0.0 for anything else, null included."""
    return F.when(as_column(value) == positive, 1.0).otherwise(0.0)


def bucket_floor(value: Column | str, width: int = fixed.BALANCE_WIDTH) -> Column:
    """Left end of the fixed-width bucket, as text.

    Buckets are closed on the left, so -1 lies in the bucket that starts at
    -width. Null stays null, NaN lands in bucket 0, and a value whose bucket
    does not fit a bigint gets null instead of failing the job.
    """
    return F.try_multiply(F.floor(as_column(value) / width), F.lit(width)).cast("string")


def class_text(value: Column | str) -> Column:
    """A class number with one decimal; ``NaN`` where there is no number."""
    number = lenient_double(as_column(value).cast("string"))
    # Null is tested first: format_string would print it as the letter n.
    return F.when(number.isNull(), "NaN").otherwise(F.format_string("%.1f", number))


def loose_number(value: Column | str) -> Column:
    """Number of a text as the report reads it: null and blank count as 0."""
    text = as_column(value).cast("string")
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(blank, 0.0).otherwise(lenient_double(text))


def job_group(job: Column | str) -> Column:
    """office, labor or other, whatever the case of the job name."""
    name = F.lower(as_column(job))
    return (
        F.when(name.isin(fixed.OFFICE_JOBS), "office")
        .when(name.isin(fixed.LABOR_JOBS), "labor")
        .otherwise("other")
    )


def asset_band(bucket: Column | str) -> Column:
    """Band of a bucket's left end; text that is no number ends up in VIP."""
    left = loose_number(bucket)
    return (
        F.when(left < 0, "debt")
        .when(left <= fixed.LOW_BAND_TOP, "low")
        .when(left <= fixed.MIDDLE_BAND_TOP, "middle")
        .otherwise("VIP")
    )
