"""Batch readers and writers. The format is always an argument.

Formats such as ``delta``, ``kafka`` or ``mongodb`` need their package on the
cluster; options, addresses and credentials come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    infer: bool = False,
) -> DataFrame:
    """CSV with a header line.

    Without a schema every column is text, which costs no extra pass and
    loses nothing when the rows are encoded as JSON text next. ``infer`` adds
    a full pass over the files to guess types.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_table(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet",
    schema: T.StructType | str | None = None, **options: str,
) -> DataFrame:
    """Scan a table; give the schema where known to skip footer or file sampling.

    Delta keeps the schema itself and takes none.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def append_table(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Add the rows to what the table holds."""
    df.write.format(fmt).mode("append").options(**options).save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> int:
    """Replace rows and schema; returns the number of rows now in the table."""
    if fmt == "delta":
        options = {"overwriteSchema": "true", **options}
    df.write.format(fmt).mode("overwrite").options(**options).save(path)
    return table_rows(df.sparkSession, path, fmt, df.schema)


def table_rows(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> int:
    """Rows of a written table.

    The scan asks for no column, so columnar formats answer from file footers
    and nothing is computed again. An Observation on the write would save that
    small job, but a session that has used one can no longer ship fitted MLlib models,
    whose training summaries hold the session.
    """
    return read_table(spark, path, fmt, schema).count()


def in_chunks(feed: DataFrame) -> DataFrame:
    """The feed with each chunk's rows in one task, in the order of their ordinals."""
    return feed.repartitionByRange("chunk").sortWithinPartitions("chunk", "ordinal")


HEADERS = ["chunk", "ordinal"]
MESSAGE_SCHEMA = "key string, value string, headers array<struct<key: string, value: binary>>, partition int"
# Formats with one text per row and nothing beside it.
BARE_FORMATS = ("text",)


def as_messages(feed: DataFrame, partitions: int | None = None) -> DataFrame:
    """A feed with ``chunk`` and ``ordinal`` as messages that say their place.

    ``headers`` hold both numbers as text, so a reader can restore the order whatever way
    the messages went. The chunk is the key. With ``partitions`` chunks are dealt out to
    so many, and one task sends all of a partition, so that each holds its chunks in order.
    """
    headers = F.array(*[
        F.struct(F.lit(name).alias("key"), F.col(name).cast("string").cast("binary").alias("value")) for name in HEADERS
    ])
    message = [F.col("chunk").cast("string").alias("key"), F.col("value"), headers.alias("headers")]
    if partitions is None:
        return in_chunks(feed).select(*message)
    dealt = feed.withColumn("partition", F.pmod("chunk", F.lit(partitions)).cast("int"))
    placed = dealt.repartitionByRange(partitions, "partition").sortWithinPartitions("partition", "chunk", "ordinal")
    return placed.select(*message, "partition")


def publish(df: DataFrame, fmt: str = "kafka", path: str | None = None, partitions: int | None = None, **options: str) -> None:
    """Send the ``value`` column to a topic, or append it to files.

    A feed with ``chunk`` and ``ordinal`` is sent chunk by chunk, in order; tasks send
    different chunks at once. Topics and formats with columns also get each row's
    place, see ``as_messages``; ``read_feed`` restores the order from it.
    """
    if not set(HEADERS) <= set(df.columns):
        messages = df.select("value")
    elif fmt in BARE_FORMATS:
        messages = in_chunks(df).select("value")
    else:
        messages = as_messages(df, partitions)
    writer = messages.write.format(fmt).options(**options)
    if fmt != "kafka":
        writer = writer.mode("append")
    writer.save(path) if path else writer.save()


def feed_places(messages: DataFrame) -> DataFrame:
    """``chunk``, ``ordinal`` and ``value`` of messages; works on streams too.

    Messages without headers have null places. A message that was delivered twice is there
    twice, with the same place: drop duplicates by ``ordinal`` where that matters.
    """
    held = F.map_from_entries(F.coalesce("headers", F.expr("array()").cast(messages.schema["headers"].dataType)))
    places = [F.try_element_at(held, F.lit(name)).cast("string").try_cast("bigint").alias(name) for name in HEADERS]
    return messages.select(*places, F.col("value").cast("string").alias("value"))


def read_feed(spark: SparkSession, path: str | None = None, fmt: str = "kafka", **options: str) -> DataFrame:
    """A published feed in the order of its ordinals: a range sort, so no task takes more than its range."""
    if fmt == "kafka":
        messages = read_table(spark, None, fmt, includeHeaders="true", **options)
    else:
        messages = read_table(spark, path, fmt, MESSAGE_SCHEMA, **options)
    return feed_places(messages).orderBy("ordinal")


@dataclass(frozen=True)
class Target:
    """One place a mart is written to."""

    fmt: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def fan_out(df: DataFrame, targets: Sequence[Target]) -> None:
    """Replace the same rows in every target, computing them once."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for target in targets:
            writer = kept.write.format(target.fmt).mode("overwrite").options(**target.options)
            writer.save(target.path) if target.path else writer.save()
    finally:
        kept.unpersist()
