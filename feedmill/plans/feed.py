"""Rows to an ordered feed of JSON values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.functions.encoding import row_json
from feedmill.functions.values import unused
from feedmill.operators.caps import ordered_cap
from feedmill.operators.ordinals import with_chunks, with_ordinals
from feedmill.sources.tables import in_chunks


def encode_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in the column ``value``."""
    return df.select(row_json(df.columns).alias("value"))


def encode_feed(
    df: DataFrame,
    order_by: Sequence[str] | None = None,
    rows: int | None = None,
    chunk_rows: int = fixed.FEED_CHUNK_ROWS,
    unique: bool = False,
) -> DataFrame:
    """``ordinal``, ``chunk`` and ``value`` of all rows, or of the first ``rows`` ones.

    Without ``order_by`` the rows keep the order of the scan, for one CSV file
    that of its lines; the frame must then come straight from files. Say
    ``unique`` where ``order_by`` names a key: that saves a copy.

    All chunks come out of one pass, so publishing is one write instead of a
    read of the source per chunk.
    """
    names = df.columns
    if order_by is None:
        line = unused(df, "_line")
        df, order_by, unique = df.withColumn(line, F.monotonically_increasing_id()), [line], True
    capped = df if rows is None else ordered_cap(df, rows, order_by)
    numbered = with_chunks(with_ordinals(capped, order_by, "_ordinal", unique), chunk_rows, "_ordinal", "_chunk")
    return numbered.select(
        F.col("_ordinal").alias("ordinal"), F.col("_chunk").alias("chunk"), row_json(names).alias("value")
    )


def write_feed_files(feed: DataFrame, path: str, chunk_rows: int = fixed.FEED_CHUNK_ROWS) -> None:
    """The values as text files of at most ``chunk_rows`` lines each, every chunk's rows in order in one file."""
    in_chunks(feed).select("value").write.mode("append").option("maxRecordsPerFile", chunk_rows).text(path)
