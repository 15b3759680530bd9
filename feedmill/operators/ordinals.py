"""Row ordinals, slices and chunks without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.values import as_column, field, unused
from feedmill.sources.scratch import stage

# monotonically_increasing_id keeps the task number above 33 bits of row number.
ROW_BITS = 33


def with_ordinals(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "ordinal", unique: bool = False,
    blocks: int | None = None, stored: bool = False,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order.

    One range shuffle sorts the rows into blocks; the staged table keeps block
    and place of every row; block sizes add up to offsets.

    Say ``unique`` where no two rows tie on ``order_by``. Otherwise a row's address, its file and
    its place there, tells tied rows apart, so that a key that holds a third of the
    rows, or a third of rows that are all the same, spreads over many blocks, and a
    scan that is repeated after the loss of an executor gives the same numbers. Only the order
    columns and the address are sorted and staged then; the numbers come back to the rows by
    address.

    Say ``stored`` where the rows come straight from Parquet files that stay as they are, each
    file read once, columns chosen and rows filtered but nothing joined or exploded: their
    addresses are taken as they are. Other rows are staged once to have one.
    """
    order, names = [as_column(item) for item in order_by], df.columns
    file, row, at, block, offset, number = [
        unused(df, own) for own in ("_file", "_row", "_at", "_block", "_offset", "_number")
    ]
    by_address = False
    if not unique:
        df = df if stored else stage(df, "rows")
        address = df.metadataColumn("_metadata")
        df = df.select(
            *[field(column) for column in names],
            address.getField("file_path").alias(file), address.getField("row_index").alias(row),
        )
        order += [F.col(file), F.col(row)]
        # Rows that are no more than their order columns carry themselves.
        by_address = not set(names) <= {item for item in order_by if isinstance(item, str)}
    ranged = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    carried = [file, row] if by_address else names
    placed = ranged.sortWithinPartitions(*order).select(
        *[field(column) for column in carried], F.monotonically_increasing_id().alias(at)
    )
    staged = stage(placed, "ordinals").withColumn(block, F.shiftright(at, ROW_BITS))

    sizes = staged.groupBy(block).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per block, so at most one per shuffle partition: small enough for
    # one task and for a broadcast whatever the size of the table.
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(block, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(offset))

    place = F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = staged.join(F.broadcast(offsets), block).select(
        *[field(column) for column in carried], (F.col(offset) + place).alias(number)
    )
    if by_address:
        numbered = df.join(numbered, [file, row])
    return numbered.select(*[field(column) for column in names], F.col(number).alias(name))


def slice_rows(df: DataFrame, start: int, stop: int, ordinal: str = "ordinal") -> DataFrame:
    """Rows with start <= ordinal < stop."""
    return df.where((field(ordinal) >= start) & (field(ordinal) < stop))


def with_chunks(df: DataFrame, rows: int, ordinal: str = "ordinal", name: str = "chunk") -> DataFrame:
    """All slices of ``rows`` rows at once: the number of the slice as a column."""
    return df.withColumn(name, F.floor(field(ordinal) / F.lit(rows)))
