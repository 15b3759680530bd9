"""Stream of text values into a versioned bronze table.

Every batch is written to a folder of its own name and counts once a version of the ledger names
that folder. A version is the list of all live folders, with their batches, rows and
running totals, written under a new number and never changed. Readers take one version and read its
folders, so they see whole batches only, and go on reading it while later ones are
written. A batch that is written again takes the place of its earlier folder; what a
crash left behind is named by no version, and ``sweep`` deletes it.

``compact`` folds finished batches into one folder, and many folds of a size into
a larger one, so a row is rewritten a logarithmic number of times and a version names
few folders. Two writers at once are told apart by the version's number: the later one
takes up the new version and tries again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmill import fixed_values as fixed
from feedmill.sources.scratch import children, delete, exists
from feedmill.sources.tables import append_table, replace_table

VERSION_SCHEMA = "folder string, first bigint, batch bigint, rows bigint, total_rows bigint, level int"
# Batches that may wait for a fold, folds of one size that make up a larger one, and versions that readers may still use.
FOLD_AFTER, FOLD_WIDTH, KEPT_VERSIONS = 500, 32, 100
LEFTOVER_SECONDS = 3_600
# Batches that a backlog comes in; a batch costs about the same at any size.
BACKLOG_BATCHES = 64


class Live(NamedTuple):
    """A folder of a version: its batches, its rows, all rows up to and with it, and how often it was folded."""

    folder: str
    first: int
    batch: int
    rows: int
    total_rows: int
    level: int


def topic_stream(spark: SparkSession, topic: str, **options: str) -> DataFrame:
    """One topic from its earliest offset; set ``maxOffsetsPerTrigger`` for a long backlog."""
    named = {"subscribe": topic, "startingOffsets": "earliest", **options}
    return spark.readStream.format("kafka").options(**named).load()


def file_stream(spark: SparkSession, path: str, fmt: str = "text", schema: str = "value string", **options: str) -> DataFrame:
    """New files of a folder; ``maxFilesPerTrigger`` bounds a batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def backlog_files(files: int, least: int, batches: int = BACKLOG_BATCHES) -> int:
    """Files per batch that take a backlog of so many files in at most ``batches`` batches, ``least`` or more."""
    return max(least, -(-files // batches))


class BronzeWriter:
    """The function a stream calls for each batch of values; folds when ``fold_after`` batches have come together.

    It remembers the version it has written, so a batch neither lists the ledger nor reads that version again.
    """

    def __init__(self, bronze: str, ledger: str, fmt: str = "parquet", fold_after: int | None = FOLD_AFTER):
        self.bronze = bronze
        self.ledger = ledger
        self.fmt = fmt
        self.fold_after = fold_after
        self._known: tuple[int, list[Live]] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._known = latest(spark, self.ledger, self._known)
        live = self._known[1]
        if any(item.level and item.first <= batch_id <= item.batch for item in live):
            return  # folded, so it was finished before
        folder, rows = self._write(batch, batch_id)

        def replaced(items: list[Live]) -> list[Live]:
            others = [item for item in items if item.level or item.batch != batch_id]
            return [*others, Live(folder, batch_id, batch_id, rows, 0, 0)] if rows else others

        self._known = advance(spark, self.ledger, replaced, self._known)
        waiting = sum(not item.level for item in live)
        if self.fold_after is not None and self.fmt != "delta" and waiting >= self.fold_after:
            compact(spark, self.bronze, self.ledger, self.fmt)

    def _write(self, batch: DataFrame, batch_id: int) -> tuple[str, int]:
        if self.fmt == "delta":
            # The table's own transaction marker makes a repeated append a no-op.
            kept = batch.persist()
            try:
                append_table(kept, self.bronze, "delta", txnAppId=self.bronze, txnVersion=str(batch_id))
                return "", kept.count()
            finally:
                kept.unpersist()
        folder = f"batch-{batch_id}-{uuid.uuid4().hex}"
        return folder, replace_table(batch, f"{self.bronze}/{folder}", self.fmt)


def start_ingest(
    source: DataFrame,
    bronze: str,
    ledger: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = fixed.INGEST_TRIGGER,
) -> StreamingQuery:
    """Start the ingest; only ``value``, as text, is kept.

    ``trigger`` is the time between batches. None takes what is there now,
    batch by batch, and ends: the mode for backfills.
    """
    values = source.select(F.col("value").cast("string").alias("value"))
    writer = values.writeStream.foreachBatch(BronzeWriter(bronze, ledger, fmt)).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def bronze_table(
    spark: SparkSession, path: str, fmt: str = "parquet", ledger: str | None = None, version: int | None = None
) -> DataFrame:
    """The values of all finished batches, of the last version of the ledger or of the one given.

    Delta's log knows its versions itself and needs no ledger.
    """
    if fmt == "delta":
        return spark.read.format(fmt).load(path).select("value")
    if ledger is None:
        raise ValueError(f"{path}: name the ledger, which knows the folders that count")
    live = latest(spark, ledger)[1] if version is None else entries(spark, ledger, version)
    if not live:
        return spark.createDataFrame([], "value string")
    return spark.read.format(fmt).schema("value string").load([f"{path}/{item.folder}" for item in live])


def ledger_table(spark: SparkSession, ledger: str, version: int | None = None) -> DataFrame:
    """One row per live folder: its last batch, its rows, and all rows up to and with it."""
    number = latest_number(spark, ledger) if version is None else version
    if number == 0:
        return spark.createDataFrame([], VERSION_SCHEMA).select("batch", "rows", "total_rows")
    return read_version(spark, ledger, number).select("batch", "rows", "total_rows")


def read_version(spark: SparkSession, ledger: str, version: int) -> DataFrame:
    return spark.read.schema(VERSION_SCHEMA).parquet(f"{ledger}/version-{version}")


def entries(spark: SparkSession, ledger: str, version: int) -> list[Live]:
    """The folders of a version in order; ``compact`` keeps them few."""
    return sorted((Live(*row) for row in read_version(spark, ledger, version).collect()), key=lambda item: item.batch)


def version_numbers(spark: SparkSession, ledger: str) -> list[int]:
    """All versions that were begun, the latest first."""
    names = [name.removeprefix("version-") for name in children(spark, ledger) if name.startswith("version-")]
    return sorted((int(name) for name in names if name.isdigit()), reverse=True)


def is_written(spark: SparkSession, ledger: str, version: int) -> bool:
    """Whether the write of a version came to its end."""
    return exists(spark, f"{ledger}/version-{version}/_SUCCESS")


def latest_number(spark: SparkSession, ledger: str) -> int:
    return next((number for number in version_numbers(spark, ledger) if is_written(spark, ledger, number)), 0)


def latest(spark: SparkSession, ledger: str, known: tuple[int, list[Live]] | None = None) -> tuple[int, list[Live]]:
    """Number and folders of the last version; 0 and none before the first.

    From a version that is ``known`` the next numbers are tried one by one. Old versions are deleted
    in their order, so as long as one stands, none after it is gone, and the list is not needed.
    """
    if known is not None:
        number = known[0]
        while is_written(spark, ledger, number + 1):
            number += 1
        if number and is_written(spark, ledger, number):
            return known if number == known[0] else (number, entries(spark, ledger, number))
    number = latest_number(spark, ledger)
    return number, entries(spark, ledger, number) if number else []


def with_totals(live: Sequence[Live]) -> list[Live]:
    """The folders in order, with all rows up to and with each."""
    total, counted = 0, []
    for item in sorted(live, key=lambda item: item.batch):
        total += item.rows
        counted.append(item._replace(total_rows=total))
    return counted


def commit(spark: SparkSession, ledger: str, version: int, live: Sequence[Live]) -> bool:
    """Write a version; False if another writer has written that number."""
    if is_written(spark, ledger, version):
        return False
    path = f"{ledger}/version-{version}"
    if exists(spark, path):
        delete(spark, path)  # begun by a writer that did not come to the end
    # As one literal: rows made from a Python list would go through a Python worker.
    listed = F.from_json(F.lit(json.dumps([item._asdict() for item in with_totals(live)])), f"array<struct<{VERSION_SCHEMA}>>")
    try:
        spark.range(0, 1, 1, 1).select(F.inline(listed)).write.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return False
    return True


def advance(
    spark: SparkSession, ledger: str, change: Callable[[list[Live]], list[Live]], known: tuple[int, list[Live]] | None = None
) -> tuple[int, list[Live]]:
    """Write the next version with the changed list of folders; returns its number and folders."""
    while True:
        number, live = known = latest(spark, ledger, known)
        changed = change(live)
        if changed == live:
            return known
        if commit(spark, ledger, number + 1, changed):
            return number + 1, with_totals(changed)


def update(spark: SparkSession, ledger: str, change: Callable[[list[Live]], list[Live]]) -> int:
    """Write the next version with the changed list of folders; returns its number."""
    return advance(spark, ledger, change)[0]


def fold(spark: SparkSession, bronze: str, ledger: str, fmt: str, items: Sequence[Live]) -> None:
    """Put the rows of neighbouring folders into one, and let a version name it instead."""
    folder = f"fold-{items[-1].batch}-{uuid.uuid4().hex}"
    rows = spark.read.format(fmt).schema("value string").load([f"{bronze}/{item.folder}" for item in items])
    written = replace_table(rows, f"{bronze}/{folder}", fmt)
    if written != sum(item.rows for item in items):
        raise RuntimeError(f"{bronze}: {written} rows in batches {items[0].first} to {items[-1].batch}, not those of the ledger")
    folders, level = {item.folder for item in items}, items[0].level + 1

    def folded(live: list[Live]) -> list[Live]:
        if not folders <= {item.folder for item in live}:
            return live  # another writer was faster; the folder written here is swept
        others = [item for item in live if item.folder not in folders]
        return [*others, Live(folder, items[0].first, items[-1].batch, written, 0, level)]

    update(spark, ledger, folded)


def compact(
    spark: SparkSession, bronze: str, ledger: str, fmt: str = "parquet", keep: int = 2, kept_versions: int = KEPT_VERSIONS,
    leftover_seconds: float = LEFTOVER_SECONDS,
) -> int:
    """Fold all finished batches but the last ``keep``, which a restart may write again; returns how many were folded.

    ``FOLD_WIDTH`` folds of one size are folded again. At the end what no kept version
    names is swept. Delta compacts by itself.
    """
    if fmt == "delta":
        raise ValueError("compact a Delta table by its own command")
    if keep < 1:
        raise ValueError("the last batch cannot be folded: a restart may write it again")
    done, level = 0, 0
    while True:
        same = [item for item in latest(spark, ledger)[1] if item.level == level]
        items, least = (same[:-keep], 2) if level == 0 else (same, FOLD_WIDTH)
        if len(items) < least:
            if level and not same:
                break
        else:
            fold(spark, bronze, ledger, fmt, items)
            done += len(items) if level == 0 else 0
        level += 1
    sweep(spark, bronze, ledger, kept_versions, leftover_seconds)
    return done


def sweep(
    spark: SparkSession, bronze: str, ledger: str, kept_versions: int = KEPT_VERSIONS, leftover_seconds: float = LEFTOVER_SECONDS
) -> int:
    """Delete all but the last versions, and the folders none of these names; returns how many folders went.

    Folders changed within ``leftover_seconds`` stay: a writer may be about to name them. A
    crash on the way leaves folders that the next sweep finds.
    """
    written = [number for number in version_numbers(spark, ledger) if is_written(spark, ledger, number)]
    kept = written[: max(kept_versions, 1)]
    if not kept:
        return 0
    named = {item.folder for number in kept for item in entries(spark, ledger, number)}
    for number in reversed(version_numbers(spark, ledger)):  # the oldest first, see ``latest``
        if number < kept[-1]:
            delete(spark, f"{ledger}/version-{number}")
    before = time.time() - leftover_seconds
    unnamed = [name for name, changed in children(spark, bronze).items() if name not in named and changed <= before]
    leftovers = [name for name in unnamed if name.startswith(("batch-", "fold-"))]
    for name in leftovers:
        delete(spark, f"{bronze}/{name}")
    return len(leftovers)
