"""Tables that change together, in one or several places.

A release is a folder with all tables of one run. A place shows the release that its last
pointer names; pointers are small tables under rising numbers, written once and never
changed. All tables reach all places before the first pointer is written, so a place that
fails on the way leaves every place at its old release. Pointers follow one after the other:
where one of them fails, ``point`` with the same release brings the others up to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedmill.sources.scratch import children, delete, stage
from feedmill.sources.tables import read_table

POINTER_SCHEMA = "release string"
ATTEMPTS = 3


@dataclass(frozen=True)
class Place:
    """A folder with the releases of some tables, their format and its options."""

    root: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def attempt(times: int, action: Callable[[], None]) -> None:
    """Run an action, again after a failure, and raise the last one's error."""
    for left in range(times - 1, -1, -1):
        try:
            return action()
        except Exception:
            if not left:
                raise


def pointers(spark: SparkSession, place: Place) -> list[int]:
    """Numbers of the finished pointers, the latest first; unfinished ones are skipped."""
    names = [name.removeprefix("pointer-") for name in children(spark, place.root) if name.startswith("pointer-")]
    numbers = sorted((int(name) for name in names if name.isdigit()), reverse=True)
    return [number for number in numbers if "_SUCCESS" in children(spark, f"{place.root}/pointer-{number}")]


def named_release(spark: SparkSession, place: Place, number: int) -> str:
    return spark.read.schema(POINTER_SCHEMA).parquet(f"{place.root}/pointer-{number}").first()["release"]


def published(spark: SparkSession, place: Place) -> str | None:
    """The release that a place shows, None before the first."""
    numbers = pointers(spark, place)
    return named_release(spark, place, numbers[0]) if numbers else None


def read_published(spark: SparkSession, place: Place, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A table of the release that the place shows now; the frame stays with that release."""
    release = published(spark, place)
    if release is None:
        raise ValueError(f"{place.root}: nothing has been published")
    return read_table(spark, f"{place.root}/{release}/{name}", place.fmt, schema, **place.options)


def write_release(tables: Mapping[str, DataFrame], places: Sequence[Place], attempts: int = ATTEMPTS) -> str:
    """Write all tables to all places under a new release that nothing shows yet; returns its name.

    Every table is computed once, into a staged table that all places read; a write that failed
    starts again from there.
    """
    release = f"release-{uuid.uuid4().hex}"
    for name, table in tables.items():
        staged = stage(table, f"mart-{name}")
        for place in places:
            writer = staged.write.format(place.fmt).mode("overwrite").options(**place.options)
            attempt(attempts, lambda: writer.save(f"{place.root}/{release}/{name}"))
    return release


def point(spark: SparkSession, places: Sequence[Place], release: str, attempts: int = ATTEMPTS) -> None:
    """Let all places show a written release; places that show it already stay as they are."""
    for place in places:
        attempt(attempts, lambda: write_pointer(spark, place, release))


def write_pointer(spark: SparkSession, place: Place, release: str) -> None:
    """Write the next pointer; a number that another writer began first is passed over."""
    while published(spark, place) != release:
        begun = [name.removeprefix("pointer-") for name in children(spark, place.root) if name.startswith("pointer-")]
        number = max((int(name) for name in begun if name.isdigit()), default=0) + 1
        row = spark.createDataFrame([(release,)], POINTER_SCHEMA).coalesce(1)
        try:
            row.write.parquet(f"{place.root}/pointer-{number}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise


def publish_together(tables: Mapping[str, DataFrame], places: Sequence[Place], attempts: int = ATTEMPTS) -> str:
    """Write the tables to all places, then let all places show them."""
    spark = next(iter(tables.values())).sparkSession
    release = write_release(tables, places, attempts)
    point(spark, places, release, attempts)
    return release


def sweep_releases(spark: SparkSession, place: Place, kept: int = 2) -> int:
    """Delete all releases but those the last ``kept`` pointers name; returns how many went.

    Not while a release is being written: nothing names it yet.
    """
    if kept < 1:
        raise ValueError("the release that is shown stays")
    numbers = pointers(spark, place)
    if not numbers:
        return 0
    named = {named_release(spark, place, number) for number in numbers[:kept]}
    for number in numbers[kept:]:
        delete(spark, f"{place.root}/pointer-{number}")
    leftovers = [name for name in children(spark, place.root) if name.startswith("release-") and name not in named]
    for name in leftovers:
        delete(spark, f"{place.root}/{name}")
    return len(leftovers)
