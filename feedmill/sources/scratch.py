"""The shared folder for staged tables.

Staging cuts lineage with a written table rather than with executor-local
blocks, so a lost executor costs a re-read and never a changed result.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a new temporary folder;
    a cluster session fails, because its executors would not share one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="feedmill-"))
    return context.getCheckpointDir().rstrip("/")


def session_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/feedmill-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the session folder that nothing else uses."""
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once and return a reader of the written table.

    The shuffles behind a written table are of no more use, so their files go with the write
    instead of staying until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(staged: DataFrame) -> None:
    """Delete the table that ``stage`` wrote for this frame. All frames read from it are gone too."""
    for path in {name.rsplit("/", 1)[0] for name in staged.inputFiles()}:
        delete(staged.sparkSession, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place).close()


def children(spark: SparkSession, path: str) -> dict[str, float]:
    """Name and time of change, in seconds, of what a folder holds; nothing where there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    return {item.getPath().getName(): item.getModificationTime() / 1000 for item in files.listStatus(folder)}


def release(spark: SparkSession) -> None:
    """Delete what this application staged. Frames read from it are gone too."""
    delete(spark, session_folder(spark))
