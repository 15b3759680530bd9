"""What several operators share: reading tables, staging, words and their hashes.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab,
form feed and carriage return; ``bytes.split`` splits at exactly these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.sources.scratch import stage

__all__ = [
    "SHINGLE_WORDS", "connected", "free_name", "keys_of_several", "own_columns", "partitions", "small_batches", "stage", "table",
    "window_hashes", "word_hashes", "word_shingles", "words",
]

SHINGLE_WORDS = 5
BATCH_BYTES = 4 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_MIXER = 0xD6E8FEB86659FD93
_CHUNK = 1 << 20
_powers = [np.empty(0, np.uint64), np.empty(0, np.uint64)]

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_VALUES = np.random.Generator(np.random.PCG64(20240611)).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_LOWER_VALUES = _VALUES.copy()
_LOWER_VALUES[65:91] = _VALUES[97:123]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of the frame has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def own_columns(df: DataFrame) -> list:
    """The frame's columns, also those with dots in their names."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python workers some megabytes at a time, however long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text; with ``lower``, A-Z become a-z and nothing else changes."""
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, one after the other, and where each text begins and the last ends; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    edges = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, edges - edges[0]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, kept for chunks of the usual size."""
    if count > len(_powers[0]):
        size = max(count, _CHUNK)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)]) for base in (_MULTIPLIER, inverse)]
    return _powers[0][:count], _powers[1][:count]


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a column of texts, and where each text's words begin and the last ones end.

    A word's hash is a polynomial of its bytes, each byte standing for a random
    number: differences of running sums, for a chunk of words at a time. With
    ``lower``, A-Z stand for the same numbers as a-z.
    """
    raw, edges = text_bytes(column)
    solid = _SOLID[raw]
    cuts = np.zeros(len(raw) + 1, bool)  # a text begins here, so no word goes on
    cuts[edges] = True
    before = np.r_[False, solid[:-1]] & ~cuts[:-1] if len(raw) else solid
    after = np.r_[solid[1:], False] & ~cuts[1:] if len(raw) else solid
    begins, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    values = _LOWER_VALUES if lower else _VALUES
    hashes, at = np.empty(len(begins), np.uint64), 0
    while at < len(begins):
        low = begins[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        part = raw[low : ends[stop - 1]]
        power, inverse = powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * power, out=sums[1:])
        first = begins[at:stop] - low
        hashes[at:stop] = (sums[ends[at:stop] - low] - sums[first]) * inverse[first]
        at = stop
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(_MIXER)
    hashes ^= hashes >> np.uint64(29)
    return hashes, np.searchsorted(begins, edges)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive values, by doubling.

    Runs of 1, 2, 4, ... values are combined pairwise; those that ``width`` has as
    binary digits are put together.
    """
    count = len(values) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total, have, block, span = np.zeros(count, np.uint64), 0, values, 1
    while True:
        factor = np.uint64(pow(_MULTIPLIER, span, 1 << 64))
        if width & span:
            total = total * factor + block[have : have + count]
            have += span
        if have == width:
            return total
        block = block[:-span] * factor + block[span:]
        span *= 2


def word_shingles(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words make one shingle, none make none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes, min(size, len(hashes))))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keys_of_several(rows: DataFrame, key: str, owner: str) -> DataFrame:
    """The rows whose key several owners have, and some few others.

    Key, owner and all other columns are bigint. One range shuffle by key and owner
    puts a key's rows next to each other; a key that very many owners have is spread
    over several partitions. The first and last key of a partition may go on in the
    next one, so their rows are kept whatever their owners: callers must not mind
    rows of a key that has one owner after all.
    """
    names = rows.columns
    at_key, at_owner = names.index(key), names.index(owner)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, going, waiting = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
            if waiting is not None:
                data = np.concatenate([waiting, data], axis=1)
            keys, owners = data[at_key], data[at_owner]
            first = keys[0] if first is None else first
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            several = owners[starts] != owners[ends - 1]  # owners are sorted within a key
            several |= (keys[starts] == first) | (False if going is None else keys[starts] == going)
            going = keys[-1] if several[-1] else None  # more rows of this key are kept as they come
            take = np.repeat(several, ends - starts)
            waiting = None if several[-1] else data[:, starts[-1] :]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in data[:, take]], names=names)
        if waiting is not None:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in waiting], names=names)

    dealt = rows.repartitionByRange(partitions(rows.sparkSession), key, owner).sortWithinPartitions(key, owner)
    return dealt.mapInArrow(kept, rows.schema)


def connected(links: DataFrame, one: str, other: str) -> DataFrame:
    """Components of an undirected graph: (node, component), the component being its least node.

    Every round gives a node the least label among its neighbours' and its own, then
    the label of that label. Rounds are staged; they end when no label changes.
    """
    both = links.select(F.col(one).alias("node"), F.col(other).alias("near")).where("node <> near")
    edges = stage(both.unionByName(both.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct(), "edges")
    labels = stage(edges.groupBy("node").agg(F.least("node", F.min("near")).alias("component")), "labels")
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("component").alias("least"))
        lowered = labels.join(seen, "node").select("node", F.col("component").alias("was"), F.least("component", "least").alias("component"))
        jump = lowered.select(F.col("node").alias("component"), F.col("component").alias("next"))
        following = lowered.join(jump, "component").select("node", "was", F.col("next").alias("component"))
        following = stage(following, "labels")
        if following.where("was <> component").isEmpty():
            return following.select("node", "component")
        labels = following.select("node", "component")
