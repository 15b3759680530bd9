"""MinHash fingerprints, and a near-duplicate join on their bands.

A document's set is its distinct shingles of five words, lower-cased; fewer words
are one shingle. Each of ``PERMUTATIONS`` universal hash functions
``(a * x + b) mod 2^64`` (upper 32 bits, a odd) takes its least value over the set,
for all functions at once in numpy. Of each least value 16 bits are kept. Equal
texts have equal fingerprints; the share of equal places estimates the Jaccard
similarity.

``near_duplicates`` joins in Spark: documents of equal sets become one class, class
signatures are cut into bands of four places, all classes that agree in a band are
compared with each other, and links are verified by the exact Jaccard similarity of
the two sets. The members of a band are dealt into blocks of about ``BLOCK``, and
every pair of blocks is joined by itself, so no task holds a large band; the pairs
of a band, as its links, grow with the square of its different sets.

``with_next`` gives each document its successor in descending id order without a
global sort in one task: quantiles of the id cut blocks, each block also gets the
first document of the block after it.

Defined results: a null text is an empty one; the fingerprint of no words is the
empty string, equal only to itself (likeness 1), else 0; null ids come last; rows
of one id are ordered by text; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import connected, small_batches, stage, word_hashes, word_shingles

PERMUTATIONS = 128
BAND_PLACES = 4
CHUNK = 1024
SIMILARITY = 0.75
BLOCK = 256  # sets of a band that are joined with as many others at a time

_random = np.random.Generator(np.random.PCG64(20240229))
FACTORS = _random.integers(0, 1 << 63, (PERMUTATIONS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, (PERMUTATIONS, 1), np.uint64) * np.uint64(2)

NEIGHBOURS = "doc_id bigint, text string, next_text string"
FINGERPRINTS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of every function over the set, 16 bits each; empty for an empty set."""
    if not len(shingles):
        return np.empty(0, "<u2")
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        values = FACTORS * (shingles[None, at : at + CHUNK] >> np.uint64(32))
        values += OFFSETS
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u2")


def text_shingles(texts: pa.Array) -> list[np.ndarray]:
    """The shingles of every text, lower-cased."""
    hashes, bounds = word_hashes(texts, lower=True)
    return [word_shingles(hashes[begin:end]) for begin, end in zip(bounds, bounds[1:])]


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of equal places."""
    if len(one) != len(other):
        return 0.0
    return float((one == other).mean()) if len(one) else 1.0


def printed(places: np.ndarray) -> str:
    return base64.b64encode(places.tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the beginning of the next."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def chosen(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, next_text: the text of the next smaller id; of the largest id, after the smallest.

    The ids' quantiles and one row per block reach the driver: as many as shuffle
    partitions. Texts are shuffled once.
    """
    spark = docs.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("place"))
    shares = [block / blocks for block in range(1, blocks)]
    cuts = ids.agg(F.percentile_approx("place", shares or [0.5], 100 * blocks)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    block = F.array_size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut > F.col("place"))) if cuts else F.lit(0)
    firsts = ids.groupBy(block.alias("block")).agg(F.max("place").alias("place")).orderBy("block").collect()
    heads = {row["place"]: firsts[at - 1]["block"] for at, row in enumerate(firsts)}
    small_batches(spark)
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = chosen(docs, id_col, text_col).withColumn("place", place).withColumn("block", block)
    return (
        rows.withColumn("guest", F.lit(False)).unionByName(guests(rows, heads))
        .repartitionByRange(blocks, "block")
        .sortWithinPartitions("block", "guest", F.desc("place"), "text")
        .select("doc_id", "text", "block", "guest")
        .mapInArrow(paired, NEIGHBOURS)
    )


def guests(rows: DataFrame, heads: dict[int, int]) -> DataFrame:
    """The first document of each block, as the last one of the block before it."""
    if not heads:
        return rows.limit(0).withColumn("guest", F.lit(True))
    block = F.element_at(F.create_map(*(F.lit(value) for pair in heads.items() for value in pair)), F.col("place"))
    first = rows.where(F.col("place").isin(list(heads))).groupBy("place").agg(F.min("text").alias("text"), F.min("doc_id").alias("doc_id"))
    return first.select("doc_id", "text", "place", block.alias("block"), F.lit(True).alias("guest"))


def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each with the text after it; a guest closes its block."""
    before = None
    for batch in batches:
        out = []
        for doc, text, block, guest in zip(*(column.to_pylist() for column in batch.columns)):
            if before is not None and before[2] == block:
                out.append((before[0], before[1], text))
            before = None if guest else (doc, text, block)
        yield arrays(out, NEIGHBOURS)


def arrays(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


def fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None, None
    for batch in batches:
        docs, texts, following = (column.to_pylist() for column in batch.columns)
        changed = [edited(text, other) for text, other in zip(texts, following)]
        sets = zip(text_shingles(batch.column(1)), text_shingles(batch.column(2)), text_shingles(pa.array(changed, pa.string())))
        out = []
        for doc, text, other, new, (own_set, other_set, new_set) in zip(docs, texts, following, changed, sets):
            # The next text of one row is nearly always the text of the row after it.
            own = held[1] if held[0] == text else signature(own_set)
            held = other, signature(other_set)
            near = signature(new_set)
            out.append((
                doc, len(text), hashlib.sha256(new.encode()).hexdigest(), printed(own), printed(near),
                likeness(own, near), likeness(own, held[1]),
            ))
        yield arrays(out, FINGERPRINTS)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness, also to the next document's."""
    return with_next(docs, id_col, text_col).mapInArrow(fingerprint_batches, FINGERPRINTS)


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the sorted shingle hashes, and the signature's bands."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_shingles(batch.column(1))
            bands = [signature(one).view("<u8").view(np.int64) for one in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(column, pa.list_(pa.int64())) for column in ([one.view(np.int64) for one in found], bands))],
                names=["doc_id", "shingles", "bands"],
            )

    small_batches(docs.sparkSession)
    return chosen(docs, id_col, text_col).mapInArrow(sets, "doc_id bigint, shingles array<bigint>, bands array<bigint>")


def jaccard(one: Column, other: Column) -> Column:
    shared = F.array_size(F.array_intersect(one, other))
    return shared / (F.array_size(one) + F.array_size(other) - shared)


def band_pairs(classes: DataFrame) -> DataFrame:
    """(one, other): the keys of all pairs of sets that agree in a band."""
    banded = classes.select("set_key", F.posexplode("bands").alias("band", "value"))
    blocks = banded.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1")
    blocks = blocks.select("band", "value", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    members = banded.join(blocks, ["band", "value"]).withColumn("block", F.pmod(F.xxhash64("set_key"), "blocks").cast("int"))
    dealt = members.withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", "value", F.least("block", "beside").alias("low"), F.greatest("block", "beside").alias("high"), "block", "set_key")
    keys = ["band", "value", "low", "high"]
    one, other = dealt.withColumnsRenamed({"set_key": "one", "block": "block_one"}), dealt.withColumnsRenamed({"set_key": "other", "block": "block_other"})
    # Two sets of one block meet where the block is joined with itself.
    met = one.join(other, keys).where("one < other AND (low = high OR block_one <> block_other)")
    return met.select("one", "other").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document with words: doc_id, class_id, the links of its class, their number and the component.

    ``links`` are (class_id, similarity) of all smaller classes that share a band and are
    verified; ``n_links`` counts the links to larger classes too. A class is named by its
    smallest id, a component by that of its classes.
    """
    sets = shingle_sets(docs, id_col, text_col).where(F.size("shingles") > 0).withColumn("set_key", F.sha2(F.col("shingles").cast("string"), 256))
    sets = stage(sets, "shingle-sets")
    named = sets.groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    classes = sets.select("set_key", "shingles", "bands").dropDuplicates(["set_key"])
    own = classes.select("set_key", "shingles").join(named, "set_key")
    side = lambda name: own.select(F.col("set_key").alias(name), F.col("shingles").alias(f"{name}_set"), F.col("class_id").alias(f"{name}_class"))
    compared = band_pairs(classes).join(side("one"), "one").join(side("other"), "other").withColumn("similarity", jaccard(F.col("one_set"), F.col("other_set")))
    verified = stage(compared.where(F.col("similarity") >= similarity).drop("one_set", "other_set"), "links")
    place = lambda name: F.struct(F.coalesce(f"{name}_class", F.lit((1 << 63) - 1)), F.col(name))
    after = place("one") > place("other")  # classes without an id come last
    item = lambda name, other, take: verified.select(
        F.col(name).alias("set_key"), F.when(take, F.struct(F.col(f"{other}_class").alias("class_id"), "similarity")).alias("link")
    )
    both = item("one", "other", after).unionByName(item("other", "one", ~after))
    linked = both.groupBy("set_key").agg(F.collect_list("link").alias("links"), F.count("*").alias("n_links"))
    linked = linked.withColumn("links", F.when(F.size("links") > 0, F.col("links")))
    of = connected(verified, "one", "other").withColumnRenamed("node", "set_key")
    names = named.join(of, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    least = names.groupBy("component").agg(F.min("class_id").alias("component_id"))
    rows = sets.select("doc_id", "set_key").join(names.join(least, "component"), "set_key").join(linked, "set_key", "left")
    return rows.select("doc_id", "class_id", "links", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id")
