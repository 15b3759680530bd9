"""Set similarity join with count vectors and R-trees.

A document's set is its distinct five-word shingles, lower-cased; two documents link
when 100 * intersection >= 75 * union. Equal sets are one node from the start.

The method. Shingles are hashed into ``GROUPS`` groups, and a set becomes the point
of its group counts. Two sets share at most the sum over groups of the smaller
count, and a set shares at most that with the coordinate maxima of a tree node with
any set in the node. Points are packed into R-trees; nodes, then points, are passed
over when that bound is below the threshold for their sizes. Pairs that are left
are verified on the whole sets.

Count vectors alone can't tell which of all documents to compare, so trees are built
per star. A cell is a shingle that several sets of comparable size have among their
first ones in hash order. Sets that link miss at most a quarter of each other's
shingles, so they share at least ``needed`` cells: sets with fewer drop out, and the
others keep their rarest cells only. A star puts together the cells that have the
same leading member. Two rounds then find all components:

1. each set is verified against the leading sets of those stars, a few, that it shares
   most cells with, and the components of these links are found;
2. stars whose members are still in different components are cut into blocks, and
   R-trees of blocks are joined; pairs within a component are passed over, also those
   that links found on the way connect.

A link of two sets is thus either verified or lies within a component that other
links hold together, so components are exact (with shingles and sets told apart by
64-bit hashes). A group of near copies, however large, costs a row per member and
star, and no two of its members are compared once they are connected.

Defined results: a null or blank text has the empty set, links with nothing and is its
own component; null ids take part, but a component is named by its smallest id that
is not null; repeated rows are linked by their equal sets; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import connected, free_name, partitions, small_batches, stage, word_hashes, word_shingles

GROUPS = 256
NODE_POINTS = 16
BLOCK_POINTS = 512
BLOCK_SHINGLES = 1 << 19
# Sizes of linked sets differ by a factor of at most 4 / 3, so by at most two of these steps.
SIZE_STEP = 1.16

INFO = "doc_id bigint, text_key bigint, set_id bigint, n_shingles bigint"
CELLS = "cell bigint, n_shingles bigint, set_id bigint"
CELL_NAMES = ["cell", "n_shingles", "set_id"]
SEEN_SETS = 1 << 18
PEELINGS = 2
LIKELY_LEADS = 4
SETS = "set_id bigint, n_shingles bigint, counts binary, shingles array<bigint>"


def prefix(count: int) -> int:
    """How many of the first shingles are cell keys: those a linked set can miss, and an eighth more."""
    return min(count, count // 4 + 1 + count // 8)


def needed(count: int) -> int:
    """How many of these a linked set has among its own: it has at least 3/4 as many shingles."""
    return 1 + (count - count // 4) // 8


def linked(shared, one, other):
    """Whether sets of these sizes link, for numbers, arrays or columns."""
    return 100 * shared >= 75 * (one + other - shared)


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def counts(shingles: np.ndarray) -> np.ndarray:
    """The point of a set: how many shingles fall into each group."""
    found = np.bincount((shingles >> np.uint64(24)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return found.astype("<u2" if found.max(initial=0) < 1 << 16 else "<u4")


def text_shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingles of every text."""
    hashes, bounds = word_hashes(texts, lower=True)
    return (word_shingles(hashes[begin:end]) for begin, end in zip(bounds, bounds[1:]))


def info_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(text_shingles(batch.column(2)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([set_id(one) if len(one) else None for one in found], pa.int64()),
                pa.array([len(one) for one in found], pa.int64()),
            ],
            names=["doc_id", "text_key", "set_id", "n_shingles"],
        )


def cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n_shingles, set_id) of the first shingles, once per set and task."""
    seen = set()
    for batch in batches:
        rows = [np.empty((3, 0), np.int64)]
        for shingles in text_shingles(batch.column(0)):
            if not len(shingles) or (name := set_id(shingles)) in seen:
                continue
            if len(seen) >= SEEN_SETS:
                seen.clear()
            seen.add(name)
            keys = shingles[: prefix(len(shingles))].view(np.int64)
            rows.append(np.stack([keys, np.full(len(keys), len(shingles)), np.full(len(keys), name)]))
        yield longs(np.concatenate(rows, axis=1))


def longs(columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=CELL_NAMES)


def partner_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order, those with another set of comparable size in their cell.

    The nearest sizes are the rows before and after, so only these are looked at.
    The first and the last row of a partition are kept, as their neighbours are
    elsewhere. Repeated rows are dropped.
    """
    held, partnered = None, True  # the last row so far, and whether it is to be kept
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([column.to_numpy() for column in batch.columns])
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        rows = rows[:, np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(axis=0)]]
        cell, size, _ = rows
        near = (cell[1:] == cell[:-1]) & (4 * size[:-1] >= 3 * size[1:])
        keep = np.r_[partnered, near] | np.r_[near, False]
        held, partnered = rows[:, -1:], bool(keep[-1])
        yield longs(rows[:, :-1][:, keep[:-1]])
    if held is not None:
        yield longs(held)


def with_partner(cells: DataFrame) -> DataFrame:
    """The rows with another set of comparable size in their cell; a large cell spreads over range partitions."""
    dealt = cells.repartitionByRange(partitions(cells.sparkSession), *CELL_NAMES).sortWithinPartitions(*CELL_NAMES)
    return dealt.mapInArrow(partner_batches, CELLS)


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for shingles, wanted in zip(text_shingles(batch.column(0)), batch.column(1).to_pylist()):
            if len(shingles) and set_id(shingles) == wanted:
                rows.append((wanted, len(shingles), counts(shingles).tobytes(), shingles.view(np.int64)))
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types)], names=["set_id", "n_shingles", "counts", "shingles"]
        )


def shingle_info(chosen: DataFrame) -> DataFrame:
    """(doc_id, text_key, set_id, n_shingles); no set_id where there are no words."""
    return stage(chosen.mapInArrow(info_batches, INFO), "set-info")


def active_cells(chosen: DataFrame) -> DataFrame:
    """(cell, n_shingles, set_id) of sets that may link, a cell or more for any two that do.

    A set that has fewer shared cells than ``needed`` drops out, which may leave others
    without partners; so this is done again. Of its cells a set then needs the rarest
    only, all but ``needed`` - 1: the rarest one that two linked sets share is among these for both.
    """
    cells = stage(with_partner(chosen.select("text").mapInArrow(cell_batches, CELLS)), "cells")
    needs = 1 + F.floor((F.col("n_shingles") - F.floor(F.col("n_shingles") / 4)) / 8)
    per_set = Window.partitionBy("set_id")
    for _ in range(PEELINGS):
        enough = cells.withColumn("shared", F.count("*").over(per_set)).where(F.col("shared") >= needs).drop("shared")
        cells = stage(with_partner(enough), "cells")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("members"))
    place = F.row_number().over(per_set.orderBy(F.desc("members"), F.desc("cell")))
    rarest = cells.join(sizes, "cell").withColumn("place", place).where(F.col("place") >= needs)
    return stage(rarest.select(*CELL_NAMES), "cells")


def active_sets(chosen: DataFrame, info: DataFrame, cells: DataFrame) -> DataFrame:
    """The points and whole sets of all sets that still have cells, from one text of each."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    named = info.where("set_id is not null").groupBy("set_id").agg(first).select("set_id", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    wanted = named.join(cells.select("set_id").distinct(), "set_id")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
    texts = chosen.join(wanted, same).select("text", "set_id")
    return stage(texts.mapInArrow(set_batches, SETS).dropDuplicates(["set_id"]), "sets")


def stars(cells: DataFrame) -> DataFrame:
    """(lead, set_id, n_shingles, shared): the cells of one leading set put together, with their members.

    The leading set of a cell is the one with most cells of several members, as near
    copies have their original in common. Any two sets that share a cell share the
    star of its leading set.
    """
    several = cells.join(cells.groupBy("cell").count().where("count > 1").select("cell"), "cell")
    weights = several.groupBy("set_id").agg(F.count("*").alias("weight"))
    weighted = stage(several.join(weights, "set_id"), "weighted-cells")
    leads = weighted.groupBy("cell").agg(F.max(F.struct("weight", "set_id")).alias("first")).select("cell", F.col("first.set_id").alias("lead"))
    return stage(weighted.join(leads, "cell").groupBy("lead", "set_id", "n_shingles").agg(F.count("*").alias("shared")), "stars")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (one, other) whose sets link, on all their shingles."""
    one = sets.select(F.col("set_id").alias("one"), F.col("shingles").alias("first"), F.col("n_shingles").alias("n_first"))
    other = sets.select(F.col("set_id").alias("other"), F.col("shingles").alias("second"), F.col("n_shingles").alias("n_second"))
    compared = pairs.join(one, "one").join(other, "other")
    shared = F.array_size(F.array_intersect("first", "second"))
    return compared.where(linked(shared, F.col("n_first"), F.col("n_second"))).select("one", "other")


def unresolved(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of stars that lie in several components, with their component."""
    labels = components.select(F.col("node").alias("set_id"), "component")
    labelled = members.join(labels, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    several = labelled.groupBy("lead").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("members"), F.sum("n_shingles").alias("total")
    )
    return labelled.join(several.where("least <> most").select("lead", "members", "total"), "lead")


def blocks(members: DataFrame) -> DataFrame:
    """Members with their block: a star of up to BLOCK_POINTS members is one block.

    A larger one, or one of long sets, is cut by component, if that alone would fill a
    block, by size and by a hash, so that blocks within a component need not be joined.
    """
    large = (F.col("members") > BLOCK_POINTS) | (F.col("total") > BLOCK_SHINGLES)
    weight = members.groupBy("lead", "component").agg(F.count("*").alias("weight"))
    own = F.when(large & (F.col("weight") > BLOCK_POINTS), F.col("component")).otherwise(0)
    band = F.when(large, F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(SIZE_STEP)))).otherwise(0).cast("int")
    rows = members.join(weight, ["lead", "component"]).withColumn("own", own).withColumn("band", band)
    filled = rows.groupBy("lead", "own", "band").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_POINTS, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("parts")
    )
    part = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")
    placed = rows.join(filled, ["lead", "own", "band"]).withColumn("part", F.when(large, part).otherwise(0))
    return stage(placed.select("lead", "own", "band", "part", "set_id", "n_shingles", "component"), "blocks")


def block_pairs(placed: DataFrame) -> DataFrame:
    """Pairs of a star's blocks whose sizes and components leave something to compare, each named by a number."""
    one = placed.select("lead", "own", "band", "part").distinct()
    other = one.select("lead", *(F.col(name).alias(f"{name}_2") for name in ("own", "band", "part")))
    in_order = F.struct("own", "band", "part") <= F.struct(F.col("own_2"), F.col("band_2"), F.col("part_2"))
    within = (F.col("own") == F.col("own_2")) & (F.col("own") != 0)
    return one.join(other, "lead").where(in_order & ~within & (F.abs(F.col("band") - F.col("band_2")) <= 2))


def packed(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points in tree order, the coordinate maxima of every NODE_POINTS of them, and the nodes' least sizes.

    Slabs of near size are ordered along a fixed direction, so that nodes are small.
    """
    direction = np.cos(np.arange(points.shape[1]))
    slab = np.argsort(np.argsort(sizes, kind="stable")) // (NODE_POINTS * 4)
    order = np.lexsort((points @ direction, slab))
    begins = np.arange(0, len(order), NODE_POINTS)
    return order, np.maximum.reduceat(points[order], begins), np.minimum.reduceat(sizes[order], begins)


def tree_join(one: tuple, other: tuple | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of points (in one, in other) that the bound leaves, of different components.

    A side is (points, sizes, components); without another side the tree joins itself.
    """
    points, sizes, parts = one
    own = other is None
    points_2, sizes_2, parts_2 = one if own else other
    order, tops, least = packed(points, sizes)
    order_2, tops_2, least_2 = (order, tops, least) if own else packed(points_2, sizes_2)
    for node in range(len(tops)):
        begin = node if own else 0
        shared = np.minimum(tops[node], tops_2[begin:]).sum(axis=1)
        # Sets link when 7 * shared >= 3 * (one + other).
        nodes = begin + np.flatnonzero(7 * shared >= 3 * (least[node] + least_2[begin:]))
        if not len(nodes):
            continue
        mine = order[node * NODE_POINTS : (node + 1) * NODE_POINTS]
        theirs = np.concatenate([order_2[at * NODE_POINTS : (at + 1) * NODE_POINTS] for at in nodes])
        for place in mine:
            rest = theirs[parts_2[theirs] != parts[place]]
            rest = rest[(4 * sizes_2[rest] >= 3 * sizes[place]) & (4 * sizes[place] >= 3 * sizes_2[rest])]
            shared = np.minimum(points[place], points_2[rest]).sum(axis=1)
            rest = rest[7 * shared >= 3 * (sizes[place] + sizes_2[rest])]
            if len(rest):
                yield np.full(len(rest), place), rest


def root(parents: dict[int, int], node: int) -> int:
    while parents.setdefault(node, node) != node:
        parents[node] = node = parents[parents[node]]
    return node


def shared_count(one: np.ndarray, other: np.ndarray) -> int:
    """How many values two sorted arrays have in common."""
    return int((one[np.minimum(np.searchsorted(one, other), len(one) - 1)] == other).sum())


def block_links(one: tuple, other: tuple | None) -> Iterator[tuple[int, int]]:
    """Links between sets of different components in one or two blocks, as many as connect them.

    A side is (set ids, shingles, (points, sizes, components)).
    """
    ids, shingles, tree = one
    ids_2, shingles_2, tree_2 = other or one
    parents: dict[int, int] = {}
    for places, near in tree_join(tree, tree_2 if other else None):
        place = places[0]
        for at in near:
            mine, theirs = root(parents, tree[2][place]), root(parents, tree_2[2][at])
            if mine != theirs and linked(shared_count(shingles[place], shingles_2[at]), len(shingles[place]), len(shingles_2[at])):
                parents[max(mine, theirs)] = min(mine, theirs)
                yield ids[place], ids_2[at]


def join_batch(rows: pd.DataFrame) -> pd.DataFrame:
    """The links of all block pairs in a task's share."""
    found = []
    for _, group in rows.groupby("pair", sort=False):
        sides = []
        for _, side in group.groupby("side"):
            points = np.stack([np.frombuffer(raw, "<u2" if len(raw) == 2 * GROUPS else "<u4").astype(np.int32) for raw in side["counts"]])
            shingles = [np.sort(one) for one in side["shingles"]]
            sides.append((side["set_id"].tolist(), shingles, (points, side["n_shingles"].to_numpy(), side["component"].to_numpy())))
        if len(sides) > 1 or not group["two"].iloc[0]:
            found += block_links(sides[0], sides[1] if len(sides) > 1 else None)
    return pd.DataFrame(found, columns=["one", "other"], dtype="int64")


def tree_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (one, other) that connect sets of different components that share a star."""
    placed = blocks(members)
    pairs = stage(block_pairs(placed).withColumn("pair", F.xxhash64("lead", "own", "band", "part", "own_2", "band_2", "part_2")), "pairs")
    same = (F.col("own") == F.col("own_2")) & (F.col("band") == F.col("band_2")) & (F.col("part") == F.col("part_2"))
    keys = ["lead", "own", "band", "part"]
    first = pairs.select(*keys, "pair", F.lit(0).alias("side"), (~same).alias("two"))
    second = pairs.where(~same).select("lead", *(F.col(f"{key}_2").alias(key) for key in keys[1:]), "pair", F.lit(1).alias("side"), F.lit(True).alias("two"))
    rows = placed.join(first.unionByName(second), keys).select("pair", "side", "two", "set_id", "component")
    rows = rows.join(sets, "set_id").withColumn("share", F.pmod("pair", F.lit(16 * partitions(members.sparkSession))))
    return rows.groupBy("share").applyInPandas(join_batch, "one bigint, other bigint").distinct()


def link_sets(chosen: DataFrame, info: DataFrame) -> DataFrame:
    """(node, component) of the sets that link with another one."""
    cells = active_cells(chosen)
    sets = active_sets(chosen, info, cells)
    members = stars(cells)
    comparable = (4 * F.col("n_lead") >= 3 * F.col("n_shingles")) & (4 * F.col("n_shingles") >= 3 * F.col("n_lead"))
    leads = sets.select(F.col("set_id").alias("lead"), F.col("n_shingles").alias("n_lead"))
    likely = F.row_number().over(Window.partitionBy("set_id").orderBy(F.desc("shared"), "lead"))
    pairs = members.where("lead <> set_id").join(leads, "lead").where(comparable)
    pairs = pairs.withColumn("place", likely).where(F.col("place") <= LIKELY_LEADS)
    links = stage(verified(pairs.select(F.col("lead").alias("one"), F.col("set_id").alias("other")), sets), "links")
    components = connected(links, "one", "other")
    more = stage(tree_links(unresolved(members, components), sets), "links")
    return connected(links.unionByName(more), "one", "other")


def labelled_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, n_shingles, component): the component is the least set id in it, null where there are no words."""
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    info = shingle_info(chosen)
    components = link_sets(chosen, info).select(F.col("node").alias("set_id"), "component")
    with_words = info.where("set_id is not null").join(components, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    without = info.where("set_id is null").withColumn("component", F.lit(None).cast("bigint"))
    columns = ["doc_id", "text_key", "n_shingles", "component"]
    return with_words.select(*columns).unionByName(without.select(*columns))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, and component_id, the least id reachable by links."""
    labelled = stage(labelled_documents(docs, id_col, text_col), "labelled")
    least = labelled.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = labelled.join(least, "component").select("doc_id", "n_shingles", "component_id")
    alone = labelled.where("component is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The frame with one row of each component, that of the smallest id (no id comes last), and all rows without words."""
    kept, key, mine = (free_name(docs, name) for name in ("kept_id", "kept_key", "text_key"))
    labelled = labelled_documents(docs, id_col, text_col).where("component is not null")
    first = labelled.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"))
    first = first.select(F.col("first.doc_id").alias(kept), F.col("first.text_key").alias(key)).distinct()
    text = F.col(text_col).cast("string")
    blank = F.coalesce(~F.rlike(text, F.lit("[^ \\t-\\r]")), F.lit(True))
    keyed = docs.withColumn(mine, F.xxhash64(text))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col(kept)) & (F.col(mine) == F.col(key))
    chosen = keyed.where(~blank).join(first, same, "left_semi").dropDuplicates([id_col, mine])
    return chosen.unionByName(keyed.where(blank)).drop(mine)
