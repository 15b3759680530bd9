"""Nearest neighbours by balanced posting lists around centroids.

Fitting: a sample of at most ``SAMPLE`` vectors is halved again and again, each time
at the median between two means, until a part holds ``LEAF`` sampled vectors; the
parts' means are the centroids. As halves are equal, so are the lists of the sample.
Centroids and a graph of their neighbours are small, bounded by the sample, and go
to all tasks.

Index: a best-first search in the graph finds each vector's nearest centroids, and
the vector is written to the list of each whose distance is within ``REPLICA_RATIO``
of the least, ``REPLICAS`` at most: vectors at a boundary are in several lists. A list that
grew beyond ``CELL`` vectors is cut into cells by a hash of the id, and all cells of
a list are searched, so a list of any size is spread over tasks and none is cut short.

Search: the graph gives a query's nearest lists, ``PROBES`` at most; the ratio
``PROBE_RATIO`` counts from the list at which they hold ``SPARE`` times k vectors, so a
list very near, of a group of near copies, does not shut out all others. Queries meet their cells' vectors in a cogrouped join, in
blocks; distances are taken in double precision on the vectors as given; the best
of each cell are merged per query.

Defined results: vectors that are null, empty, all zero, or hold a null or a
non-finite component take no part, nor do those of another length than the most
frequent one; a row's own id is never its neighbour, so rows that repeat an id are
not each other's; as candidates, rows that repeat an id count once, by the least distance; null
ids take no part; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import small_batches, stage

SAMPLE = 1 << 14
LEAF = 16
HALVING_ROUNDS = 6
DEGREE = 24
REPLICAS, REPLICA_RATIO = 4, 1.15
PROBES, PROBE_RATIO = 96, 1.5
SPARE = 4 * REPLICAS  # each vector may be in as many lists
BEAM_SPARE = 16
CELL, QUERY_CELL = 256, 256
SEARCH_ROWS = 256

LISTED = "list int, id bigint, vector binary"
FOUND = "query_id bigint, vec_id bigint, score double"


def halved(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The means of equal parts of the points, of ``leaf`` points at most."""
    means, todo = [], [points]
    while todo:
        part = todo.pop()
        if len(part) <= leaf:
            means.append(part.mean(axis=0))
            continue
        # Two means that start at far ends; each round gives either half of the points to one.
        one = part[np.argmax(((part - part.mean(axis=0)) ** 2).sum(axis=1))]
        other = part[np.argmax(((part - one) ** 2).sum(axis=1))]
        half = len(part) // 2
        for _ in range(HALVING_ROUNDS):
            order = np.argsort(part @ (other - one), kind="stable")
            one, other = part[order[:half]].mean(axis=0), part[order[half:]].mean(axis=0)
        todo += [part[order[:half]], part[order[half:]]]
    return np.unique(np.array(means), axis=0)


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every other one."""
    return np.maximum((points**2).sum(axis=1)[:, None] + (others**2).sum(axis=1)[None] - 2 * points @ others.T, 0)


@dataclass
class CentroidGraph:
    """Centroids, each one's neighbours in the graph, and where a search begins."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray

    def nearest(self, points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """For each point the ``count`` nearest centroids found by best-first search, and their distances."""
        size = len(self.centroids)
        width = min(size, count + BEAM_SPARE)
        rows = np.arange(len(points))[:, None]
        seen = np.zeros((len(points), size), bool)
        beam = np.broadcast_to(self.entries, (len(points), len(self.entries)))
        seen[rows, beam] = True
        near = squares(points, self.centroids[self.entries])
        open_ = np.ones(beam.shape, bool)
        while open_.any():
            # Look at the neighbours of the nearest centroids not yet looked at, four at a time.
            rank = np.where(open_, near, np.inf)
            pick = np.argsort(rank, axis=1)[:, :4]
            live = np.take_along_axis(open_, pick, 1)
            np.put_along_axis(open_, pick, False, 1)
            new = self.neighbours[np.take_along_axis(beam, pick, 1)]
            fresh = live[:, :, None] & ~seen[rows[:, :, None], new]
            new, fresh = new.reshape(len(points), -1), fresh.reshape(len(points), -1)
            row, column = np.nonzero(fresh)
            place = new[row, column]
            # A centroid that several neighbours name in one step counts once.
            first = np.unique(row * size + place, return_index=True)[1]
            row, column, place = row[first], column[first], place[first]
            seen[row, place] = True
            distance = np.full(new.shape, np.inf)
            distance[row, column] = ((points[row] - self.centroids[place]) ** 2).sum(axis=1)
            near = np.hstack([near, distance])
            beam, open_ = np.hstack([beam, new]), np.hstack([open_, np.isfinite(distance)])
            if near.shape[1] > width:
                keep = np.argpartition(near, width - 1, axis=1)[:, :width]
                near, beam, open_ = (np.take_along_axis(column, keep, 1) for column in (near, beam, open_))
        order = np.argsort(near, axis=1, kind="stable")[:, :count]
        return np.take_along_axis(beam, order, 1), np.sqrt(np.take_along_axis(near, order, 1))


def centroid_graph(centroids: np.ndarray) -> CentroidGraph:
    """Neighbours are the nearest centroids and two at random, so that every one is reached."""
    size, rng = len(centroids), np.random.default_rng(5)
    degree = min(DEGREE, size - 1)
    neighbours = np.empty((size, degree + 2), np.int64)
    for at in range(0, size, 512):
        distance = squares(centroids[at : at + 512], centroids)
        distance[np.arange(len(distance)), at + np.arange(len(distance))] = np.inf
        neighbours[at : at + 512, :degree] = np.argsort(distance, axis=1)[:, :degree]
    neighbours[:, degree] = rng.permutation(size)
    neighbours[:, degree + 1] = (np.arange(size) + 1) % size
    return CentroidGraph(centroids, neighbours, np.unique(np.linspace(0, size - 1, min(size, 16)).astype(np.int64)))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as the bytes of doubles) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return rows.where(F.size("vector") == (lengths[0]["length"] if lengths else 0))


def fit(rows: DataFrame) -> CentroidGraph | None:
    """Centroids and their graph from a sample of bounded size, by a hash of the id."""
    total = rows.count()
    if not total:
        return None
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < min(1.0, SAMPLE / total) * (1 << 30)
    sample = rows.where(share).limit(2 * SAMPLE).toArrow()
    if not sample.num_rows:
        sample = rows.limit(SAMPLE).toArrow()
    flat = sample.column("vector").combine_chunks().flatten().to_numpy()
    points = flat.reshape(sample.num_rows, -1)
    order = np.argsort(sample.column("id").to_numpy(), kind="stable")
    return centroid_graph(halved(points[order]))


def listed(rows: DataFrame, graph: CentroidGraph, count: int, ratio: float, sizes: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """(list, id, vector): a row for each of the nearest centroids within the ratio.

    With ``sizes`` of lists the ratio counts from the first of the nearest that together hold ``least`` vectors.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            points = batch.column(1).flatten().to_numpy().reshape(len(ids), -1)
            for at in range(0, len(ids), SEARCH_ROWS):
                part = points[at : at + SEARCH_ROWS]
                centroid, distance = graph.nearest(part, count)
                reach = distance[:, :1]
                if sizes is not None:
                    held = np.cumsum(np.where(np.isfinite(distance), sizes[centroid], 0), axis=1)
                    full = np.minimum((held < least).sum(axis=1), np.isfinite(distance).sum(axis=1) - 1)
                    reach = np.take_along_axis(distance, full[:, None], 1)
                row, column = np.nonzero((distance <= reach * ratio) & np.isfinite(distance))
                raw = [vector.tobytes() for vector in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(centroid[row, column], pa.int32()), pa.array(ids[at : at + SEARCH_ROWS][row], pa.int64()),
                        pa.array([raw[place] for place in row], pa.binary()),
                    ],
                    names=["list", "id", "vector"],
                )

    return rows.mapInArrow(batches, LISTED)


def cell_counts(rows: DataFrame, size: int) -> dict[int, int]:
    """How many cells of ``size`` rows each list needs; a number per list that has rows."""
    return {row["list"]: -(-row["count"] // size) for row in rows.groupBy("list").count().collect()}


def by_list(counts: dict[int, int], size: int):
    """The count of a row's list, as a column."""
    values = np.ones(size, np.int64)
    values[list(counts)] = list(counts.values())
    return F.element_at(F.array(*(F.lit(int(value)) for value in values)), F.col("list") + 1)


def search_cell(k: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(index) and len(queries):
            ids = index["id"].to_numpy()
            points = np.frombuffer(b"".join(index["vector"])).reshape(len(ids), -1)
            for query, raw in zip(queries["id"].to_numpy(), queries["vector"]):
                distance = np.sqrt(((points - np.frombuffer(raw)) ** 2).sum(axis=1))
                others = np.flatnonzero(ids != query)
                best = others[np.lexsort((ids[others], distance[others]))]
                # Repeated rows must not push other ids out.
                best = best[np.sort(np.unique(ids[best], return_index=True)[1])][:k]
                parts.append((np.full(len(best), query), ids[best], distance[best]))
        columns = [np.concatenate(part) for part in zip(*parts)] if parts else [[], [], []]
        return pd.DataFrame({"query_id": pd.Series(columns[0], dtype="int64"), "vec_id": pd.Series(columns[1], dtype="int64"), "score": pd.Series(columns[2], dtype="float64")})

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest vectors found for every query row: query_id, rank, vec_id, score (distance)."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col).dropDuplicates(["id"])
    graph = fit(rows)
    if graph is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = stage(listed(rows, graph, REPLICAS, REPLICA_RATIO), "postings")
    size = len(graph.centroids)
    sizes = np.zeros(size, np.int64)
    for row in index.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    probes = stage(listed(asked, graph, PROBES, PROBE_RATIO, sizes, SPARE * k), "probes")
    cells, blocks = by_list(cell_counts(index, CELL), size), by_list(cell_counts(probes, QUERY_CELL), size)
    own = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    index = index.withColumn("cell", (own % cells).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    probes = probes.withColumn("block", (own % blocks).cast("int")).withColumn("cell", F.explode(F.sequence(F.lit(0), (cells - 1).cast("int"))))
    keys = ["list", "cell", "block"]
    found = index.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInPandas(search_cell(k), FOUND)
    # A vector is in at most REPLICAS lists, so these hold the k best different ones.
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k * REPLICAS).drop("rank")
    ranked = best.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
