import numpy as np

from llm import posting_ann
from llm.common import table
from llm.posting_ann import centroid_graph, halved, nearest


def frame(spark, rows):
    return spark.createDataFrame([row + (7, 7) for row in rows], "vec_id long, embedding array<float>, list long, cell long")


def brute(rows, queries, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for query, vector in good:
        if query in queries:
            by = {}
            for other, point in good:
                if other != query and len(point) == len(vector):
                    distance = float(np.sqrt(((np.float32(vector).astype(float) - np.float32(point).astype(float)) ** 2).sum()))
                    by[other] = min(distance, by.get(other, np.inf))
            out[query] = sorted((distance, other) for other, distance in by.items())[:k]
    return out


def test_recall_and_scores(spark, sf_dir):
    vectors = table(spark, sf_dir.replace("0.001", "0.1"), "embeddings")
    rows = [(row["vec_id"], row["embedding"]) for row in vectors.collect()]
    queries = {i for i, _ in rows if i % 100 == 0}
    truth = brute(rows, queries)
    found = nearest(vectors, vectors.where("vec_id % 100 = 0")).collect()
    hits = 0
    for query, best in truth.items():
        mine = sorted((row["rank"], row["vec_id"], row["score"]) for row in found if row["query_id"] == query)
        assert [rank for rank, _, _ in mine] == list(range(1, 11))
        assert [(score, i) for _, i, score in mine] == sorted((score, i) for _, i, score in mine)
        hits += len({i for _, i, _ in mine} & {i for _, i in best})
        point = {i: np.array(v, float) for i, v in rows}
        assert all(np.isclose(score, np.linalg.norm(point[query] - point[i]), rtol=1e-12) for _, i, score in mine)
    assert hits >= 0.9 * 10 * len(truth)


def test_edges(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype("f4").tolist()) for i in range(60)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(100, 130)]
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [float("nan"), 1.0, 1.0, 1.0]), (204, [None, 1.0, 1.0, 1.0]), (205, [float("inf"), 1.0, 1.0, 1.0]), (206, [1.0]), (None, [1.0, 2.0, 1.0, 1.0])]
    rows += [rows[0], rows[100 - 40], (0, [9.0, 9.0, 9.0, 9.0])]
    monkeypatch.setattr(posting_ann, "CELL", 8)
    monkeypatch.setattr(posting_ann, "QUERY_CELL", 8)
    vectors = frame(spark, rows)
    found = nearest(vectors, vectors.where("vec_id in (100, 105, 3, 200, 202, 206)")).collect()
    truth = brute(rows, {100, 105, 3})
    got = {query: [(row["score"], row["vec_id"]) for row in sorted(found, key=lambda row: row["rank"]) if row["query_id"] == query] for query in (100, 105, 3)}
    assert got[100] == truth[100] and got[105] == truth[105] and len(got[3]) == 10
    assert {row["query_id"] for row in found} == {100, 105, 3}
    two = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert [(row["query_id"], row["rank"], row["vec_id"]) for row in nearest(two, two.where("vec_id = 1")).collect()] == [(1, 1, 2)]
    assert nearest(frame(spark, []), frame(spark, [])).collect() == []


def test_lists_are_balanced_and_the_graph_finds_them():
    points = np.random.default_rng(4).normal(size=(1000, 8))
    centroids = halved(points, 16)
    assert 1000 / 16 <= len(centroids) <= 128
    graph = centroid_graph(centroids)
    place, distance = graph.nearest(points[:200], 8)
    exact = np.sqrt(posting_ann.squares(points[:200], centroids))
    assert np.allclose(np.take_along_axis(exact, place, 1), distance)
    best = np.argsort(exact, axis=1)[:, :8]
    assert np.mean([len(set(one) & set(other)) for one, other in zip(place, best)]) >= 7.5
    assert len(halved(np.ones((100, 3)))) == 1


def test_groups_of_near_copies_do_not_shut_out_the_other_neighbours(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(2100, 64))
    points = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), 8, axis=0)
    points = (points + 0.1 / 8 * rng.normal(size=points.shape)).astype("f4")  # more vectors than the sample takes
    vectors = spark.createDataFrame([(i, vector) for i, vector in enumerate(points.tolist())], "vec_id long, embedding array<float>").repartition(8)
    queries = np.arange(0, len(points), 100)
    mine = {}
    for row in nearest(vectors, vectors.where("vec_id % 100 = 0")).collect():
        mine.setdefault(row["query_id"], set()).add(row["vec_id"])
    hits = 0
    for query in queries:
        distance = ((points - points[query]) ** 2).sum(axis=1)
        distance[query] = np.inf
        hits += len(mine[query] & set(np.argsort(distance)[:10].tolist()))
        assert len(mine[query]) == 10
    print("recall", hits / 10 / len(queries))
    assert hits >= 0.9 * 10 * len(queries)
