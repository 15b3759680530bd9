import random

import numpy as np
import pyarrow as pa
import pytest

from llm import vector_join
from llm.vector_join import first_of_each, join_components, text_shingles

from .helpers import WORDS, docs_frame, edge_rows, prose


def plain(rows):
    sets = [set(one.tolist()) for one in text_shingles(pa.array([text for _, text in rows], pa.string()))]
    label = list(range(len(rows)))

    def find(at):
        while label[at] != at:
            at = label[at]
        return at

    for one in range(len(rows)):
        for other in range(one):
            shared = len(sets[one] & sets[other])
            if shared and 100 * shared >= 75 * len(sets[one] | sets[other]):
                label[find(one)] = find(other)
    ids = {}
    for at, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(at)] = min(ids.get(find(at), doc), doc)
    return sorted(((doc, len(sets[at]), ids.get(find(at))) for at, (doc, _) in enumerate(rows)), key=str)


def variants(seed, original, count, changes):
    """Copies of a text with some words replaced."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        copied = original.split()
        for _ in range(rng.randrange(changes)):
            copied[rng.randrange(len(copied))] = rng.choice(WORDS) + "-"
        out.append(" ".join(copied))
    return out


@pytest.fixture(scope="module")
def groups():
    line = prose(9, 30)
    texts = variants(1, prose(11, 120), 60, 10) + variants(2, prose(12, 40), 30, 4) + variants(3, prose(13, 7), 20, 2)
    texts += [line + " " + prose(400 + at, 12 + at) for at in range(40)] + [prose(500 + at, 100) for at in range(20)]
    texts += variants(4, prose(11, 60) + " " + prose(14, 60), 20, 6) + ["a b", "A  b", "a b c d e", "a b c d f"]
    random.Random(8).shuffle(texts)
    return [(at * 3, text) for at, text in enumerate(texts)]


@pytest.mark.parametrize("block", [512, 8])
def test_components_agree_with_all_pairs(spark, groups, block, monkeypatch):
    monkeypatch.setattr(vector_join, "BLOCK_POINTS", block)
    monkeypatch.setattr(vector_join, "LIKELY_LEADS", 1)
    found = join_components(docs_frame(spark, groups)).collect()
    expected = plain(groups)
    assert sorted(map(tuple, found), key=str) == expected
    assert len({row[2] for row in expected}) < 0.8 * len(expected)


def test_edges_and_first_of_each(spark):
    docs = docs_frame(spark, edge_rows())
    found = join_components(docs).collect()
    assert sorted(map(tuple, found), key=str) == plain(edge_rows())
    kept = first_of_each(docs)
    assert kept.columns == docs.columns
    # 5 and 8 have one text; one of the repeated rows stays, so does one of two equal texts without id.
    ids = sorted(str(row["doc_id"]) for row in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "5", "6", "9", "10", "None", "None"])
    assert join_components(docs_frame(spark, [])).collect() == []
    assert first_of_each(docs_frame(spark, [])).collect() == []


def test_bound_never_loses_a_link():
    rng = np.random.default_rng(6)
    sets = []
    for size in rng.integers(5, 400, 60):
        base = rng.integers(0, 1 << 63, size).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.r_[base[: int(size * 0.9)], rng.integers(0, 1 << 63, 5).astype(np.uint64)])]
    points = np.stack([vector_join.counts(one).astype(np.int32) for one in sets])
    sizes = np.array([len(one) for one in sets])
    found = {tuple(sorted((int(a), int(b)))) for mine, theirs in vector_join.tree_join((points, sizes, np.arange(len(sets))), None) for a, b in zip(mine, theirs)}
    for one in range(len(sets)):
        for other in range(one):
            shared = vector_join.shared_count(sets[one], sets[other])
            assert shared == len(np.intersect1d(sets[one], sets[other]))
            if vector_join.linked(shared, sizes[one], sizes[other]):
                assert (other, one) in found
    assert len(found) < len(sets) * (len(sets) - 1) / 8


@pytest.mark.parametrize("size", [1, 4, 5, 11, 100, 1000])
def test_prefix_leaves_what_is_needed(size):
    for other in range(-(-3 * size // 4), 4 * size // 3 + 1):
        missed = size // 4  # the most that a linked set can lack
        assert vector_join.prefix(size) - missed >= min(vector_join.needed(other), vector_join.needed(size)) or vector_join.prefix(size) == size
