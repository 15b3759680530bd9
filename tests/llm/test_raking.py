import random
from collections import defaultdict

import numpy as np
import pytest

from llm import raking
from llm.common import table
from llm.queries import QUERIES
from llm.raking import mix, sample

from .helpers import docs_frame, edge_rows, prose


def plain(cells, targets, rounds=200):
    weight = dict(cells)
    for _ in range(rounds):
        for axis, goal in enumerate(targets):
            sums = defaultdict(float)
            for cell, value in weight.items():
                sums[cell[axis]] += value
            weight = {cell: value * goal[cell[axis]] / sums[cell[axis]] for cell, value in weight.items()}
    return weight


def test_weights_meet_all_margins_and_agree_with_a_plain_loop(spark, sf_dir):
    rows = QUERIES["op9_raking"](spark, sf_dir).collect()
    docs = {row["doc_id"]: row for row in table(spark, sf_dir, "documents").collect()}
    assert {row["doc_id"] for row in rows} == set(docs)
    cells = defaultdict(float)
    for row in rows:
        text = docs[row["doc_id"]]["text"] or ""
        assert row["n_tokens"] == len(text.encode().split())
        cells[row["source"], row["lang"], row["topic"]] += row["n_tokens"]
    cells = {cell: value for cell, value in cells.items() if value}
    targets = []
    for axis in range(3):
        sums = defaultdict(float)
        for cell, value in cells.items():
            sums[cell[axis]] += value
        total = sum(value**raking.TEMPER for value in sums.values())
        targets.append({value: tokens**raking.TEMPER / total for value, tokens in sums.items()})
    exact = plain(cells, targets)
    for row in rows:
        if row["n_tokens"]:
            cell = row["source"], row["lang"], row["topic"]
            assert row["weight"] * cells[cell] == pytest.approx(exact[cell], abs=3 * raking.TOLERANCE)
    expected = sum(row["n_tokens"] * row["probability"] for row in rows)
    assert expected == pytest.approx(raking.KEEP * sum(cells.values()), rel=0.01)
    drawn = sum(row["n_tokens"] for row in rows if row["drawn"])
    spread = sum(row["n_tokens"] ** 2 * row["probability"] * (1 - row["probability"]) for row in rows) ** 0.5
    assert abs(drawn - expected) < 4 * spread


def test_given_targets_flatten_a_hot_source(spark):
    rng = random.Random(3)
    rows = [(at, prose(at, 20), rng.choice(["en", "de"]), "hot" if at % 3 else f"s{at % 2}") for at in range(300)]
    wanted = {"source": {"=hot": 1 / 3, "=s0": 1 / 3, "=s1": 1 / 3}}
    found = mix(docs_frame(spark, rows), wanted=wanted, keep=0.4).collect()
    sums = defaultdict(float)
    for row in found:
        sums[row["source"]] += row["mix"]["weight"] * row["mix"]["tokens"]
    assert np.allclose([sums["hot"], sums["s0"], sums["s1"]], 1 / 3, atol=1e-3)
    chance = {row["source"]: row["mix"]["probability"] for row in found}
    assert chance["hot"] < chance["s0"]


def test_edges(spark):
    docs = docs_frame(spark, [row + (None, None) if at % 2 else row + ("en", "") for at, row in enumerate(edge_rows())])
    found = mix(docs, name="drawn").collect()
    assert len(found) == docs.count()
    assert all(0 < row["drawn"]["probability"] <= 1 for row in found)
    assert all(row["drawn"]["tokens"] == 0 and row["drawn"]["drawn"] for row in found if row["doc_id"] in (1, 2, 3))
    assert {row["drawn"]["source"] for row in found} == {"=", "null"}
    kept = sample(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, sample(docs).collect()))
    assert sample(docs_frame(spark, [])).collect() == []
    assert sample(docs_frame(spark, [(1, None), (2, "")])).count() == 2
