import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm import prefix_doubling
from llm.prefix_doubling import LENGTH, bounds_of, families, parsed, placed, ranked, remove_repeats, stacked, twice_at_least

from .helpers import docs_frame, edge_rows, prose


def plain(rows):
    """(doc_id, bytes, removed, runs, checksum) by counting all strings."""
    raws = [(doc, (text or "").encode()) for doc, text in rows]
    counts = Counter(raw[at : at + LENGTH] for _, raw in raws for at in range(len(raw) - LENGTH + 1))
    out = []
    for doc, raw in raws:
        gone, reach = bytearray(len(raw)), 0
        for at in range(len(raw) - LENGTH + 1):
            if counts[raw[at : at + LENGTH]] > 1:
                begin = max(at, reach)
                reach = at + LENGTH
                gone[begin:reach] = b"\1" * (reach - begin)
        spans = sum(gone[at] and (at == 0 or not gone[at - 1]) for at in range(len(raw)))
        kept = bytes(byte for byte, go in zip(raw, gone) if not go)
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found_rows(frame):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(row[name] for name in names) for row in frame.collect()), key=str)


def mixed_rows(seed, count=120):
    """Texts put together from shared passages of all lengths around the limit, and own words."""
    rng = random.Random(seed)
    passages = [prose(seed * 1000 + at, 60)[: rng.randrange(150, 330)] for at in range(12)]
    rows = []
    for doc in range(count):
        parts = [prose(seed * 5000 + doc, rng.randrange(5, 60))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            cut = rng.randrange(0, 90)
            parts += [rng.choice([passage, passage[cut:], passage[:-cut or None], passage[:100] + "#" + passage[100:]]), prose(rng.randrange(10**6), rng.randrange(12))]
        rows.append((doc, rng.choice(["", " ", "\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_shared_passages(spark, seed):
    rows = mixed_rows(seed)
    assert found_rows(remove_repeats(docs_frame(spark, rows), with_text=False)) == plain(rows)


def test_lengths_around_the_limit_at_all_offsets(spark):
    passage = prose(77, 60)
    rows = [(size, prose(100 + size, size % 7) + passage[:size] + f"|{size}" * 30) for size in range(190, 215)]
    rows += [(300 + cut, f"{cut}~" * 25 + passage[cut : cut + 200] + f"{cut}!" * 40) for cut in range(0, 70, 3)]
    assert found_rows(remove_repeats(docs_frame(spark, rows))) == plain(rows)


def test_repeats_inside_a_text(spark):
    rows = [
        (1, "x" * 1000), (2, "ab" * 300), (3, "x" * 199), (4, "y" * 200), (5, "y" * 201), (6, prose(5, 40) * 3), (7, ("line " + prose(6, 8) + "\n") * 40),
        (8, "xy" * 80 + "x" * 220), (9, prose(8, 25) + "é" * 150 + prose(9, 25) + "é" * 150), (10, "".join(chr(97 + at % 23) for at in range(2000))),
    ]
    assert found_rows(remove_repeats(docs_frame(spark, rows))) == plain(rows)


def test_copies_and_edges(spark):
    rows = [row for row in edge_rows() if row[0] not in (6, 7)] + [(at, prose(at % 3, 60)) for at in range(20, 60)]
    rows += [(70, prose(0, 60)[:260] + prose(71, 30)), (71, "short"), (72, "short")]
    frame = remove_repeats(docs_frame(spark, rows))
    assert found_rows(frame) == plain(rows)
    assert all(hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"] for row in frame.collect())
    assert remove_repeats(docs_frame(spark, [])).collect() == []
    long = [(6, prose(1, 30_000)), (7, prose(1, 30_000) + " tail")]
    removed = {row["doc_id"]: (row["n_bytes"], row["n_removed"]) for row in remove_repeats(docs_frame(spark, long)).collect()}
    assert removed[6][0] == removed[6][1] and removed[7] == (removed[6][0] + 5, removed[6][0])


def test_small_batches(spark, monkeypatch):
    """Groups, texts and cores that go on from batch to batch."""
    rows = mixed_rows(9, 60) + [(200 + at, prose(3, 50) + str(at)) for at in range(30)]
    expected = plain(rows)
    monkeypatch.setattr(prefix_doubling, "small_batches", lambda session: None)
    for size in ("1", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert found_rows(remove_repeats(docs_frame(spark, rows), with_text=False)) == expected
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ranks_of_groups_over_several_ranges(spark, monkeypatch):
    """Ranks are equal for equal keys and ordered as the keys are, and positions that are alone go, also at ends of ranges."""
    monkeypatch.setattr(prefix_doubling, "few", lambda frame: frame)
    rng = random.Random(4)
    for case in range(6):
        spread = [3, 40, 400, 2000, 10**6, 2][case]
        rows = [(rng.randrange(spread) if at % 3 else 1, rng.randrange(30), at) for at in range(1000)]
        frame = spark.createDataFrame(rows, "first long, mark long, at long").repartition(3)
        bounds = bounds_of(frame, ["first"], 9)
        part = lambda batches: (placed(list(stacked(batch)), bounds, ["first", "mark", "at"]) for batch in batches)
        dealt = frame.mapInArrow(part, "part long, first long, mark long, at long")
        found = {(row["mark"], row["at"]): row["rank"] for row in ranked(dealt, ["first"], 9).collect()}
        counts = Counter(first for first, _, _ in rows)
        assert set(found) == {(mark, at) for first, mark, at in rows if counts[first] > 1}
        by_rank = {}
        for first, mark, at in rows:
            if (mark, at) in found:
                by_rank.setdefault(found[mark, at], set()).add(first)
        assert [min(by_rank[rank]) for rank in sorted(by_rank)] == sorted(first for first in counts if counts[first] > 1)
        assert all(len(keys) == 1 for keys in by_rank.values())
        assert sorted((row["mark"], row["at"]) for row in twice_at_least(frame, ["first"]).collect()) == sorted(found)


def test_ranges_follow_the_order_of_rows():
    rng = np.random.default_rng(3)
    columns = list(rng.integers(0, 4, (3, 500)))
    bounds = np.unique(rng.integers(0, 4, (3, 20)), axis=1)
    expected = [sum(tuple(bound) <= tuple(row) for bound in bounds.T.tolist()) for row in np.stack(columns, 1).tolist()]
    assert prefix_doubling.ranges(columns, bounds).tolist() == expected


def test_every_string_has_an_anchor():
    texts = [prose(3, 300), "x" * 700, prose(4, 30), "z" * 199, None, "ab" * 200]
    seen = {}
    for text, raw, anchors, firsts in parsed(pa.array(texts)):
        begins, ends = families(len(raw), firsts)
        seen[text] = [begin for one, two in zip(begins, ends) for begin in range(one, two + 1)]
        assert all(one <= anchor < one + prefix_doubling.REACH and two <= anchor for anchor, one, two in zip(anchors, begins, ends))
    assert seen == {at: list(range(len(text) - LENGTH + 1)) for at, text in enumerate(texts) if text and len(text) >= LENGTH}
