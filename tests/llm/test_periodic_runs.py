import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.common import word_hashes, words
from llm.periodic_runs import MIN_WORDS, collapse_runs, find_runs, runs_of, sources, summarize_runs

from .helpers import docs_frame, edge_rows, prose



def plain_runs(found):
    """All runs by comparing words a period apart, for every period."""
    out = set()
    for period in range(1, len(found) // 2 + 1):
        at = 0
        while at + period < len(found):
            if found[at] != found[at + period]:
                at += 1
                continue
            stop = at
            while stop + period < len(found) and found[stop] == found[stop + period]:
                stop += 1
            length = stop + period - at
            if length >= max(MIN_WORDS, 2 * period) and not any(
                all(found[place] == found[place + smaller] for place in range(at, at + length - smaller)) for smaller in range(1, period)
            ):
                out.add((at, length, period))
            at = stop
    return sorted(out, key=lambda run: (run[0], run[2]))


def plain(doc_id, text):
    found = words(text)
    count, mark = len(found), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if mark % 10 == 0 and count:
        share = mark // 10
        begin = share % count
        period = 1 + (count - begin) // (3 + share % 8)
        found = [found[at] if at < begin else found[begin + (at - begin) % period] for at in range(count)]
    runs = plain_runs(found)
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    kept = b" ".join(word for at, word in enumerate(found) if at not in gone)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def found_runs(found):
    hashes, _ = word_hashes(pa.array([b" ".join(found).decode()]))
    return runs_of(found, hashes)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(0, 5), st.integers(1, 6))
def test_runs_of_few_words(found, begin, times):
    found = found + found[begin : begin + 7] * times + found[:5]
    assert found_runs(found) == plain_runs(found)


@pytest.mark.parametrize("seed", range(40))
def test_runs_in_runs(seed):
    rng = random.Random(seed)
    found = []
    while len(found) < 300:
        motif = [rng.choice([b"x", b"y", b"z", b"%d" % rng.randrange(30)]) for _ in range(rng.randrange(1, 12))]
        found += motif * rng.randrange(1, 9)
        if rng.random() < 0.3:
            found = found + found[-40:]
    assert found_runs(found) == plain_runs(found)


def test_one_word_repeated():
    assert found_runs([b"a"] * 5000) == [(0, 5000, 1)]
    assert found_runs([b"a"] * 11) == []
    assert found_runs([b"a", b"b"] * 6) == [(0, 12, 2)]
    assert found_runs([b"a", b"b"] * 5 + [b"a"]) == []


def test_documents(spark):
    line = "buy now at our shop "
    rows = [(at, prose(at, 30 + at * 3)) for at in range(120)]
    rows += [(200 + at, prose(at, at) + " " + line * (at % 9) + prose(at + 1, 20)) for at in range(60)]
    rows += [(300, "a " * 40 + "b " * 40 + "a " * 40), (301, "Ä ß " * 9)]
    found = [tuple(row) for row in summarize_runs(docs_frame(spark, rows)).collect()]
    assert sorted(found) == sorted(plain(*row) for row in rows)
    assert sum(row[1] > 0 for row in found) > 20


def test_rewritten_documents_are_periodic():
    marked = [doc for doc in range(200) if zlib.crc32(str(doc).encode()) % 10 == 0]
    assert marked and all(sources(doc, 0).tolist() == [] for doc in marked)
    assert any(sources(doc, 100).tolist() != list(range(100)) for doc in marked)
    assert all(sources(doc, 100).tolist() == list(range(100)) for doc in set(range(200)) - set(marked))


def test_edges(spark):
    rows = [row for row in edge_rows() if row[1] is None or len(row[1]) < 60_000]
    found = [tuple(row) for row in summarize_runs(docs_frame(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted((plain(*row) for row in rows), key=str)
    long = [row for row in edge_rows() if row not in rows] + [(12, "one two three " * 20_000)]
    assert sorted((row["doc_id"], row["n_runs"]) for row in summarize_runs(docs_frame(spark, long), rewrite=False).collect()) == [
        (6, 0), (7, 0), (12, 1)
    ]
    assert summarize_runs(docs_frame(spark, [])).collect() == []


def test_spans_and_texts(spark):
    frame = docs_frame(spark, [(1, "start " + "a b c " * 5 + "end"), (2, "no runs here"), (None, None)])
    assert [tuple(row) for row in find_runs(frame).collect()] == [(1, 1, 15, 3)]
    assert sorted((tuple(row) for row in collapse_runs(frame).collect()), key=str) == [
        (1, 12, "start a b c end"), (2, 0, "no runs here"), (None, 0, "")
    ]
