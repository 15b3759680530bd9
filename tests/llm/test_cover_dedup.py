import hashlib

import numpy as np

from llm import cover_dedup
from llm.common import words
from llm.cover_dedup import COVER, PERIOD, WINDOW, remove_repeats

from .helpers import docs_frame, edge_rows, prose


def plain(rows):
    """(doc_id, words, removed, checksum) by comparing all windows."""
    place = lambda doc: cover_dedup.LAST_ID if doc is None else doc
    first = {}
    found = [(doc, words(text)) for doc, text in rows]
    for doc, listed in found:
        for at in range(len(listed) - WINDOW + 1):
            window = tuple(listed[at : at + WINDOW])
            first[window] = min(first.get(window, place(doc)), place(doc))
    out = []
    for doc, listed in found:
        gone = set()
        for at in range(len(listed) - WINDOW + 1):
            if first[tuple(listed[at : at + WINDOW])] < place(doc):
                gone.update(range(at, at + WINDOW))
        kept = b" ".join(word for at, word in enumerate(listed) if at not in gone)
        out.append((doc, len(listed), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_planted_passages_at_all_alignments(spark):
    passage, other = prose(50, 50), prose(51, 70)
    rows = [(at, prose(100 + at, at) + " " + passage + "\n" + prose(200 + at, 33)) for at in range(40)]
    rows += [(100 + at, " ".join([other] * at) + "\t" + prose(300 + at, at)) for at in range(4)]
    rows += [(200, prose(50, 49)), (201, passage.upper()), (-5, "x " * 200), (202, "x " * 60)]
    found = remove_repeats(docs_frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=str) == plain(rows)
    assert all(row["n_removed"] == 50 for row in found if 0 < row["doc_id"] < 40)
    assert all(hashlib.sha256(row["kept_text"].encode()).hexdigest() == row["kept_sha256"] for row in found)


def test_edges(spark):
    found = remove_repeats(docs_frame(spark, edge_rows()), with_text=False).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=str) == plain(edge_rows())
    assert remove_repeats(docs_frame(spark, [])).collect() == []


def test_every_difference_is_a_difference_of_two_residues():
    differences = {int(one - other) % PERIOD for one in COVER for other in COVER}
    assert differences == set(range(PERIOD)) and len(COVER) * (len(COVER) - 1) == PERIOD - 1


def test_windows_around_an_anchor():
    assert cover_dedup.windows_around(np.array([35]), 100).tolist() == list(range(5, 36))
    assert cover_dedup.windows_around(np.array([3, 60]), 40).tolist() == list(range(0, 4)) + list(range(30, 40))
