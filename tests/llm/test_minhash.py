import hashlib

import numpy as np
import pyarrow as pa

from llm import minhash
from llm.common import table
from llm.minhash import likeness, near_duplicates, signature, text_shingles
from llm.queries import QUERIES

from .helpers import docs_frame, edge_rows, prose


def test_neighbours_and_edited_texts(spark, sf_dir):
    rows = {row["doc_id"]: row for row in QUERIES["op10_minhash"](spark, sf_dir).collect()}
    texts = {row["doc_id"]: row["text"] or "" for row in table(spark, sf_dir, "documents").collect()}
    ids = sorted(texts, reverse=True)
    assert set(rows) == set(ids)
    prints = {}
    for doc, after in zip(ids, ids[1:] + ids[:1]):
        row, third = rows[doc], len(texts[doc]) // 3
        changed = texts[doc][: len(texts[doc]) - third] + texts[after][:third]
        assert (row["n_chars"], row["edited_sha256"]) == (len(texts[doc]), hashlib.sha256(changed.encode()).hexdigest())
        own, new, other = (signature(one) for one in text_shingles(pa.array([texts[doc], changed, texts[after]])))
        assert (row["fingerprint"], row["edited_fingerprint"]) == (minhash.printed(own), minhash.printed(new))
        assert (row["near_edited"], row["near_next"]) == (likeness(own, new), likeness(own, other))
        assert prints.setdefault(texts[doc], row["fingerprint"]) == row["fingerprint"]
    assert np.mean([row["near_edited"] for row in rows.values()]) > 0.3 > np.mean([row["near_next"] for row in rows.values()])


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for shared in (0, 500, 1000, 1400):
        one, other = base[:1500], np.r_[base[:shared], base[1500 : 3000 - shared]]
        exact = shared / (len(one) + len(other) - shared)
        assert abs(likeness(signature(one), signature(other)) - exact) < 0.15
    assert likeness(signature(base[:0]), signature(base[:0])) == 1 and likeness(signature(base), signature(base[:0])) == 0


def test_edges(spark):
    rows = minhash.compare_with_next(docs_frame(spark, edge_rows())).collect()
    assert len(rows) == len(edge_rows())
    assert all(row["fingerprint"] == "" for row in rows if row["doc_id"] in (1, 2, 3))
    alone = minhash.compare_with_next(docs_frame(spark, [(1, "a b c")])).collect()
    assert [(row["doc_id"], row["near_next"]) for row in alone] == [(1, 1.0)]
    assert minhash.compare_with_next(docs_frame(spark, [])).collect() == []


def test_band_join_finds_near_copies_and_verifies_them(spark):
    base = prose(21, 200).split()
    rows = [(at, " ".join(base[:at] + ["changed"] + base[at + 1 :])) for at in range(0, 200, 10)]
    rows += [(500 + at, prose(600 + at, 100)) for at in range(20)] + [(900, rows[0][1]), (901, rows[0][1]), (902, None), (903, "")]
    found = {row["doc_id"]: row for row in near_duplicates(docs_frame(spark, rows)).collect()}
    assert set(found) == {doc for doc, text in rows if text}
    assert found[900]["class_id"] == found[901]["class_id"] == 0
    sets = dict(zip([doc for doc, _ in rows], text_shingles(pa.array([text for _, text in rows], pa.string()))))
    for doc, row in found.items():
        for link in row["links"] or []:
            one, other = sets[row["class_id"]], sets[link["class_id"]]
            shared = len(np.intersect1d(one, other))
            assert link["similarity"] == shared / (len(one) + len(other) - shared) >= 0.75
        assert doc >= 500 or doc == 0 or row["links"]
        assert doc < 500 or doc >= 900 or not row["links"]
    assert near_duplicates(docs_frame(spark, [])).collect() == []


def test_band_join_gives_all_links_and_components(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = prose(21, 200).split()
    rows = [(at, " ".join(base[:at] + ["changed"] + base[at + 1 :])) for at in range(0, 200, 10)]
    rows += [(1000 + step, " ".join(base[step * 12 :] + prose(77, step * 12 + 1).split())) for step in range(9)]
    rows += [(500 + at, prose(600 + at, 100)) for at in range(10)] + [(900, rows[0][1])]
    sets = dict(zip([doc for doc, _ in rows], text_shingles(pa.array([text for _, text in rows], pa.string()))))
    bands, links = {doc: signature(one).view("<u8") for doc, one in sets.items()}, {}
    name = {doc: min(other for other in sets if np.array_equal(sets[doc], sets[other])) for doc in sets}
    for one in set(name.values()):
        for other in set(name.values()) - {one}:
            shared = len(np.intersect1d(sets[one], sets[other]))
            likeness = shared / (len(sets[one]) + len(sets[other]) - shared)
            if (bands[one] == bands[other]).any() and likeness >= 0.75:
                links.setdefault(one, {})[other] = likeness
    component = {doc: doc for doc in name.values()}
    for _ in component:
        component = {doc: min([component[doc], *(component[other] for other in links.get(doc, ()))]) for doc in component}
    found = {row["doc_id"]: row for row in near_duplicates(docs_frame(spark, rows)).collect()}
    assert set(found) == set(sets) and len(links[0]) >= 19
    for doc, row in found.items():
        mine = links.get(name[doc], {})
        assert (row["class_id"], row["n_links"], row["component_id"]) == (name[doc], len(mine), component[name[doc]])
        assert {link["class_id"]: link["similarity"] for link in row["links"] or []} == {other: of for other, of in mine.items() if other < name[doc]}
