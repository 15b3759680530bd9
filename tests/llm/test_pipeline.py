import corpus_pipeline
from llm import secret_links, vector_join
from llm.common import stage, table

from .helpers import docs_frame, edge_rows
from .test_sos_packing import check
from .test_vector_join import plain


def test_every_stage_on_its_own_input(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    seen = {}
    for name, apply in corpus_pipeline.STAGES:
        before = docs
        docs = stage(apply(spark, docs, sf_dir), "test")
        seen[name] = before.collect(), docs.collect()
        if name != "packing":
            assert docs.columns == before.columns
    texts = lambda rows: {row["doc_id"]: row["text"] for row in rows}
    before, after = map(texts, seen["language"])
    assert set(after) == {doc for doc, text in before.items() if any(map(str.isalpha, text or ""))}
    before, after = map(texts, seen["near_duplicates"])
    assert set(after) == {component for _, _, component in plain(list(before.items()))}
    before, after = map(texts, seen["secrets"])
    assert set(before) == set(after)
    changed = {doc for doc in before if before[doc] != after[doc]}
    assert {doc for doc, text in before.items() if secret_links.scan(text)[0]} <= changed
    assert all(not secret_links.scan(after[doc])[0] for doc in changed)
    assert all(row["n_chars"] == len(row["text"]) for row in seen["secrets"][1] if row["doc_id"] in changed)
    before, after = map(texts, seen["mixing"])
    assert 0.35 * len(before) < len(after) < len(before) and all(before[doc] == text for doc, text in after.items())
    check(seen["packing"][1], texts(seen["packing"][0]))


def test_edges(spark, sf_dir):
    docs = docs_frame(spark, edge_rows())
    for name, apply in corpus_pipeline.STAGES:
        after = stage(apply(spark, docs, sf_dir), "test")
        assert name == "packing" or after.columns == docs.columns
        assert stage(apply(spark, docs.limit(0), sf_dir), "test").count() == 0
        docs = after
    assert docs.count() > 0
    assert vector_join.prefix(0) == 0
