import zlib

import numpy as np

from llm import language_tree
from llm.common import table
from llm.queries import QUERIES

from .helpers import docs_frame, edge_rows


def test_held_out_accuracy(spark, sf_dir):
    truth = {row["doc_id"]: row["lang"] for row in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op3_language_tree"](spark, sf_dir).collect()
    assert {row["doc_id"] for row in rows} == set(truth)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row["held_out"] and row["lang_pred"] != "und"]
    assert np.mean([row["lang_pred"] == truth[row["doc_id"]] for row in held]) >= 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_labels_of_the_held_out_fold_and_ids_have_no_influence(spark):
    docs = [(at, "the and of to " * 5 + str(at), "en") for at in range(40)] + [(at, "der und die das " * 5, "de") for at in range(40, 80)]
    held = {at for at in range(80) if zlib.crc32(str(at).encode()) % 4 == 2}
    changed = [(at, text, "xx" if at in held else lang) for at, text, lang in docs]
    both = [{row["doc_id"]: (row["lang_pred"], row["score"]) for row in language_tree.identify(docs_frame(spark, rows)).collect()} for rows in (docs, changed)]
    assert both[0] == both[1]
    assert {lang for lang, _ in both[0].values()} == {"en", "de"}


def test_families_join_near_languages():
    means = np.array([[1, 0, 0], [0.9, 0.1, 0], [0, 1, 0], [0, 0.9, 0.1]])
    assert language_tree.families(means) == [[0, 1], [2, 3]]


def test_support_vector_machine_separates():
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(0.3, 0.1, (50, 3)), rng.normal(-0.3, 0.1, (5, 3))])
    signs = np.r_[np.ones(50), -np.ones(5)]
    weights = language_tree.support_vector_machine(points, signs)
    assert ((np.hstack([points, np.ones((55, 1))]) @ weights > 0) == (signs > 0)).all()


def test_features_read_whole_texts_in_chunks(monkeypatch):
    text = "Straße und Häuser, 12 Bäume! " * 50
    whole = language_tree.features(text)
    monkeypatch.setattr(language_tree, "CHUNK_BYTES", 17)
    assert np.array_equal(language_tree.features(text), whole)


def test_edges(spark):
    rows = language_tree.identify(docs_frame(spark, edge_rows())).collect()
    assert len(rows) == len(edge_rows())
    none = {row["doc_id"]: row for row in rows if row["doc_id"] in (1, 2, 3)}
    assert all((row["lang_pred"], row["score"]) == ("und", 0.0) for row in none.values())
    assert {row["lang_pred"] for row in rows if row["doc_id"] in (4, 5, 10)} == {"en"}
    unlabelled = docs_frame(spark, [(1, "text", None), (2, "123", "en")])
    assert {row["lang_pred"] for row in language_tree.identify(unlabelled).collect()} == {"und"}
    assert language_tree.identify(docs_frame(spark, [])).collect() == []


def test_undetermined_documents_go_and_columns_stay(spark):
    docs = docs_frame(spark, edge_rows() + [(20, "12 34 !!")])
    kept = language_tree.drop_undetermined(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(str(row["doc_id"]) for row in rows) == sorted(str(row[0]) for row in edge_rows() if (row[1] or "").strip())
    assert all(row["lang_pred"] == 7 and row["lang"] == "en" for row in rows)
