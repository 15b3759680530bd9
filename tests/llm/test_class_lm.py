import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.sources.scratch import exists
from llm import class_lm
from llm.common import table, words
from llm.queries import QUERIES

from .helpers import docs_frame, edge_rows


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return {row["doc_id"]: row for row in QUERIES["op1_class_lm"](spark, sf_dir).collect()}


def test_base_score_is_the_unigram_sum(spark, sf_dir, scored):
    docs = table(spark, sf_dir, "documents").collect()
    tokens = {row["doc_id"]: [*words(row["text"], lower=True), None] for row in docs}
    held = {doc: zlib.crc32(str(doc).encode()) % 10 == 0 for doc in tokens}
    counts = Counter(token for doc, found in tokens.items() if not held[doc] for token in found)
    total, kinds = sum(counts.values()), len(counts)
    for doc, found in tokens.items():
        row = scored[doc]
        base = sum(np.log10((counts[token] + 0.1) / (total + 0.1 * (kinds + 1))) for token in found)
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held[doc], len(found), total)
        assert row["n_known"] == sum(counts[token] > 0 for token in found)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)


def test_held_out_texts_score_better_than_the_unigram_model(scored):
    rows = [row for row in scored.values() if row["held_out"]]
    assert sum(row["score"] for row in rows) > sum(row["base_score"] for row in rows)
    assert rows[0]["perplexity"] == pytest.approx(10 ** (-rows[0]["score"] / rows[0]["n_tokens"]))


def test_score_agrees_with_a_plain_loop_and_probabilities_sum_to_one(spark, sf_dir, scored, monkeypatch):
    texts = class_lm.chosen(table(spark, sf_dir, "documents"), "doc_id", "text")
    training = texts.where(~F.col("held_out"))
    counts = class_lm.word_counts(training)
    model = class_lm.train(training, counts)
    vocab, kind = model.vocab, model.symbol_class
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    for number in set(kind[vocab.symbols].tolist()):
        members = kind[vocab.symbols] == number
        assert (10 ** model.emission[members]).sum() == pytest.approx(1)
    # Few frequent words, so that the rest goes through the join.
    monkeypatch.setattr(class_lm, "vocabulary", lambda counts, original=class_lm.vocabulary: original(counts, 300, 100))
    rows = {row["doc_id"]: row for row in class_lm.score_documents(table(spark, sf_dir, "documents")).collect()}
    few = class_lm.train(training, counts)
    every = {row["word"]: row["count"] for row in counts.collect()}
    assert 0 < len(few.vocab.words) <= 300
    import pyarrow as pa

    for row in texts.limit(20).collect():
        found, _ = class_lm.tokens(pa.array([row["text"]], pa.string()))
        score, before = 0.0, few.symbol_class[few.vocab.end]
        for word in found.tolist():
            at = int(np.searchsorted(few.vocab.words, word))
            if word == class_lm.END:
                now = few.symbol_class[few.vocab.end]
            elif at < len(few.vocab.words) and few.vocab.words[at] == word:
                now = few.symbol_class[few.vocab.symbols[at]]
                score += few.emission[at]
            else:
                now = few.symbol_class[few.vocab.rare]
                score += np.log10((every.get(word, 0) + class_lm.ADDED) / few.rare_denominator)
            score += few.transition[before, now]
            before = now
        assert rows[row["doc_id"]]["score"] == pytest.approx(score, rel=1e-9)


def likelihood(matrix, of):
    member = np.eye(of.max() + 1)[of]
    pairs = member.T @ matrix @ member
    return class_lm.h(pairs).sum() - class_lm.h(pairs.sum(axis=0)).sum() - class_lm.h(pairs.sum(axis=1)).sum()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exchange_ends_where_no_single_move_gains(seed):
    rng = np.random.default_rng(seed)
    matrix = rng.integers(0, 30, (14, 14)).astype(float)
    matrix[:6, 6:12] += rng.integers(20, 60, (6, 6))
    start = np.concatenate([np.arange(12) % 3, [3, 4]])
    of = class_lm.exchange(matrix, 12, classes=3, sweeps=50)
    best = likelihood(matrix, of)
    assert best > likelihood(matrix, start) and (of[12:] == start[12:]).all()
    for word in range(12):
        for other in range(3):
            moved = of.copy()
            moved[word] = other
            assert likelihood(matrix, moved) <= best + 1e-6


def test_edges(spark):
    rows = class_lm.score_documents(docs_frame(spark, edge_rows())).collect()
    assert len(rows) == len(edge_rows())
    assert {row["n_tokens"] for row in rows if row["doc_id"] in (1, 2, 3)} == {1}
    assert len({row["score"] for row in rows if row["doc_id"] in (1, 2, 3)}) == 1
    assert all(np.isfinite([row["score"], row["base_score"]]).all() for row in rows)
    assert class_lm.score_documents(docs_frame(spark, [])).collect() == []


def test_words_beyond_the_core_join_the_classes_of_their_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(5)
    names = {side: [f"{side}{number}" for number in range(60)] for side in "ab"}
    chance = 1 / np.arange(3, 63)
    texts = [" ".join(rng.choice(names["ab"[place % 2]], 80, p=chance / chance.sum())) for place in range(200)]
    monkeypatch.setattr(class_lm, "vocabulary", lambda counts, original=class_lm.vocabulary: original(counts, 1000, 24))
    docs = class_lm.chosen(docs_frame(spark, list(enumerate(texts))), "doc_id", "text")
    model = class_lm.train(docs, class_lm.word_counts(docs))
    import pyarrow as pa

    side_of = {}
    for side, found in names.items():
        hashes, _ = class_lm.tokens(pa.array([" ".join(found)]))
        at, known = model.vocab.look_up(hashes[:-1])
        for number in model.symbol_class[model.vocab.symbols[at[known]]].tolist():
            side_of.setdefault(number, set()).add(side)
    assert len(model.vocab.words) == 120 and all(len(sides) == 1 for sides in side_of.values())


@pytest.mark.parametrize("seed", range(8))
def test_a_word_moves_to_the_class_that_raises_the_likelihood_most(seed):
    rng = np.random.default_rng(seed)
    # Of seven words, the rare class and the end, words 0 and 5 share a class and word 5 moves.
    matrix = rng.integers(0, 60, (9, 9)).astype(float)
    matrix[5, 5] = 0
    of = np.array([0, 1, 2, 3, 4, 0, 5, 6, 7])
    moved = [np.where(np.arange(9) == 5, place, of) for place in range(6)]
    best = max(range(6), key=lambda place: likelihood(matrix, moved[place]))
    pairs, member = class_lm.summed(matrix, of), np.eye(8)[of]
    chosen = class_lm.best_classes(pairs, of[5:6], (matrix[:, 5] @ member)[None], (matrix[5] @ member)[None])
    assert chosen.tolist() == [best]


def test_words_beyond_the_broadcast_ones_have_classes_and_transitions_of_their_own(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(class_lm, "FREQUENT", 300)
    monkeypatch.setattr(class_lm, "CORE", 100)
    monkeypatch.setattr(class_lm, "vocabulary", lambda counts, original=class_lm.vocabulary: original(counts, core=100))
    models, original = [], class_lm.fit
    monkeypatch.setattr(class_lm, "fit", lambda *given: models.append(original(*given)) or models[-1])
    docs = table(spark, sf_dir, "documents")
    rows = {row["doc_id"]: row for row in class_lm.score_documents(docs).collect()}
    model, texts = models[0], class_lm.chosen(docs, "doc_id", "text").collect()
    vocab = model.vocab
    counts = {row["word"]: row["count"] for row in class_lm.word_counts(class_lm.chosen(docs, "doc_id", "text").where(~F.col("held_out"))).collect()}
    place = {row["word"]: row["class"] for row in model.rest.words.collect()}
    assert 0 < len(vocab.words) <= 300 and len(place) + len(vocab.words) + 1 == len(counts) and vocab.rare not in place.values()
    assert sum(number < 64 for number in place.values()) > len(place) / 2  # they left their bands
    place |= dict(zip(vocab.words.tolist(), vocab.symbols.tolist())) | {class_lm.END: vocab.end}
    import pyarrow as pa

    pairs, found = np.zeros((vocab.n_symbols,) * 2), {}
    for row in texts:
        hashes = class_lm.tokens(pa.array([row["text"]], pa.string()))[0].tolist()
        found[row["doc_id"]] = hashes, [place.get(word, vocab.rare) for word in hashes]
        if not row["held_out"]:
            kinds = found[row["doc_id"]][1]
            np.add.at(pairs, ([vocab.end, *kinds[:-1]], kinds), 1)
            for at, word in enumerate(hashes):
                if counts[word] == 1 and word != class_lm.END:
                    pairs[kinds[at - 1] if at else vocab.end, vocab.rare] += 1
                    pairs[vocab.rare, kinds[at + 1]] += 1
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + len(pairs))
    transition = np.log10((pairs + class_lm.BACKOFF * share) / (pairs.sum(axis=1, keepdims=True) + class_lm.BACKOFF))
    sums = np.zeros(len(pairs))
    sums[vocab.rare] = class_lm.ADDED
    for word, count in counts.items():
        sums[place[word]] += count + class_lm.ADDED
    for doc, (hashes, kinds) in found.items():
        # The end is alone in its class.
        words_only = sum(np.log10((counts.get(word, 0) + class_lm.ADDED) / sums[kind]) for word, kind in zip(hashes, kinds) if word != class_lm.END)
        assert rows[doc]["score"] == pytest.approx(words_only + transition[[vocab.end, *kinds[:-1]], kinds].sum(), rel=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_words_with_few_neighbours_choose_as_others_do(seed):
    rng = np.random.default_rng(seed)
    of = np.r_[np.arange(40) % 8, 8, 9]
    matrix = rng.integers(0, 3, (42, 42)) * rng.integers(0, 2, (42, 42)) * rng.choice([1.0, 1.0, 30.0], (42, 42))
    matrix[np.arange(40), np.arange(40)] = 0
    pairs, member = class_lm.summed(matrix, of), np.eye(10)[of]
    before, after = matrix[:, :40].T @ member, matrix[:40] @ member
    assert (class_lm.few_classes(pairs)(of[:40], before, after) == class_lm.best_classes(pairs, of[:40], before, after)).all()


def test_superseded_tables_are_deleted(spark, sf_dir, monkeypatch):
    """Of the words beyond the frequent ones one table is left when the model is fitted, of their pairs none."""
    monkeypatch.setattr(class_lm, "FREQUENT", 300)
    staged, original = [], class_lm.stage
    monkeypatch.setattr(class_lm, "stage", lambda df, label: staged.append((label, original(df, label))) or staged[-1][1])
    docs = class_lm.chosen(table(spark, sf_dir, "documents"), "doc_id", "text")
    class_lm.train(docs, class_lm.word_counts(docs))
    places = lambda label: [{name.rsplit("/", 1)[0] for name in frame.inputFiles()} for of, frame in staged if of == label]
    left = {label: [all(exists(spark, path) for path in paths) for paths in places(label)] for label in ("rest-words", "rest-pairs")}
    assert left == {"rest-words": [False, False, True], "rest-pairs": [False, False, False]}


def test_counts_go_to_their_share_in_one_row():
    code = np.unique(np.random.default_rng(3).integers(0, 50 * 12, 200))
    (batch,) = class_lm.dealt_rows(7, 12)(code, code + 1)
    assert batch.num_rows == 7 and batch.column(0).to_pylist() == list(range(7))
    found = {}
    for share, codes, times in zip(*(column.to_pylist() for column in batch.columns)):
        for place, number in zip(np.frombuffer(codes, "<i4").tolist(), np.frombuffer(times, "<i4").tolist()):
            found[(place // 12 * 7 + share) * 12 + place % 12] = number
    assert found == dict(zip(code.tolist(), (code + 1).tolist()))
    (few,) = class_lm.dealt_rows(7, 12)(np.array([2 * 12 + 5]), np.array([4]))
    assert few.to_pylist() == [{"share": 2, "codes": np.array([5], "<i4").tobytes(), "times": np.array([4], "<i4").tobytes()}]


def test_words_seen_once_choose_as_others_do(spark, monkeypatch):
    """Those with the same class and neighbours are looked at once, and all end where the plain way puts them."""
    draw, classes = np.random.default_rng(8), 5
    size = classes + 2
    pairs = draw.integers(20, 60, (size, size)).astype(float)
    vocab = class_lm.Vocabulary(np.arange(10), np.full(10, 9), np.arange(10) % classes, size, 0, 99, 99, 1, {}, False)
    table = class_lm.symbol_table(vocab)
    rows, around, met = [], np.zeros((300, 2, size)), []
    for word in range(300):
        number = 1 if word % 3 else 3
        sides = draw.choice([*range(10), class_lm.END_PLACE], (2, number)).tolist()
        if word % 10 == 0:
            sides[1][0], beside = class_lm.REST_PLACE, int(draw.integers(0, classes))
            met.append((word, 1000 + word, 1, int(word % classes), beside, False, False))
            around[word, 1, beside] += 1
        for side in (0, 1):
            for place in sides[side]:
                if place != class_lm.REST_PLACE:
                    around[word, side, table[place]] += 1
        rows.append((word, number, word % classes, *sides))
    words = spark.createDataFrame(rows, class_lm.CLASSED)
    beside = spark.createDataFrame(met, "a bigint, b bigint, times bigint, class_a bigint, class_b bigint, once_a boolean, once_b boolean")
    monkeypatch.setattr(class_lm, "pairs_with_classes", lambda pairs, words: pairs)
    swept = class_lm.sweep_rest(class_lm.Rest(words, beside), vocab, pairs)
    found = {row["word"]: row["class"] for row in swept.words.collect()}
    own = np.arange(300) % classes
    assert found == dict(enumerate(class_lm.best_classes(pairs, own, around[:, 0], around[:, 1]).tolist()))
