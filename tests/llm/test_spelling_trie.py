import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import spelling_trie
from llm.spelling_trie import count_words, group_counts, near_words, one_apart, reached, spelling_forms

from .helpers import docs_frame, edge_rows


def plain_counts(rows):
    total = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if mark % 97 == 0:
                word = word[: mark % len(word)] + word[mark % len(word) + 1 :]
            total[word] += 1
    return {word: n for word, n in total.items() if len(word) >= 5 and n >= 3}


def edits(word, alphabet):
    out = {word[:at] + word[at + 1 :] for at in range(len(word))}
    for letter in alphabet:
        out |= {word[:at] + letter + word[at:] for at in range(len(word) + 1)}
        out |= {word[:at] + letter + word[at + 1 :] for at in range(len(word))}
    return out - {word}


def plain_forms(counts):
    alphabet = set("".join(counts))
    near = {word: [other for other in edits(word, alphabet) if other in counts] for word in counts}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * n else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return sorted((word, form[word], root(word), n, len(near[word]), counts.get(form[word])) for word, n in counts.items())


def sorted_rows(frame):
    return sorted(tuple(row[name] for name in ("word", "form", "root", "n", "n_near", "form_n")) for row in frame.collect())


def vocabulary(seed, size, letters="abcdeén"):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))): rng.randrange(3, 400) for _ in range(size)}


@pytest.mark.parametrize("block", [8_192, 40, 3])
def test_forms_against_all_edits(spark, monkeypatch, block):
    """Also with a trie cut into many cells, and leaves that fill several of them."""
    monkeypatch.setattr(spelling_trie, "BLOCK", block)
    counts = vocabulary(1, 1500) | {"abcde" + "x" * 200: 9, "abcd" + "x" * 200: 4, "abcdf" + "x" * 200: 30, "é" * 70: 3, "é" * 71: 8}
    counts |= {"".join(order): 5 for order in (random.Random(at).sample("anagram", 7) for at in range(60))}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted_rows(spelling_forms(frame)) == plain_forms(counts)


def test_few_visitors_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(spelling_trie, "VISITORS", 7)
    monkeypatch.setattr(spelling_trie, "COMPARED", 16)
    monkeypatch.setattr(spelling_trie, "BLOCK", 25)
    counts = vocabulary(2, 500)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [(row["word"], row["near"]) for row in near_words(frame).collect()]
    alphabet = set("".join(counts))
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(word, other) for word in counts for other in edits(word, alphabet) if other in counts}


def test_long_chains(spark):
    counts = {"a" * size: 3 * 2 ** (size - 5) for size in range(5, 30)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted_rows(spelling_forms(frame)) == plain_forms(counts)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_one_apart(one, other):
    assert one_apart(one, other) == (other in edits(one, "abc"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcdefgh", min_size=1, max_size=12), min_size=1, max_size=60))
def test_search_reaches_all_within_the_budget(words):
    vectors = np.unique(group_counts(words), axis=0)
    vectors = vectors[np.lexsort(vectors.T[::-1])]
    queries = group_counts(words)
    found = {(int(q), int(v)) for query, leaf in reached(vectors, queries) for q, v in zip(query, leaf)}
    change = vectors[None] - queries[:, None]
    expected = np.argwhere((np.maximum(change, 0).sum(2) <= 1) & (np.maximum(-change, 0).sum(2) <= 1))
    assert found == {(int(q), int(v)) for q, v in expected}


def test_words_of_texts(spark):
    rng = random.Random(5)
    names = ["Straße", "ÉCOLE", "école", "Ñandúes", "letters", "LETTERS", "lettrs", "a×b÷cde", "naïveté", "word"]
    rows = [(at, " ".join(rng.choice(names) + rng.choice([".", "7", "-", " "]) for _ in range(60))) for at in range(80)]
    rows += edge_rows()
    counts = {row["word"]: row["n"] for row in count_words(docs_frame(spark, rows)).collect()}
    assert counts == plain_counts(rows)
    assert any(word not in {name.lower() for name in names} for word in counts)


def test_edges(spark):
    assert count_words(docs_frame(spark, [])).collect() == []
    assert spelling_forms(count_words(docs_frame(spark, [(1, None), (2, "")]))).collect() == []
    rows = [(at, "single singles " * 3) for at in range(9)]
    found = sorted_rows(spelling_forms(count_words(docs_frame(spark, rows))))
    assert found == plain_forms(plain_counts(rows))
