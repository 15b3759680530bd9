import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import common
from llm.common import connected, keys_of_several, window_hashes, word_hashes, words

TEXTS = st.lists(st.none() | st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0aAbBzZé", max_size=40), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.booleans(), st.sampled_from([4, 1 << 20]))
def test_word_hashes_tell_words_apart(texts, lower, chunk):
    kept, common._CHUNK = common._CHUNK, chunk
    try:
        hashes, bounds = word_hashes(pa.array(texts, pa.string()), lower)
    finally:
        common._CHUNK = kept
    seen = {}
    for text, begin, end in zip(texts, bounds, bounds[1:]):
        found = words(text, lower)
        assert len(found) == end - begin
        for word, value in zip(found, hashes[begin:end]):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 20))
def test_window_hashes_tell_windows_apart(values, width):
    hashed = np.array(values, np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(77)
    windows = [tuple(values[at : at + width]) for at in range(len(values) - width + 1)]
    found = window_hashes(hashed, width)
    assert len(found) == len(windows)
    assert len(set(found.tolist())) == len(set(windows))
    assert len(set(zip(windows, found.tolist()))) == len(set(windows))


def test_keys_of_several_owners_are_all_kept(spark):
    rows = [(key, owner) for key in range(40) for owner in range(1 + key % 3)] + [(99, owner) for owner in range(500)] + [(5, 0)] * 3
    frame = spark.createDataFrame(rows, "key long, owner long")
    found = [tuple(row) for row in keys_of_several(frame, "key", "owner").collect()]
    several = [row for row in rows if row[0] == 99 or row[0] % 3]
    assert set(several) <= set(found)
    assert len(found) - len(several) <= 4 * 2 * 4


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20), (5, 5)]
    found = {row["node"]: row["component"] for row in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
