"""Removal of repeated passages by difference-cover anchors.

A window is 50 consecutive words. A word goes when a window that covers it also
starts in a document with a smaller id. Windows are compared on the input.

Hashing every window of every document into one shuffle would move each word's
worth of text several times over, although few windows repeat. So windows are found
by anchors. A difference cover holds residues modulo ``PERIOD`` such that every
difference of two positions is a difference of two residues: two equal windows,
wherever they stand, have an offset below ``PERIOD`` at which both positions are
cover positions. Runs of ``ANCHOR`` words that begin there lie inside the window, so
equal windows share an anchor. Steps:

1. hash runs at cover positions only (6 of 31), shuffle them once, sorted, and keep
   the positions whose run several documents have;
2. extend: of the windows around those positions only, hash all 50 words, and find
   the smallest document of each hash;
3. give every document the hashes that a smaller one has, and remove the words.

Hashes have 64 bits. A passage that very many documents share is spread over range
partitions in step 1, is combined before the shuffle in step 2 and joined back by a
join whose large partitions Spark splits. Nothing is compared pair by pair.

Defined results: a null text has no words; a null id counts as larger than any
other; rows that repeat an id don't remove each other's words; documents of fewer
than 50 words stay whole; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import keys_of_several, small_batches, window_hashes, word_hashes, words

WINDOW = 50
# Every difference modulo 31 is the difference of exactly one pair of these.
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
ANCHOR = WINDOW - PERIOD + 1
LAST_ID = (1 << 63) - 1
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
KEPT = f"{RESULT}, kept_text string"


def cover_positions(count: int) -> np.ndarray:
    """The cover positions below ``count``."""
    periods = np.arange(0, count, PERIOD)
    places = (periods[:, None] + COVER[None, :]).ravel()
    return places[places < count]


def windows_around(places: np.ndarray, count: int) -> np.ndarray:
    """The starts, of ``count`` windows, whose window holds an anchor at one of the places."""
    change = np.zeros(count + 1, np.int64)
    places = places[places < count + PERIOD - 1]
    np.add.at(change, np.maximum(places - PERIOD + 1, 0), 1)
    np.add.at(change, np.minimum(places + 1, count), -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def covered(starts: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` words a window at one of the starts covers."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def longs(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, bounds = word_hashes(batch.column(1))
        keys, docs, places = [], [], []
        for doc, begin, end in zip(batch.column(0).to_pylist(), bounds, bounds[1:]):
            if end - begin < WINDOW:
                continue
            runs = window_hashes(hashes[begin:end], ANCHOR)
            at = cover_positions(len(runs))
            keys.append(runs[at].view(np.int64))
            docs.append(np.full(len(at), doc, np.int64))
            places.append(at)
        yield longs([joined(keys), joined(docs), joined(places)], ["anchor", "doc", "place"])


def window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, bounds = word_hashes(batch.column(1))
        keys, docs = [], []
        for doc, places, begin, end in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), bounds, bounds[1:]):
            if not places or end - begin < WINDOW:
                continue
            runs = window_hashes(hashes[begin:end], WINDOW)
            at = windows_around(np.unique(np.array(places, np.int64)), len(runs))
            keys.append(np.unique(runs[at]).view(np.int64))
            docs.append(np.full(len(keys[-1]), doc, np.int64))
        yield longs([joined(keys), joined(docs)], ["window", "doc"])


def kept_words(found: list[bytes], hashes: np.ndarray, repeated: list[int] | None) -> list[bytes]:
    """The words that no window with one of the repeated hashes covers."""
    if not repeated or len(found) < WINDOW:
        return found
    runs = window_hashes(hashes, WINDOW).view(np.int64)
    gone = covered(np.flatnonzero(np.isin(runs, np.array(repeated, np.int64))), len(found))
    return [word for word, go in zip(found, gone.tolist()) if not go]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: word counts, the checksum of the kept words and, if asked for, the kept text."""

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            hashes, bounds = word_hashes(batch.column(1))
            for (doc, text, repeated), begin, end in zip(zip(*(column.to_pylist() for column in batch.columns)), bounds, bounds[1:]):
                found = words(text)
                kept = kept_words(found, hashes[begin:end], repeated)
                raw = b" ".join(kept)
                rows.append((
                    None if doc == LAST_ID else doc, len(found), len(found) - len(kept), hashlib.sha256(raw).hexdigest(),
                    raw.decode() if with_text else None,
                ))
            ids, counts, gone, sums, texts = zip(*rows) if rows else [()] * 5
            arrays = [pa.array(column, pa.int64()) for column in (ids, counts, gone)] + [pa.array(sums, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    small_batches(docs.sparkSession)
    # Both joins take this frame as it is, so its shuffle is made once.
    chosen = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("doc"), F.col(text_col).cast("string").alias("text")
    )
    anchors = chosen.mapInArrow(anchor_batches, "anchor bigint, doc bigint, place bigint")
    shared = keys_of_several(anchors, "anchor", "doc")
    places = shared.groupBy("doc").agg(F.collect_list("place").alias("places"))
    windows = chosen.join(places, "doc", "left").select("doc", "text", "places")
    windows = windows.mapInArrow(window_batches, "window bigint, doc bigint")
    first = windows.groupBy("window").agg(F.min("doc").alias("first"))
    repeated = windows.join(first, "window").where("first < doc")
    repeated = repeated.groupBy("doc").agg(F.collect_set("window").alias("repeated"))
    rows = chosen.join(repeated, "doc", "left").select("doc", "text", "repeated")
    return rows.mapInArrow(removed, KEPT if with_text else RESULT)
