"""Periodic runs of words, found as maximal pairs, and texts with the repetition taken out.

A run is a stretch of consecutive words with smallest period q, at least
``max(MIN_WORDS, 2 * q)`` words long, that no neighbouring word extends. A run of
period q that starts at i is the maximal pair (i, i + q): the two suffixes agree on
``length - q`` words, the words before them differ and so do the words after. So all
runs come out of an enumeration of maximal pairs, without extending anything:

1. agreeing suffixes share ``length - q >= MIN_WORDS / 2`` words, so only positions whose
   next ``SEED`` words occur again in the document can take part; most documents have none;
2. those suffixes are sorted by prefix doubling, which also gives the longest common
   prefixes (LCP) of neighbours;
3. the LCP-interval tree is walked bottom-up. An interval keeps its suffixes in
   lists by the word to their left. Where two intervals meet at an LCP of l, a pair is
   maximal if its left words differ, and a run if its distance is at most l and distance
   plus l at least ``MIN_WORDS``. Every suffix of the smaller side looks only in lists of
   other left words and only as far as l, by bisection;
4. a run is also a pair at the multiples of its period, with the same stretch of words:
   the smallest distance of a stretch is its period.

Every document is worked on by itself, so rows stay where they are and nothing is shuffled.

Words are compared as they are, in UTF-8; hashes of words serve step 1 only. Defined
results: a null text has no words; a document with a null id is not rewritten; repeated rows
give repeated rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import small_batches, window_hashes, word_hashes

MIN_WORDS = 12
# A run of length n and period q <= n / 2 has suffixes that agree on n - q >= n / 2 words.
SEED = MIN_WORDS // 2
RESULT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def sources(doc_id: int | None, count: int) -> np.ndarray:
    """Which original word stands at each place: one document in ten is made periodic from some word on."""
    places = np.arange(count)
    mark = 1 if doc_id is None else zlib.crc32(b"%d" % doc_id)
    if count and mark % 10 == 0:
        share = mark // 10
        begin = share % count
        period = 1 + (count - begin) // (3 + share % 8)
        places[begin:] = begin + (places[begin:] - begin) % period
    return places


def repeated_seeds(hashes: np.ndarray) -> np.ndarray:
    """Which positions of one document start a run of ``SEED`` words that occurs there again."""
    grams = window_hashes(hashes, SEED)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    out = np.zeros(len(grams), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def numbered(found: list[bytes]) -> np.ndarray:
    """The words as numbers, equal for equal words."""
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(word, len(numbers)) for word in found], np.int64)


def sorted_suffixes(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at the places in order, by prefix doubling, and the LCP of every one with the one before it.

    Ranks of all positions are kept for every doubled length; the LCP is read off them
    from the longest to the shortest.
    """
    count = len(ids)
    ranks, span = [np.unique(ids, return_inverse=True)[1].astype(np.int64)], 1
    while span < count:
        ahead = np.full(count, -1, np.int64)
        ahead[:-span] = ranks[-1][span:]
        _, rank = np.unique(ranks[-1] * (count + 1) + ahead + 1, return_inverse=True)
        ranks.append(rank.astype(np.int64))
        span *= 2
        if len(np.unique(rank[places])) == len(places):
            break
    order = places[np.argsort(ranks[-1][places], kind="stable")]
    one, other, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(len(order) - 1, 0), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (one < count) & (other < count)
        same = np.zeros(len(common), bool)
        same[inside] = ranks[level][one[inside]] == ranks[level][other[inside]]
        # Equal ranks at a length that passes the end would mean equal positions, so these words do exist.
        step = same.astype(np.int64) << level
        common, one, other = common + step, one + step, other + step
    return order, np.r_[0, common]


class Interval:
    """Suffixes that share a prefix: their positions, all and by the word to their left."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int, left: int):
        self.places, self.by_left = [place], {left: [place]}


def merged(one: Interval, other: Interval, common: int, left: list[int], pairs: dict) -> Interval:
    """Both intervals as one, after the pairs between them: (first, stretch's length) -> least distance."""
    if len(one.places) < len(other.places):
        one, other = other, one
    for place in other.places:
        own = left[place]
        low, high = place - common, place + common
        begin, end = bisect_left(one.places, low), bisect_right(one.places, high)
        if end - begin <= len(one.by_left):
            near = [at for at in one.places[begin:end] if left[at] != own]
        else:
            near = [
                at for word, listed in one.by_left.items() if word != own
                for at in listed[bisect_left(listed, low) : bisect_right(listed, high)]
            ]
        for at in near:
            distance = abs(at - place)
            if distance + common >= MIN_WORDS:
                key = (min(at, place), distance + common)
                pairs[key] = min(distance, pairs.get(key, distance))
    for place in other.places:
        insort(one.places, place)
    for word, listed in other.by_left.items():
        have = one.by_left.get(word)
        if have is None:
            one.by_left[word] = listed
        else:
            for place in listed:
                insort(have, place)
    return one


def maximal_pairs(order: list[int], common: list[int], left: list[int], pairs: dict) -> None:
    """The pairs of one group of suffixes that share ``SEED`` words, over its LCP-interval tree from the leaves up.

    ``common[i]`` is the LCP of suffix i with the one before it.
    """
    stack: list[tuple[int, Interval]] = []  # (LCP with what is below, interval)
    for at, place in enumerate(order):
        depth = common[at] if at else 0
        while len(stack) > 1 and stack[-1][0] >= depth:
            close(stack, left, pairs)
        stack.append((depth, Interval(place, left[place])))
    while len(stack) > 1:
        close(stack, left, pairs)


def close(stack: list[tuple[int, Interval]], left: list[int], pairs: dict) -> None:
    """The topmost interval meets the one below it at their LCP."""
    level, top = stack.pop()
    depth, below = stack.pop()
    stack.append((depth, merged(below, top, level, left, pairs)))


def runs_of(found: list[bytes], hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start, then period."""
    if len(found) < MIN_WORDS:
        return []
    places = np.flatnonzero(repeated_seeds(hashes))
    if not len(places):
        return []
    ids = numbered(found)
    order, common = sorted_suffixes(ids, places)
    left = np.r_[-1, ids[:-1]]
    begins = np.flatnonzero(common < SEED)  # the first suffix of each group that shares the seed
    ends = np.r_[begins[1:], len(order)]
    # A group can hold a pair where its nearest suffixes are no further apart than the most words
    # that two of them share, and where the words to the left differ.
    group = np.repeat(np.arange(len(begins)), ends - begins)
    by_place = np.lexsort((order, group))
    gaps = np.append(np.diff(order[by_place]), len(found))
    gaps[ends - 1] = len(found)
    lefts = left[order]
    shared = np.maximum.reduceat(np.where(common >= SEED, common, 0), begins)
    promising = np.minimum.reduceat(gaps, begins) <= shared
    promising &= np.minimum.reduceat(lefts, begins) != np.maximum.reduceat(lefts, begins)
    pairs: dict[tuple[int, int], int] = {}
    words_left = left.tolist()
    for begin, end in zip(begins[promising].tolist(), ends[promising].tolist()):
        maximal_pairs(order[begin:end].tolist(), common[begin:end].tolist(), words_left, pairs)
    return sorted(((start, length, period) for (start, length), period in pairs.items()), key=lambda run: (run[0], run[2]))


def collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return found
    change = np.zeros(len(found) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [word for word, go in zip(found, (np.cumsum(change[:-1]) > 0).tolist()) if not go]


def digest(doc_id: int | None, found: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The result row of one document."""
    longest = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
    start, length, period = longest or (None, None, None)
    listed = b"".join(b"%d,%d,%d\n" % run for run in runs)
    return (
        doc_id, len(runs), start, length, period, 1000 * length // period if longest else None,
        hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(found, runs))).hexdigest(),
    )


def runs_by_document(batch: pa.RecordBatch, rewrite: bool) -> Iterator[tuple[int | None, list[bytes], list[tuple[int, int, int]]]]:
    """Id, words and runs of every document of a batch of ids and texts."""
    hashes, bounds = word_hashes(batch.column(1))
    for doc_id, text, begin, end in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bounds, bounds[1:]):
        found, own = (text or "").encode().split(), hashes[begin:end]
        if rewrite:
            places = sources(doc_id, len(found))
            if len(found) and places[-1] != len(found) - 1:
                found, own = [found[place] for place in places.tolist()], own[places]
        yield doc_id, found, runs_of(found, own)


def chosen(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False) -> DataFrame:
    """One row per run: doc_id, start (word number), length and period; documents without runs have none."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, *run) for doc_id, _, runs in runs_by_document(batch, rewrite) for run in runs]
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=["doc_id", "start", "length", "period"])

    return chosen(docs, id_col, text_col).mapInArrow(found, "doc_id bigint, start bigint, length bigint, period bigint")


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number of words dropped, and the text with one period left of every run, words joined by one space."""

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, words, collapsed(words, runs)) for doc_id, words, runs in runs_by_document(batch, False)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row[0] for row in rows], pa.int64()),
                    pa.array([len(row[1]) - len(row[2]) for row in rows], pa.int64()),
                    pa.array([b" ".join(row[2]).decode() for row in rows], pa.string()),
                ],
                names=["doc_id", "n_dropped", "text"],
            )

    return chosen(docs, id_col, text_col).mapInArrow(shortened, "doc_id bigint, n_dropped bigint, text string")


def summarize_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = True) -> DataFrame:
    """One row per document: the number of its runs, the longest one, checksums of all runs and of the kept words.

    With ``rewrite`` one document in ten, told by its id, is made periodic before.
    """
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = [field.split()[0] for field in RESULT.split(", ")]

    def summarized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [digest(*document) for document in runs_by_document(batch, rewrite)]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)

    return chosen(docs, id_col, text_col).mapInArrow(summarized, RESULT)
