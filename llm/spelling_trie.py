"""Spelling variants: words one letter apart, found in a trie of letter-group counts.

Letters fall into ``GROUPS`` groups, and a word's counts per group, one after the other,
are its path in a trie. One inserted, deleted or replaced letter raises at most one count
and lowers at most one, each by one. A depth-first search for a word's neighbours
therefore carries a budget of one surplus and one deficit and leaves a branch when either
is spent twice; the words of the leaves it reaches are compared letter by letter.

The trie of a large vocabulary fits no task, so it is cut where a branch holds at most
``BLOCK`` words. The part above the cuts (one node for some thousands of words) goes to
every task and is searched in the same way, which tells the branches a word
has to visit. Each branch is one cell of a shuffle: its own words come first and make up the
trie, then the visiting ones are searched in blocks. Of two branches only the
later one is visited by the words of the other, so a pair is met once. A leaf with more than
``BLOCK`` words, all of the same counts, is dealt over several cells.

Defined results: a null text has no words; a null id counts as no text before the colon;
repeated rows count again; an empty table gives an empty result; words are told apart by code
points, and other columns are not read. Counts above 127 count as 127, which only lets
more words through to the comparison.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import partitions, small_batches, stage

GROUPS = 16
# A letter's group is its code point modulo GROUPS; the levels of the trie, groups with frequent letters first.
LEVELS = [5, 4, 3, 14, 1, 15, 9, 2, 12, 8, 13, 0, 7, 6, 11, 10]
BLOCK = 8_192
VISITORS = 32_768
COMPARED = 1 << 16
LEAF = 8
LONG = 64
TYPO_ONE_IN = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
KEPT_WORDS = 200_000

# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z became a-z.
PLAIN_RUN = re.compile(rb"[a-z]+")
ANY_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")


def without_letter(word: bytes, place: int) -> bytes:
    text = word.decode()
    return (text[:place] + text[place + 1 :]).encode()


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of one document after the planted slips, with their number."""
    if not text:
        return Counter()
    raw = text.encode().lower()
    counts = Counter((PLAIN_RUN if text.isascii() else ANY_RUN).findall(raw))
    begin = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    slips = [(word, mark) for word in counts if not (mark := zlib.crc32(word, begin)) % TYPO_ONE_IN]
    for word, mark, count in [(word, mark, counts.pop(word)) for word, mark in slips]:
        counts[without_letter(word, mark % len(word.decode()))] += count
    return counts


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of at least five letters and three occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, count in words_of(doc_id, text).items():
                    if len(word) >= LEAST_LETTERS:
                        total[word] = total.get(word, 0) + count
            if len(total) >= KEPT_WORDS:
                yield rows()
                total.clear()
        yield rows()

    small_batches(docs.sparkSession)
    found = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = found.mapInArrow(counted, "word string, n bigint").where(F.length("word") >= LEAST_LETTERS)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, one after the other, and where each begins and the last ends."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.r_[0, np.cumsum([len(word) for word in words], dtype=np.int64)]


def group_counts(words: list[str]) -> np.ndarray:
    """A row per word: its letters per group, by level."""
    codes, bounds = letters(words)
    owner = np.repeat(np.arange(len(words)), np.diff(bounds))
    counts = np.bincount(owner * GROUPS + (codes % GROUPS), minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
    return np.minimum(counts, 127).astype(np.int8)[:, LEVELS]


def within_budget(change: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    surplus, deficit = surplus + np.maximum(change, 0), deficit + np.maximum(-change, 0)
    return (surplus <= 1) & (deficit <= 1), surplus, deficit


def reached(vectors: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, vector) pairs with at most one surplus and one deficit, by depth-first search.

    The vectors are distinct and sorted, so a node of their trie is a range of rows and
    a level. A node is visited once, with all queries that still have a budget there.
    """
    none = np.zeros(len(queries), np.int8)
    stack = [(0, len(vectors), 0, np.arange(len(queries)), none, none)]
    while stack:
        low, high, level, alive, surplus, deficit = stack.pop()
        if not len(alive) or low == high:
            continue
        if high - low <= LEAF or level == GROUPS:
            for at in range(0, len(alive), COMPARED // LEAF):
                part = slice(at, at + COMPARED // LEAF)
                change = vectors[low:high, None, level:] - queries[None, alive[part], level:]
                over = np.maximum(change, 0).sum(2, dtype=np.int16)
                under = over - change.sum(2, dtype=np.int16)
                vector, query = np.nonzero((over + surplus[part] <= 1) & (under + deficit[part] <= 1))
                yield alive[part][query], vector + low
            continue
        column, asked = vectors[low:high, level], queries[alive, level]
        starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), high - low]):
            keep, more, less = within_budget(column[begin] - asked, surplus, deficit)
            stack.append((low + begin, low + end, level + 1, alive[keep], more[keep], less[keep]))


class Words:
    """Words with their counts, and their letters in two matrices, set left and set right."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts = words, counts
        codes, bounds = letters(words)
        self.lengths = np.diff(bounds)
        width = int(min(self.lengths.max(initial=0), LONG))
        at = bounds[:-1, None] + np.arange(width)
        inside = np.arange(width) < self.lengths[:, None]
        padded = np.append(codes, 0)
        self.from_left = np.where(inside, padded[np.minimum(at, len(codes))], 0)
        back = bounds[1:, None] - 1 - np.arange(width)
        self.from_right = np.where(inside, padded[np.maximum(back, 0)], 0)


def shared_letters(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many letters two words have in common from one side on, row by row."""
    width = min(one.shape[1], other.shape[1])
    differs = one[:, :width] != other[:, :width]
    return np.where(differs.any(1), differs.argmax(1), width)


def one_apart(one: str, other: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if one == other or abs(len(one) - len(other)) > 1:
        return False
    least = min(len(one), len(other))
    head = next((at for at in range(least) if one[at] != other[at]), least)
    tail = next((at for at in range(least) if one[-1 - at] != other[-1 - at]), least)
    return head + tail >= max(len(one), len(other)) - 1


def verified(one: Words, other: Words, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Which pairs of words are exactly one letter apart."""
    left, right = one.lengths[at], other.lengths[to]
    fits = np.flatnonzero(np.abs(left - right) <= 1)
    at, to, left, right = at[fits], to[fits], left[fits], right[fits]
    longer, shorter = np.maximum(left, right), np.minimum(left, right)
    head = np.minimum(shared_letters(one.from_left[at], other.from_left[to]), shorter)
    tail = np.minimum(shared_letters(one.from_right[at], other.from_right[to]), shorter)
    good = (head + tail >= longer - 1) & ((left != right) | (head < left))
    for place in np.flatnonzero(longer > LONG):
        good[place] = one_apart(one.words[at[place]], other.words[to[place]])
    return fits[good]


class Branch:
    """A branch of the trie with the words at its leaves."""

    def __init__(self, words: list[str], counts: np.ndarray):
        vectors = group_counts(words)
        order = np.lexsort(vectors.T[::-1])
        vectors = vectors[order]
        starts = np.flatnonzero(np.r_[True, (vectors[1:] != vectors[:-1]).any(1)]) if len(words) else np.empty(0, np.int64)
        self.vectors, self.starts, self.sizes = vectors[starts], starts, np.diff(np.r_[starts, len(words)])
        self.held = Words([words[place] for place in order.tolist()], counts[order])

    def near(self, visiting: Words, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(visiting, held) pairs that are one letter apart; of words of this branch each pair once."""
        for query, leaf in reached(self.vectors, group_counts(visiting.words)):
            sizes = self.sizes[leaf]
            ends = np.cumsum(sizes)
            at = 0
            while at < len(sizes):  # leaves with many words at a time
                base = ends[at] - sizes[at]
                stop = max(at + 1, int(np.searchsorted(ends, base + COMPARED, "right")))
                many = sizes[at:stop]
                inner = np.arange(ends[stop - 1] - base) - np.repeat(ends[at:stop] - many - base, many)
                held, asked = np.repeat(self.starts[leaf[at:stop]], many) + inner, np.repeat(query[at:stop], many)
                if own:
                    held, asked = held[held < asked], asked[held < asked]
                good = verified(visiting, self.held, asked, held)
                if len(good):
                    yield asked[good], held[good]
                at = stop


LINKS = "word string, n bigint, near string, near_n bigint"


def link_rows(one: Words, other: Words, at: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
    """Both directions of the pairs."""
    names, nears = [one.words[place] for place in at.tolist()], [other.words[place] for place in to.tolist()]
    n, near_n = one.counts[at], other.counts[to]
    return pa.RecordBatch.from_arrays(
        [pa.array(names + nears, pa.string()), pa.array(np.r_[n, near_n]), pa.array(nears + names, pa.string()), pa.array(np.r_[near_n, n])],
        names=["word", "n", "near", "near_n"],
    )


def linked_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of cells: rows (cell, visits, word, n) sorted by cell and visits."""
    cell, branch, words, counts = None, None, [], []

    def searched() -> Iterator[pa.RecordBatch]:
        if branch is None:  # a leaf dealt over several cells may have left one without words of its own
            return
        visiting = Words(words, np.array(counts, np.int64))
        for at, to in branch.near(visiting, False):
            yield link_rows(visiting, branch.held, at, to)

    def grown() -> tuple[Branch, list[pa.RecordBatch]]:
        made = Branch(words, np.array(counts, np.int64))
        return made, [link_rows(made.held, made.held, at, to) for at, to in made.near(made.held, True)]

    for batch in batches:
        keys, visits = (batch.column(place).to_numpy(zero_copy_only=False) for place in (0, 1))
        names, ns = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        parts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (visits[1:] != visits[:-1])]) if len(keys) else []
        for begin, end in zip(parts, [*parts[1:], len(keys)]):
            part = (keys[begin], visits[begin])
            if part != cell:
                if cell is not None and cell[1] == 0:
                    branch, links = grown()
                    yield from links
                elif words:
                    yield from searched()
                if cell is not None and cell[0] != part[0]:
                    branch = None
                cell, words, counts = part, [], []
            words += names[begin:end]
            counts += ns[begin:end]
            if part[1] and len(words) >= VISITORS:
                yield from searched()
                words, counts = [], []
    if words and cell[1] == 0:
        yield from grown()[1]
    elif words:
        yield from searched()


def cut_trie(vectors: DataFrame) -> list[tuple[bytes, int]]:
    """Where the trie is cut: (path of counts, number of cells), in order of the paths.

    The branches with more than ``BLOCK`` words, which are not cut there, come to the
    driver: at most ``GROUPS`` for so many words.
    """
    paths = vectors.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(GROUPS)), lambda level: F.substring("vector", F.lit(1), level))).alias("path"), "n")
    sizes = stage(paths.groupBy("path").agg(F.sum("n").alias("n")), "trie-sizes")
    large = sizes.where((F.col("n") > BLOCK) & (F.length("path") < GROUPS)).select(F.col("path").alias("above"))
    cuts = sizes.withColumn("above", F.expr("substring(path, 1, length(path) - 1)"))
    cuts = cuts.where((F.col("n") <= BLOCK) | (F.length("path") == GROUPS)).where(F.length("path") > 0)
    cuts = cuts.join(large, "above", "left_semi").select("path", F.ceil(F.col("n") / BLOCK).alias("cells"))
    found = sorted((bytes(row["path"]), row["cells"]) for row in cuts.collect())
    return found or [(b"", 1)]


def cells_of(words: list[str], cuts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, cell, visits): the cell a word lives in and the later ones it has to visit.

    A search of the trie above the cuts, level by level, with all words at a node at once.
    """
    vectors = group_counts(words)
    places = np.array([zlib.crc32(word.encode()) for word in words], np.int64)
    shares = np.array([cells for _, cells in cuts], np.int64)
    first = np.r_[0, np.cumsum(shares)[:-1]]
    own = np.zeros(len(words), np.int64)
    out = []
    zero = np.zeros(len(words), np.int8)
    stack = [(0, len(cuts), 0, np.arange(len(words)), zero, zero)]
    while stack:
        low, high, level, alive, surplus, deficit = stack.pop()
        if not len(alive):
            continue
        if high - low == 1 and len(cuts[low][0]) == level:
            home = (surplus == 0) & (deficit == 0)
            own[alive[home]] = first[low] + places[alive[home]] % shares[low]
            out += [(alive, np.full(len(alive), first[low] + share)) for share in range(shares[low])]
            continue
        counts = np.array([path[level] for path, _ in cuts[low:high]], np.int8)
        starts = np.flatnonzero(np.r_[True, counts[1:] != counts[:-1]])
        asked = vectors[alive, level]
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), high - low]):
            keep, more, less = within_budget(counts[begin] - asked, surplus, deficit)
            stack.append((low + begin, low + end, level + 1, alive[keep], more[keep], less[keep]))
    word = np.concatenate([part for part, _ in out]) if out else np.empty(0, np.int64)
    cell = np.concatenate([part for _, part in out]) if out else np.empty(0, np.int64)
    later = cell >= own[word]
    word, cell = word[later], cell[later]
    return word, cell, (cell != own[word]).astype(np.int8)


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words exactly one letter apart, in both directions."""
    spark = counts.sparkSession

    def as_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = group_counts(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in rows], pa.binary())], names=["vector"])

    vectors = counts.select("word").mapInArrow(as_vectors, "vector binary").groupBy("vector").agg(F.count(F.lit(1)).alias("n"))
    cuts = cut_trie(vectors)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, cell, visits = cells_of(batch.column(0).to_pylist(), cuts)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(visits), batch.column(0).take(word), batch.column(1).take(word)], names=["cell", "visits", "word", "n"])

    cells = counts.select("word", "n").mapInArrow(dealt, "cell bigint, visits tinyint, word string, n bigint")
    cells = cells.repartition(partitions(spark), "cell").sortWithinPartitions("cell", "visits")
    return cells.mapInArrow(linked_in_cells, LINKS)


def spelling_forms(counts: DataFrame) -> DataFrame:
    """One row per word of ``word`` and ``n``: its form, the last of its forms, and the number of its near words.

    A word's form is its most frequent near word (of equal ones the least) if that is
    at least twice as frequent; so forms have no cycles, and a chain of them is no longer than the
    logarithm of the largest count. Roots are found by pointer jumping.
    """
    counts = stage(counts.select("word", "n"), "words")
    links = near_words(counts)
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    near = counts.join(best, "word", "left")
    twice = -F.col("best.less") >= 2 * F.col("n")
    formed = stage(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(twice, F.col("best.near")).alias("form"), F.when(twice, -F.col("best.less")).alias("form_n"),
    ), "forms")
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stage(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            break
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
