"""Scoring by a class-based n-gram model (Brown) trained on the corpus.

P(word | previous word) = P(class | previous class) * P(word | class), with the end
of a text as a word before and after it. Words are lower-cased; a word is told by a
64-bit hash. Steps, each a pass over the texts with counts combined before shuffles:

1. counts of all words of the training texts, a table of any size;
2. the most frequent words (at most ``FREQUENT``; a count threshold decides) go to
   all tasks, and a staged table holds every text's words as places among them, so
   that later passes read numbers. The ``CORE`` most frequent words are clustered; all
   others belong to a class per band of frequency. Words beyond the frequent ones stay
   in a staged table by hash, with class and neighbours, and meet by joins;
3. counts of neighbouring symbols over all training texts: core words, band classes
   and the end. They are at most (CORE + 70)^2, whatever the input;
4. exchange clustering of the core words on these counts: each word in turn moves to
   the class that raises the likelihood most, until no word moves;
5. exchange of all other words, ``WORD_SWEEPS`` times: Spark counts the classes
   before and after each of them over all training texts, groups of words are dealt to
   tasks, and every word moves from its band to the class that raises the likelihood
   most, judged by the class counts of the sweep's start; these are then counted anew;
6. scoring: frequent words within the tasks; the others join their counts and classes
   by hash, so no table that grows with the corpus is broadcast.

A ``vocabulary`` asked for a number of frequent words classes these alone; all others
share the rare class. Otherwise that class has the unknown words only, and takes its
transitions from the words seen once, as each of them was unknown when it came.

Smoothing: transitions are backed off to class frequencies, ``BACKOFF`` pseudo
counts; emissions add ``ADDED`` to every count, and the rare class keeps room for
one unknown word. Probabilities of all words sum to 1.

Defined results: a null text is an empty one and has the end only; a null id belongs
to training; repeated rows count and are scored each; with no training texts every
word is unknown; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.sources.scratch import discard
from llm.common import partitions, small_batches, stage, text_bytes, word_hashes

ADDED = 0.1
BACKOFF = 50.0
FREQUENT = 1 << 17
CORE = 1024
CLASSES = 64
SWEEPS = 12
WORD_SWEEPS = 2
SHARES = 64  # groups of words that a sweep deals to tasks, at least
CHOSEN = 512  # words that choose their classes together
COMBINED = 1 << 21  # codes that a task counts together
EMITTED = 1 << 16
END = 0  # the hash that stands for the end; a word of this hash would count as one

COUNTS = "word bigint, count bigint"
DEALT = "share int, codes binary, times binary"
SCANNED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_frequent bigint, n_rest bigint, "
    "base double, rest array<struct<word:bigint,before:int,after:int>>, pairs array<struct<a:bigint,b:bigint>>, places binary"
)
CLASSED = "word bigint, count bigint, class bigint, before array<int>, after array<int>"
ADDENDS = "row bigint, rest_log double, rest_known bigint, rest_model double"
FEW = 16  # numbers up to this have their gains tabulated
SCORED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_frequent bigint, n_rest bigint, base double, model double"
# Places of what is no frequent word, counted from the end of a table of all words.
END_PLACE, REST_PLACE = -2, -1
BAND = "length(bin(count)) - 1"  # the whole part of the binary logarithm


def chosen(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, held_out: a tenth of the ids by checksum."""
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("bigint").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out")
    )


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words, each text's followed by the end, and where each text begins."""
    hashes, bounds = word_hashes(texts, lower=True)
    found = np.insert(hashes.view(np.int64), bounds[1:], END)
    return found, bounds[:-1] + np.arange(len(texts))


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, times = np.unique(tokens(batch.column(0))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(times, pa.int64())], names=["word", "count"])


def word_counts(train: DataFrame) -> DataFrame:
    """(word, count) over all training texts, staged."""
    counted = train.select("text").mapInArrow(count_batches, COUNTS)
    return stage(counted.groupBy("word").agg(F.sum("count").alias("count")), "word-counts")


@dataclass
class Vocabulary:
    """Sorted hashes of the frequent words, their counts and symbols, and totals of all words.

    Symbols: core words first, then the bands, then the rare class, then the end.
    Words with counts below ``least`` are not among them; ``bands`` has the symbols
    of bands of frequency, and with ``capped`` these words are of the rare class.
    """

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    n_symbols: int
    n_core: int
    n_tokens: int
    n_words: int
    least: int
    bands: dict[int, int]
    capped: bool

    @property
    def rare(self) -> int:
        return self.n_symbols - 2

    @property
    def end(self) -> int:
        return self.n_symbols - 1

    @property
    def base_denominator(self) -> float:
        return self.n_tokens + ADDED * (self.n_words + 1)

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the frequent words, and whether they are there."""
        if not len(self.words):
            return np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        at = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
        return at, self.words[at] == found


def vocabulary(counts: DataFrame, frequent: int | None = None, core: int = CORE) -> Vocabulary:
    """The frequent words: all at or above the least of a row of thresholds that at most ``FREQUENT`` words reach.

    With ``frequent`` given, so many are reached at most and no other words get classes.
    """
    capped, frequent = frequent is not None, FREQUENT if frequent is None else frequent
    steps = [int(2 ** (step / 4)) for step in range(4, 160)]
    totals = counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("tokens"), F.count("*").alias("words"),
        *(F.count_if(F.col("count") >= step).alias(f"from_{place}") for place, step in enumerate([0, *steps])),
    ).first()
    least = next(step for place, step in enumerate([0, *steps, 1 << 62]) if step == 1 << 62 or totals[f"from_{place}"] <= frequent)
    rows = counts.where((F.col("count") >= least) & (F.col("word") != END)).toPandas()
    rows = rows.sort_values(["count", "word"], ascending=[False, True])
    times = rows["count"].to_numpy(np.int64)
    n_core = min(core, len(rows))
    bands = np.floor(np.log2(np.maximum(times[n_core:], 1))).astype(np.int64)
    below = [] if capped else [row[0] for row in counts.where((F.col("count") < least) & (F.col("word") != END)).select(F.expr(BAND)).distinct().collect()]
    names = np.unique(np.r_[bands, np.array(below, np.int64)])
    symbols = np.concatenate([np.arange(n_core), n_core + np.searchsorted(names, bands)])
    order = np.argsort(rows["word"].to_numpy(np.int64), kind="stable")
    return Vocabulary(
        rows["word"].to_numpy(np.int64)[order], times[order], symbols[order], n_core + len(names) + 2, n_core,
        totals["tokens"], totals["words"], least, {int(name): n_core + place for place, name in enumerate(names)}, capped,
    )


def scan_texts(texts: pa.Array, vocab: Vocabulary) -> list[pa.Array]:
    """Per text: tokens, frequent words and others, the unigram sum over frequent words, the others with the places around them, neighbouring others, and all places."""
    found, begins = tokens(texts)
    at, known = vocab.look_up(found)
    ends = found == END
    known &= ~ends
    base = np.zeros(len(found))
    base[known] = np.log10((vocab.counts[at[known]] + ADDED) / vocab.base_denominator)
    per_text = lambda values: np.add.reduceat(values, begins) if len(begins) else np.empty(0)
    places = np.where(known, at, np.where(ends, END_PLACE, REST_PLACE)).astype("<i4")
    rest = np.flatnonzero(places == REST_PLACE)
    # Every text ends with the end, which also stands before the next one.
    around = np.r_[np.int32(END_PLACE), places]
    both = rest[around[rest] == REST_PLACE]  # others that follow one
    items = pa.StructArray.from_arrays(
        [pa.array(found[rest], pa.int64()), pa.array(around[rest], pa.int32()), pa.array(around[rest + 2], pa.int32())], ["word", "before", "after"]
    )
    pairs = pa.StructArray.from_arrays([pa.array(found[both - 1], pa.int64()), pa.array(found[both], pa.int64())], ["a", "b"])
    cuts = np.r_[begins, len(found)]
    lists, pairs = (pa.ListArray.from_arrays(pa.array(np.searchsorted(of, cuts), pa.int32()), rows) for of, rows in ((rest, items), (both, pairs)))
    edges = (np.r_[begins, len(found)] * 4).astype(np.int32)
    raw = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(places.tobytes())])
    counts = [per_text(values.astype(np.int64)) for values in (np.ones(len(found)), known, ~known & ~ends)]
    return [*(pa.array(values, pa.int64()) for values in counts), pa.array(per_text(base), pa.float64()), lists, pairs, raw]


def placed(texts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Every text as places among the frequent words, and what its unigram score needs; staged."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = pa.array(np.arange(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), batch.column(2), *scan_texts(batch.column(1), vocab)], names=names)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_frequent", "n_rest", "base", "rest", "pairs", "places"]
    return stage(texts.mapInArrow(scanned, SCANNED), "placed")


def places_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of a column of texts, one after the other, and where each text begins."""
    raw, edges = text_bytes(column)
    return raw.view("<i4"), edges[:-1] // 4


def symbol_table(vocab: Vocabulary) -> np.ndarray:
    """The symbol of every place."""
    return np.r_[vocab.symbols, vocab.end, vocab.rare]


def count_rows(code: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(code), EMITTED):
        part = slice(at, at + EMITTED)
        yield pa.RecordBatch.from_arrays([pa.array(code[part], pa.int64()), pa.array(times[part], pa.int64())], names=["word", "count"])


def dealt_rows(shares: int, width: int):
    """Codes of (word, one of ``width`` things beside it) with their numbers: one row per share of the words, with the codes as places in the share's table."""

    def dealt(code: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        word, beside = np.divmod(code, width)
        share = word % shares
        order = np.argsort(share, kind="stable")
        bounds = np.searchsorted(share[order], np.arange(shares + 1))
        met = np.flatnonzero(np.diff(bounds))
        edges = pa.py_buffer((np.r_[bounds[met], len(code)] * 4).astype(np.int32).tobytes())
        columns = [word // shares * width + beside, times]
        raw = [pa.Array.from_buffers(pa.binary(), len(met), [None, edges, pa.py_buffer(column[order].astype("<i4").tobytes())]) for column in columns]
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), *raw], names=["share", "codes", "times"])

    return dealt


@dataclass
class Rest:
    """Words beyond the frequent ones with count, class and the places around them, and pairs of such words with their classes."""

    words: DataFrame
    pairs: DataFrame

    def relabelled(self, numbers: np.ndarray) -> Rest:
        """With the number at each class as its new class."""
        place = F.array(*(F.lit(int(at)) for at in numbers))
        label = lambda column: F.element_at(place, (F.col(column) + 1).cast("int")).cast("bigint")
        pairs = self.pairs.withColumns({column: label(column) for column in ("class_a", "class_b")})
        return Rest(self.words.withColumn("class", label("class")), pairs)

    def discard(self) -> None:
        """Delete both tables."""
        discard(self.words)
        discard(self.pairs)

    def classes(self) -> list[int]:
        return [row[0] for row in self.words.select("class").distinct().collect()]


def pairs_with_classes(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b, times, class_a, class_b, once_a, once_b), staged; the last two say which words occur once."""
    of = words.select("word", "class", F.col("count") == 1)  # a row per word, so its hash tables have no hot key
    named = pairs.select("a", "b", "times").join(of.toDF("a", "class_a", "once_a").hint("shuffle_hash"), "a").join(of.toDF("b", "class_b", "once_b").hint("shuffle_hash"), "b")
    return stage(named.select("a", "b", "times", "class_a", "class_b", "once_a", "once_b"), "rest-pairs")


def rest_of(training: DataFrame, counts: DataFrame, vocab: Vocabulary) -> Rest | None:
    """The words beyond the frequent ones, each in its band; nothing where all are frequent or these alone get classes."""
    below = counts.where((F.col("count") < vocab.least) & (F.col("word") != END))
    if vocab.capped or below.isEmpty():
        return None
    band = F.element_at(F.create_map(*(F.lit(value) for pair in vocab.bands.items() for value in pair)), F.expr(BAND)).cast("bigint")
    found = training.select(F.inline("rest")).groupBy("word").agg(F.collect_list("before").alias("before"), F.collect_list("after").alias("after"))
    words = stage(below.join(found, "word").select("word", "count", band.alias("class"), "before", "after"), "rest-words")
    pairs = training.select(F.inline("pairs")).groupBy("a", "b").agg(F.count("*").alias("times"))
    return Rest(words, pairs_with_classes(pairs, words))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the row of each."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.repeat(np.arange(len(column)), lengths)


def rest_codes(vocab: Vocabulary, code, rows=count_rows):
    """Numbers of the codes that ``code(class, place, symbol, after)`` gives the places around the words beyond the frequent ones, as ``rows`` puts them."""
    table = symbol_table(vocab)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for after in (False, True):
                places, row = flat(batch.column(1 + after))
                places = places.to_numpy(zero_copy_only=False)
                known = places != REST_PLACE
                held.append(code(own[row[known]], places[known], table[places[known]], after))
                number += len(held[-1])
            if number >= COMBINED:
                yield from rows(*np.unique(np.concatenate(held), return_counts=True))
                held, number = [], 0
        if held:
            yield from rows(*np.unique(np.concatenate(held), return_counts=True))

    return counted


def all_neighbour_counts(training: DataFrame, vocab: Vocabulary, rest: Rest | None) -> np.ndarray:
    """How often each symbol follows each, the classes of all words included."""
    matrix, size = neighbour_counts(training, vocab), vocab.n_symbols
    if rest is None:
        return matrix
    matrix[vocab.rare], matrix[:, vocab.rare] = 0, 0  # their words have other classes
    code = lambda own, places, symbols, after: own * size + symbols if after else symbols * size + own
    beside = rest.words.select("class", "before", "after").mapInArrow(rest_codes(vocab, code), COUNTS)
    both = rest.pairs.select((F.col("class_a") * size + F.col("class_b")).alias("word"), F.col("times").alias("count"))
    rows = beside.unionByName(both).groupBy("word").agg(F.sum("count").alias("count")).toPandas()
    matrix.reshape(-1)[rows["word"].to_numpy(np.int64)] += rows["count"].to_numpy(float)
    return matrix


def neighbour_counts(training: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """How often each symbol follows each, over all training texts; words beyond the frequent ones count as rare."""
    size, table = vocab.n_symbols, symbol_table(vocab)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            # Every text ends with the end, which also stands before the next one.
            flat = np.r_[vocab.end, table[places_of(batch.column(0))[0]]]
            total += np.bincount(flat[:-1] * size + flat[1:], minlength=size * size)
        codes = np.flatnonzero(total)
        yield from count_rows(codes, total[codes])

    rows = training.select("places").mapInArrow(counted, COUNTS).groupBy("word").agg(F.sum("count").alias("count")).toPandas()
    matrix = np.zeros(size * size)
    matrix[rows["word"].to_numpy(np.int64)] = rows["count"].to_numpy(float)
    return matrix.reshape(size, size)


def unseen_counts(training: DataFrame, vocab: Vocabulary, rest: Rest | None) -> np.ndarray:
    """Counts of the rare class, whose unknown words training never meets: those of the words seen once.

    Each was unknown when it came, so what stands before and after it, and how often, is
    what to expect of an unknown word.
    """
    size, rare = vocab.n_symbols, vocab.rare
    table, once = symbol_table(vocab), np.zeros(0, bool)
    total = np.zeros(size * size)
    if (vocab.counts == 1).any():
        once = np.r_[vocab.counts == 1, np.zeros(len(table) - len(vocab.counts), bool)]

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(size * size, np.int64)
            for batch in batches:
                places = places_of(batch.column(0))[0]
                flat, single = np.r_[vocab.end, table[places]], np.r_[False, once[places]]
                found += np.bincount(flat[:-1][single[1:]] * size + rare, minlength=size * size)
                found += np.bincount(rare * size + flat[1:][single[:-1]], minlength=size * size)
            codes = np.flatnonzero(found)
            yield from count_rows(codes, found[codes])

        rows = training.select("places").mapInArrow(counted, COUNTS)
    else:
        rows = None
    if rest is not None:
        code = lambda own, places, symbols, after: own * size + symbols if after else symbols * size + own
        single = rest.words.where(F.col("count") == 1).select(F.lit(rare).cast("bigint").alias("class"), "before", "after")
        beside = single.mapInArrow(rest_codes(vocab, code), COUNTS)
        first = rest.pairs.where("once_a").select((F.lit(rare * size) + F.col("class_b")).cast("bigint").alias("word"), F.col("times").alias("count"))
        second = rest.pairs.where("once_b").select((F.col("class_a") * size + rare).cast("bigint").alias("word"), F.col("times").alias("count"))
        joined = beside.unionByName(first).unionByName(second)
        rows = joined if rows is None else rows.unionByName(joined)
    if rows is not None:
        summed_rows = rows.groupBy("word").agg(F.sum("count").alias("count")).toPandas()
        total[summed_rows["word"].to_numpy(np.int64)] += summed_rows["count"].to_numpy(float)
    return total.reshape(size, size)


def h(values: np.ndarray) -> np.ndarray:
    return values * np.log(np.maximum(values, 1))


def exchange(matrix: np.ndarray, n_core: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """A class per symbol. Core symbols move between ``classes`` classes; the others keep classes of their own.

    The likelihood is the sum of h over class pairs less that over the two classes'
    totals, with h(x) = x log x.
    """
    size = len(matrix)
    classes = max(1, min(classes, n_core))
    of = np.concatenate([np.arange(n_core) % classes, classes + np.arange(size - n_core)])
    total = classes + size - n_core
    member = np.zeros((size, total))
    member[np.arange(size), of] = 1
    after, before = matrix @ member, matrix.T @ member  # per symbol: what follows, what precedes, by class
    pairs = member.T @ after
    for _ in range(sweeps):
        moved = 0
        for word in range(n_core):
            own, self_count = of[word], matrix[word, word]
            right, left = after[word].copy(), before[word].copy()
            right[own] -= self_count
            left[own] -= self_count  # contexts without the word itself
            # Take the word out of its class.
            pairs[own] -= right
            pairs[:, own] -= left
            pairs[own, own] -= self_count
            # Its neighbours keep their totals wherever it goes.
            rows, columns = pairs.sum(axis=1) + left, pairs.sum(axis=0) + right
            gain = (h(pairs[:classes] + right) - h(pairs[:classes])).sum(axis=1)
            gain += (h(pairs[:, :classes] + left[:, None]) - h(pairs[:, :classes])).sum(axis=0)
            place = np.arange(classes)
            here = pairs[place, place]
            gain += h(here + right[:classes] + left[:classes] + self_count) + h(here)
            gain -= h(here + right[:classes]) + h(here + left[:classes])
            gain -= h(rows[:classes] + right.sum() + self_count) - h(rows[:classes])
            gain -= h(columns[:classes] + left.sum() + self_count) - h(columns[:classes])
            new = int(np.argmax(gain))
            if gain[new] <= gain[own] + 1e-9:
                new = own
            pairs[new] += right
            pairs[:, new] += left
            pairs[new, new] += self_count
            if new != own:
                of[word] = new
                after[:, own] -= matrix[:, word]
                after[:, new] += matrix[:, word]
                before[:, own] -= matrix[word]
                before[:, new] += matrix[word]
                moved += 1
        if not moved:
            break
    return of


def context_batches(vocab: Vocabulary, movable: np.ndarray, rows):
    """Codes of (movable word, before or after, symbol there) with their numbers, some batches of texts at a time, as ``rows`` puts them."""
    size, table, moves, rare = vocab.n_symbols, symbol_table(vocab), np.r_[movable, False, False], vocab.rare

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for batch in batches:
            places, _ = places_of(batch.column(0))
            symbols = np.r_[vocab.end, table[places]]
            moving = np.flatnonzero(moves[places])
            # A text ends with the end, so a word always has a symbol after it.
            word = places[moving].astype(np.int64) * (2 * size)
            sides = symbols[moving], symbols[moving + 2]
            held += [(word + after * size + side)[vocab.capped | (side != rare)] for after, side in enumerate(sides)]
            number += 2 * len(moving)
            if number >= COMBINED:
                yield from rows(*np.unique(np.concatenate(held), return_counts=True))
                held, number = [], 0
        if held:
            yield from rows(*np.unique(np.concatenate(held), return_counts=True))

    return counted


def best_classes(pairs: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The class for each of some words, a row each of the classes before and after them; ties keep the own class.

    The plain way: every class pair of every move. Sweeps take ``few_classes``, tests hold it against this.
    """
    n_classes = len(pairs) - 2  # the rare class and the end take no words
    rows, columns, size = pairs.sum(axis=1), pairs.sum(axis=0), len(pairs)
    total_after, total_before = after.sum(axis=1), before.sum(axis=1)
    gain, every = np.empty((len(own), n_classes)), np.arange(len(own))
    for place in range(n_classes):
        # Every class is looked at without the word, its own one and its neighbours' counts of that one too.
        inside = own == place
        row, column = np.tile(pairs[place], (len(own), 1)), np.tile(pairs[:, place], (len(own), 1))
        row[inside] -= after[inside]
        column[inside] -= before[inside]
        row[every[~inside], own[~inside]] -= before[~inside, place]
        column[every[~inside], own[~inside]] -= after[~inside, place]
        both = pairs[place, place] - np.where(inside, after[:, place] + before[:, place], 0)
        row_sum, column_sum = rows[place] - total_after * inside, columns[place] - total_before * inside
        other = np.arange(size) != place
        gain[:, place] = ((h(row + after) - h(row)) + (h(column + before) - h(column)))[:, other].sum(axis=1)
        gain[:, place] += h(both + after[:, place] + before[:, place]) - h(both)
        gain[:, place] -= h(row_sum + total_after) - h(row_sum) + h(column_sum + total_before) - h(column_sum)
    stay = gain[np.arange(len(own)), own]
    best = gain.argmax(axis=1)
    return np.where(gain.max(axis=1) > stay + 1e-9, best, own)


def few_classes(pairs: np.ndarray):
    """As ``best_classes``, with less work: gains of small numbers are looked up, and only for classes beside the word."""
    n_classes, size = len(pairs) - 2, len(pairs)
    classes = np.arange(n_classes)
    sides = []
    for matrix in (pairs, pairs.T):
        near = np.ascontiguousarray(matrix[:n_classes].T)  # by the class beside the word, then by the word's
        steps = np.stack([h(near + number) - h(near) for number in range(FEW + 1)])
        steps[:, classes, classes] = 0  # the class's pair with itself is counted apart
        sides.append((near, steps, matrix.sum(axis=1)[:n_classes]))

    def gains(own: np.ndarray, here: np.ndarray, there: np.ndarray, near, steps, sums) -> np.ndarray:
        """Of the words' neighbours on one side; ``there`` are those on the other."""
        gain = np.zeros((len(own), n_classes))
        word, beside = np.nonzero(here)
        times = here[word, beside]
        each = steps[np.minimum(times, FEW).astype(np.int64), beside]
        many = np.flatnonzero(times > FEW)
        each[many] = h(near[beside[many]] + times[many, None]) - h(near[beside[many]])
        # The neighbours' counts of the own class have the word in them.
        same = np.flatnonzero(beside == own[word])
        without = near[beside[same]] - there[word[same], :n_classes]
        each[same] = h(without + times[same, None]) - h(without)
        full = near[beside, own[word]]
        each[np.arange(len(word)), own[word]] = h(full) - h(full - times)
        within = np.flatnonzero(beside < n_classes)
        each[within, beside[within]] = 0
        if len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            gain[word[first]] = np.add.reduceat(each, first)
        totals, at = np.unique(here.sum(axis=1), return_inverse=True)
        gain -= (h(sums + totals[:, None]) - h(sums))[at]
        every = np.arange(len(own))
        gain[every, own] += h(sums[own] + totals[at]) - 2 * h(sums[own]) + h(sums[own] - totals[at])
        return gain

    def best(own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        gain = gains(own, after, before, *sides[0]) + gains(own, before, after, *sides[1])
        word, place = np.nonzero((before + after)[:, :n_classes])
        both = before[word, place] + after[word, place]
        inside = pairs[place, place] - np.where(own[word] == place, both, 0)
        gain[word, place] += h(inside + both) - h(inside)
        stay = gain[np.arange(len(own)), own]
        return np.where(gain.max(axis=1) > stay + 1e-9, gain.argmax(axis=1), own)

    return best


def sweep(training: DataFrame, vocab: Vocabulary, pairs: np.ndarray, movable: np.ndarray, rest: Rest | None = None) -> np.ndarray:
    """The class of every frequent word after all movable ones have chosen; symbols are classes here."""
    size = vocab.n_symbols

    shares = max(SHARES, partitions(training.sparkSession))

    def chosen_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The neighbours of one share of the words, added up, then the choice of each."""
        around, share = None, 0
        for batch in batches:
            for row in range(batch.num_rows):
                if around is None:
                    share = batch.column(0)[row].as_py()
                    around = np.zeros((len(vocab.words) // shares + 1) * 2 * size)
                codes, times = (np.frombuffer(batch.column(at)[row].as_buffer(), "<i4") for at in (1, 2))
                around[codes] += times  # a row has a code once
        if around is not None:
            around, best = around.reshape(-1, 2 * size), few_classes(pairs)
            met = np.flatnonzero(around.any(axis=1))
            for at in range(0, len(met), CHOSEN):
                part = met[at : at + CHOSEN]
                words = part * shares + share
                yield from count_rows(words, best(vocab.symbols[words], around[part, :size], around[part, size:]))

    def code(own: np.ndarray, places: np.ndarray, symbols: np.ndarray, after: bool) -> np.ndarray:
        """The word beyond the frequent ones, as seen from the frequent word at its side."""
        moving = np.r_[movable, False, False][places]
        return (places.astype(np.int64) * (2 * size) + (0 if after else size) + own)[moving]

    rows = dealt_rows(shares, 2 * size)
    counts = training.select("places").mapInArrow(context_batches(vocab, movable, rows), DEALT)
    if rest is not None:
        counts = counts.unionByName(rest.words.select("class", "before", "after").mapInArrow(rest_codes(vocab, code, rows), DEALT))
    # Tasks have combined their counts; a share is one task, whose words' neighbours are a table of fixed size.
    found = counts.repartitionById(shares, F.col("share")).mapInArrow(chosen_class, COUNTS).toPandas()
    classes = vocab.symbols.copy()
    classes[found["word"].to_numpy(np.int64)] = found["count"].to_numpy(np.int64)
    return classes


def sweep_rest(rest: Rest, vocab: Vocabulary, pairs: np.ndarray) -> Rest:
    """The words beyond the frequent ones after all have chosen, by the same counts as the frequent ones; staged."""
    size, table = vocab.n_symbols, symbol_table(vocab)

    def chosen_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = few_classes(pairs)
        of_single = np.full(size**3, -1, np.int64)  # by class, symbol before and symbol after

        def single_classes(own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
            """Of words seen once: those with the same class and neighbours choose alike."""
            code = (own * size + before) * size + after
            new = np.unique(code[of_single[code] < 0])
            for at in range(0, len(new), 2048):
                part = new[at : at + 2048]
                sides = [np.zeros((len(part), size)) for _ in range(2)]
                sides[0][np.arange(len(part)), part // size % size] = 1
                sides[1][np.arange(len(part)), part % size] = 1
                of_single[part] = best(part // size**2, *sides)
            return of_single[code]

        def several_classes(batch: pa.RecordBatch) -> np.ndarray:
            around = np.zeros(batch.num_rows * 2 * size)
            for after in (0, 1):
                places, row = flat(batch.column(3 + after))
                places = places.to_numpy(zero_copy_only=False)
                known = places != REST_PLACE
                around += np.bincount(row[known] * (2 * size) + after * size + table[places[known]], minlength=len(around))
            items, row = flat(batch.column(5))
            code, times = (items.field(place).to_numpy(zero_copy_only=False) for place in (0, 1))
            around += np.bincount(row * (2 * size) + code, weights=times, minlength=len(around))
            around = around.reshape(-1, 2 * size)
            return best(batch.column(2).to_numpy(zero_copy_only=False), around[:, :size], around[:, size:])

        for batch in batches:
            # One word before and one after, neither of them beyond the frequent ones.
            sides = [flat(batch.column(place)) for place in (3, 4)]
            ends = [places.to_numpy(zero_copy_only=False) for places, _ in sides]
            number = [np.bincount(row, minlength=batch.num_rows) for _, row in sides]
            single = (number[0] == 1) & (number[1] == 1)
            first = [np.minimum(np.cumsum(each) - each, max(len(end) - 1, 0)) for each, end in zip(number, ends)]
            at = np.flatnonzero(single)
            place = [end[begin[at]] for end, begin in zip(ends, first)]
            known = (place[0] != REST_PLACE) & (place[1] != REST_PLACE)
            at = at[known]
            own = batch.column(2).to_numpy(zero_copy_only=False)
            new = np.empty(batch.num_rows, np.int64)
            new[at] = single_classes(own[at], *(table[each[known]] for each in place))
            others = np.flatnonzero(~np.isin(np.arange(batch.num_rows), at))
            for begin in range(0, len(others), 2048):
                part = others[begin : begin + 2048]
                new[part] = several_classes(batch.take(pa.array(part)))
            columns = [*batch.columns[:2], pa.array(new, pa.int64()), *batch.columns[3:5]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:5])

    item = lambda word, code: rest.pairs.select(F.col(word).alias("word"), F.struct(code.alias("code"), "times").alias("item"))
    beside = item("a", F.col("class_b") + size).unionByName(item("b", F.col("class_a") + 0)).groupBy("word").agg(F.collect_list("item").alias("items"))
    joined = rest.words.join(beside, "word", "left").select("word", "count", "class", "before", "after", "items")
    words = stage(joined.mapInArrow(chosen_class, CLASSED), "rest-words")
    return Rest(words, pairs_with_classes(rest.pairs, words))


def with_classes(vocab: Vocabulary, classes: np.ndarray, total: int, rest: Rest | None = None) -> tuple[Vocabulary, Rest | None]:
    """The vocabulary and the other words with classes as symbols, those without words left out; the rare class and the end stay the last ones."""
    others = rest.classes() if rest is not None else []
    names = np.unique(np.r_[classes, np.array([*others, total - 2, total - 1], np.int64)])
    classed = replace(vocab, symbols=np.searchsorted(names, classes), n_symbols=len(names), n_core=0)
    return classed, rest.relabelled(np.searchsorted(names, np.arange(total))) if rest is not None else None


@dataclass
class ClassModel:
    """Frequent words with class and log10 probability in the class; log10 transitions; the classes' denominators, also the rare one's."""

    vocab: Vocabulary
    symbol_class: np.ndarray
    emission: np.ndarray
    transition: np.ndarray
    denominators: np.ndarray
    rest: Rest | None

    @property
    def rare_denominator(self) -> float:
        return self.denominators[self.symbol_class[self.vocab.rare]]


def summed(matrix: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Counts of pairs of symbols as counts of pairs of their classes."""
    member = np.eye(int(of.max()) + 1)[of]
    return member.T @ matrix @ member


def class_model(vocab: Vocabulary, matrix: np.ndarray, of: np.ndarray, rest: Rest | None = None) -> ClassModel:
    total, pairs = int(of.max()) + 1, summed(matrix, of)
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + total)
    transition = np.log10((pairs + BACKOFF * share) / (pairs.sum(axis=1, keepdims=True) + BACKOFF))
    word_class = of[vocab.symbols] if len(vocab.words) else np.empty(0, np.int64)
    sums = np.bincount(word_class, weights=vocab.counts + ADDED, minlength=total)
    rare = of[vocab.rare]
    if not vocab.capped:
        sums[rare] += ADDED  # all words that training has are in other classes
    if rest is not None:
        for row in rest.words.groupBy("class").agg(F.sum("count").alias("count"), F.count("*").alias("words")).collect():
            sums[of[row["class"]]] += row["count"] + ADDED * row["words"]
    if vocab.capped:
        ends = matrix[:, vocab.end].sum()
        n_rare_words = vocab.n_words - len(vocab.words) - (1 if ends else 0)
        sums[rare] += vocab.n_tokens - vocab.counts.sum() - ends + ADDED * (n_rare_words + 1)
    emission = np.log10((vocab.counts + ADDED) / sums[word_class])
    return ClassModel(vocab, of, emission, transition, sums, rest)


def fit(training: DataFrame, vocab: Vocabulary, counts: DataFrame) -> ClassModel:
    """The model of the training texts, given as places, and their words' counts."""
    rest = rest_of(training, counts, vocab)
    matrix = all_neighbour_counts(training, vocab, rest)
    of = exchange(matrix, vocab.n_core)
    movable = vocab.symbols >= vocab.n_core
    rest = rest.relabelled(of) if rest is not None else None
    classed, rest = with_classes(vocab, of[vocab.symbols], int(of.max()) + 1, rest)
    names = np.unique(of)
    pairs = summed(matrix, np.searchsorted(names, of))
    for _ in range(WORD_SWEEPS if movable.any() or rest is not None else 0):
        classes = sweep(training, classed, pairs, movable, rest)
        following = sweep_rest(rest, classed, pairs) if rest is not None else None
        if rest is not None:
            rest.discard()  # the next sweep reads what this one staged
        classed, rest = with_classes(classed, classes, classed.n_symbols, following)
        pairs = all_neighbour_counts(training, classed, rest)
    if not vocab.capped:
        pairs = pairs + unseen_counts(training, classed, rest)
    if rest is not None:
        discard(rest.pairs)  # counted; scoring takes the words alone
    return class_model(classed, pairs, np.arange(classed.n_symbols), rest)


def train(texts: DataFrame, counts: DataFrame) -> ClassModel:
    """The model of the texts, all for training, and their words' counts."""
    vocab = vocabulary(counts)
    return fit(placed(texts, vocab), vocab, counts)


def score_batches(model: ClassModel):
    """The sums of log10 transitions between frequent words and of their emissions, after the columns of SCORED."""
    vocab = model.vocab
    classes_of, emission = model.symbol_class[symbol_table(vocab)], np.r_[model.emission, 0.0, 0.0]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, begins = places_of(batch.column(7))
            classes, rest = classes_of[places], places == REST_PLACE
            each = model.transition[np.r_[model.symbol_class[vocab.end], classes[:-1]], classes] + emission[places]
            each[rest | np.r_[False, rest[:-1]]] = 0
            # Where a word beyond the frequent ones stands before, the emission is all that is known here.
            follows = np.flatnonzero(np.r_[False, rest[:-1]] & ~rest)
            each[follows] = emission[places[follows]]
            sums = np.add.reduceat(each, begins) if len(begins) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(sums, pa.float64())], names=[*batch.schema.names[:7], "model"])

    return scored


def rest_scores(model: ClassModel):
    """What words beyond the frequent ones add to a row, with the transitions beside them.

    The words come by row and place, so of two such words next to each other the first has just been seen.
    """
    classes_of, rare = model.symbol_class[symbol_table(model.vocab)], model.symbol_class[model.vocab.rare]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_row, last_class, last_sums = -1, 0, np.zeros(3)  # of the row that may go on in the next batch

        def added(rows: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(rows, pa.int64()), pa.array(sums[0]), pa.array(sums[1].astype(np.int64)), pa.array(sums[2])]
            return pa.RecordBatch.from_arrays(columns, names=["row", "rest_log", "rest_known", "rest_model"])

        for batch in batches:
            if not batch.num_rows:
                continue
            row, before, after = (batch.column(place).to_numpy(zero_copy_only=False) for place in (0, 2, 3))
            count = batch.column(4).fill_null(0).to_numpy(zero_copy_only=False)
            own = batch.column(5).fill_null(int(rare)).to_numpy(zero_copy_only=False)
            log = np.log10(count + ADDED)
            previous = np.where(before == REST_PLACE, np.r_[last_class, own[:-1]], classes_of[before])
            score = log - np.log10(model.denominators[own]) + model.transition[previous, own]
            score += np.where(after == REST_PLACE, 0, model.transition[own, classes_of[after]])
            begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            rows, sums = row[begins], np.add.reduceat(np.stack([log, count > 0, score]), begins, axis=1)
            if rows[0] == last_row:
                sums[:, 0] += last_sums
            elif last_row >= 0:
                yield added(np.array([last_row]), last_sums[:, None])
            last_row, last_class, last_sums = rows[-1], own[-1], sums[:, -1]
            yield added(rows[:-1], sums[:, :-1])
        if last_row >= 0:
            yield added(np.array([last_row]), last_sums[:, None])

    return scored


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: tokens, known ones, the unigram score and the class model's, log10."""
    small_batches(docs.sparkSession)
    texts = chosen(docs, id_col, text_col)
    counts = word_counts(texts.where(~F.col("held_out")))
    vocab = vocabulary(counts)
    scan = placed(texts, vocab)
    model = fit(scan.where(~F.col("held_out")), vocab, counts)
    sent = replace(model, rest=None)  # tables stay on the driver
    scores = scan.drop("rest", "pairs").mapInArrow(score_batches(sent), SCORED)
    # Without classes of their own these words are of the rare class, like unknown ones.
    of = counts.withColumn("class", F.lit(None).cast("bigint")) if model.rest is None else model.rest.words
    of = of.select("word", "count", "class")
    found = scan.select("row", F.posexplode("rest").alias("at", "item")).select("row", "at", "item.*")
    rest = found.join(of.hint("shuffle_hash"), "word", "left").select("row", "at", "before", "after", "count", "class")
    joined = rest.repartition("row").sortWithinPartitions("row", "at").mapInArrow(rest_scores(sent), ADDENDS)
    # The end is counted like a word, so it comes from the same table.
    ends = counts.where(F.col("word") == END).agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    rest_log, rest_known, rest_model = F.coalesce("rest_log", F.lit(0.0)), F.coalesce("rest_known", F.lit(0)), F.coalesce("rest_model", F.lit(0.0))
    base = F.col("base") + rest_log - F.col("n_rest") * np.log10(vocab.base_denominator) + np.log10((ends + ADDED) / vocab.base_denominator)
    score = F.col("model") + rest_model
    return scores.join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_frequent") + rest_known + (1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(int(vocab.n_tokens)).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
