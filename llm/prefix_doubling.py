"""Removal of repeated byte strings by distributed prefix doubling over a sparse suffix array.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere else,
in the same document or another one. Strings are compared on the input.

Sorting the suffixes of all positions would move every byte many times over. So suffixes are
sorted at anchors only: a string's anchor is the position, among its first ``REACH``, whose
``GRAM`` bytes hash least (the first of equal ones). Equal strings have their anchor at the same
offset, and from an anchor on, the next one follows from the next ``REACH + GRAM`` bytes.
Anchors thus cut a text into phrases, and equal texts into equal phrases. Steps:

1. rank the anchors by their first phrase, then double: Spark sorts the pairs of ranks (of an anchor, and
   of the anchor as many phrases on) and gives each distinct pair its rank. Anchors whose pair
   is unique are dropped. An anchor is done when its rank spans all phrases that begin within the
   bytes that every string with this anchor has in common (``CERTAIN`` from the anchor on).
2. of the anchors that are left, all strings with this anchor begin in one stretch of positions
   (a family). Families with the same bytes from the first string's begin to the
   last one's end repeat each other and are removed whole. Other families that share their
   ``CERTAIN`` bytes may repeat in part: their strings, and those of one family of each
   kind they meet, are hashed one by one, and those that occur at two positions are removed.
3. texts that occur more than once as a whole are removed whole, if long enough, by counting.

A text is known by 86 bits of hashes, so copies count as one and are not compared. Ranks serve
as a sieve; families and strings are compared by a 64-bit hash of what all
strings of the anchor share and one of the whole. What goes through a
shuffle with many equal keys is sorted into ranges by key and position, so a passage
that a third of all texts holds spreads over many tasks; its rank in later ranges is
corrected by a table with one row per range. Tasks see texts, never groups, whole.

Defined results: a null text is an empty one; null ids are kept; repeated rows are copies and
remove each other; an empty table gives an empty result; other columns are not read.
What is kept need not be valid UTF-8, so ``kept`` is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import partitions, powers, small_batches, stage, text_bytes

LENGTH = 200
REACH, GRAM = 64, 8
# A string's anchor lies among its first REACH positions, so it has at least these bytes from the anchor on.
CERTAIN = LENGTH - REACH + 1
# The phrase that begins here or before is known from these bytes.
LAST_PHRASE = CERTAIN - REACH - GRAM
CHUNK = 1 << 17
# Bounds of the ranges come from one text in so many, by hash, and from so many of its positions for each range.
SAMPLED_ONE_IN, SAMPLED_PER_RANGE = 64, 40
_MIX = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.Generator(np.random.PCG64(20240711)).integers(0, 1 << 64, 256, np.uint64, endpoint=False)

# A position: 22 bits of the text's second hash, the number of the anchor (or byte), phrases to rank, whether it has a family.
SUB_SHIFT, PLACE_SHIFT, PHRASE_SHIFT = 41, 9, 1
PLACE_MASK, PHRASE_MASK = (1 << 32) - 1, 255
BLOCK_SHIFT = 40
WHOLE, TEST = 1, 2

PLACED = "mark bigint, at bigint"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def least_grams(raw: np.ndarray) -> np.ndarray:
    """For every window of ``REACH`` positions, the first of those whose bytes hash least."""
    grams = raw.astype(np.uint64)
    for width in (1, 2, 4):
        grams = grams[:-width] | (grams[width:] << np.uint64(8 * width))
    grams *= _MIX
    grams ^= grams >> np.uint64(29)
    grams *= _MIX
    grams &= np.uint64(0xFFFFFFFF00000000)
    grams |= np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < REACH:
        grams = np.minimum(grams[:-width], grams[width:])
        width *= 2
    return (grams & np.uint64(0xFFFFFFFF)).astype(np.int64)


def parsed(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every text of ``LENGTH`` bytes or more: its number, bytes, anchors, and the first window of each anchor.

    Texts are taken together up to the size of a chunk.
    """
    for text, begin, end, part, least in chunks(column):
        own = least[begin : end - REACH - GRAM + 2]
        firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        yield text, part[begin:end], own[firsts] - begin, firsts


def chunks(column: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Text by text: its number, its place in a chunk of bytes, the chunk and its least grams."""
    raw, edges = text_bytes(column)
    at = 0
    while at < len(edges) - 1:
        stop = max(at + 1, int(np.searchsorted(edges, edges[at] + CHUNK, "right")) - 1)
        part = raw[edges[at] : edges[stop]]
        sizes = np.diff(edges[at : stop + 1])
        if sizes.max() >= LENGTH:
            least = least_grams(part)
            for text in np.flatnonzero(sizes >= LENGTH).tolist():
                yield at + text, int(edges[at + text] - edges[at]), int(edges[at + text + 1] - edges[at]), part, least
        at = stop


def families(size: int, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last begin of the strings of every anchor that has some, of a text of so many bytes."""
    last = size - LENGTH
    firsts = firsts[: np.searchsorted(firsts, last, "right")]
    lasts = np.append(firsts[1:] - 1, last)
    return firsts, lasts


def named_phrases(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every text that ``parsed`` gives: its number, anchors, first windows, and 64-bit names of the phrases from each anchor to the next."""
    known, sums, inverse = None, None, None
    for text, begin, end, part, least in chunks(column):
        if part is not known:
            power, inverse = powers(len(part))
            known, sums = part, np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_VALUES[part] * power, out=sums[1:])
        own = least[begin : end - REACH - GRAM + 2]
        firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        anchors = own[firsts]
        ends = sums[anchors]
        names = (ends[1:] - ends[:-1]) * inverse[anchors[:-1]]
        names ^= names >> np.uint64(32)
        names *= _MIX
        yield text, anchors - begin, firsts, (names ^ (names >> np.uint64(29))).view(np.int64)


def phrase_batches(bounds: np.ndarray | None):
    """(range, name, mark, at) of every phrase; a text that a task has seen before is left out."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            marks, subs = (batch.column(place).to_numpy() for place in (0, 1))
            edges = np.diff(text_bytes(batch.column(2))[1])
            columns = ([], [], [])
            for text, anchors, firsts, names in named_phrases(batch.column(2)):
                known = (int(marks[text]), int(subs[text]))
                if known in seen or not len(names):
                    continue
                seen.add(known)
                places = np.arange(len(names))
                phrases = np.minimum(np.searchsorted(anchors, anchors[:-1] + LAST_PHRASE, "right"), len(names)) - places
                family = places < len(families(int(edges[text]), firsts)[0])
                columns[0].append(names)
                columns[1].append(np.full(len(names), marks[text]))
                columns[2].append((subs[text] << SUB_SHIFT) | (places << PLACE_SHIFT) | (phrases << PHRASE_SHIFT) | family)
            yield placed([joined(column) for column in columns], bounds, ["first", "mark", "at"])

    return named


def placed(columns: list[np.ndarray], bounds: np.ndarray | None, names: list[str]) -> pa.RecordBatch:
    """The columns, after the range that the row lies in."""
    return longs([ranges(columns, bounds), *columns], ["part", *names])


def ranges(columns: list[np.ndarray], bounds: np.ndarray | None) -> np.ndarray:
    """How many bounds (columns of numbers, sorted) are not above each row, by bisection over all columns at once."""
    low = np.zeros(len(columns[0]), np.int64)
    if bounds is None or not bounds.shape[1]:
        return low
    high = np.full(len(columns[0]), bounds.shape[1])
    while (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, bounds.shape[1] - 1)
        below, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
        for column, bound in zip(columns, bounds):
            at = bound[middle]
            below |= equal & (at < column)
            equal &= at == column
        up = open_ & (below | equal)
        low, high = np.where(up, middle + 1, low), np.where(open_ & ~up, middle, high)
    return low


def bounds_of(sample: DataFrame, keys: list[str], count: int) -> np.ndarray:
    """Bounds of ``count`` ranges of about equal size, from about ``SAMPLED_PER_RANGE`` sampled rows for each."""
    order = [*keys, "mark", "at"]
    one_in = max(1, sample.count() // (SAMPLED_PER_RANGE * count))
    found = sorted(tuple(row) for row in sample.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(one_in)) == 0).collect())
    picked = sorted({found[len(found) * part // count] for part in range(1, count)}) if found else []
    return np.array(picked, np.int64).reshape(-1, len(order)).T


def few(frame: DataFrame) -> DataFrame:
    return frame.where(F.pmod("mark", F.lit(SAMPLED_ONE_IN)) == 0)


def longs(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def stacked(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])


def changes(data: np.ndarray) -> np.ndarray:
    """Which columns of numbers differ from the one before; the first one does."""
    return np.r_[True, (data[:, 1:] != data[:, :-1]).any(0)] if data.shape[1] else np.empty(0, bool)


RANKED = "rank bigint, mark bigint, at bigint, opening array<bigint>, closing array<bigint>, alone array<boolean>"


def ranked(rows: DataFrame, keys: list[str], ranges: int) -> DataFrame:
    """(rank, mark, at): positions whose keys some other position has too, ranked in the order of the keys.

    ``part`` tells the range of a row. A range is sorted by one task; a rank is the range
    and the number of the group in it. A group that goes on in the next range has its rank there
    corrected, and a position at an end of a range goes if no neighbouring range has its keys.
    """
    width = len(keys)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << BLOCK_SHIFT
        previous = waiting = opening = closing = None  # last row; a row alone so far; keys at both ends
        rank, kept, first_size, last_size = block - 1, False, 0, 0

        def out(ranks: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
            none = [pa.nulls(len(ranks), pa.list_(kind)) for kind in (pa.int64(), pa.int64(), pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(data[width]), pa.array(data[width + 1]), *none], names=names)

        for batch in batches:
            data = stacked(batch)
            if previous is not None:
                data = np.concatenate([previous, data], axis=1)
            data = data[:, changes(data)][:, (0 if previous is None else 1) :]  # equal rows are copies
            if not data.shape[1]:
                continue
            previous = data[:, -1:]
            opening = data[:width, 0].tolist() if opening is None else opening
            goes_on = closing == data[:width, 0].tolist()
            new = changes(data[:width])
            new[0] = not goes_on
            ranks = rank + np.cumsum(new)
            starts = np.flatnonzero(np.r_[True, new[1:]])
            sizes = np.diff(np.r_[starts, data.shape[1]])
            several = (sizes > 1) | (ranks[starts] == block)
            several[0] |= goes_on
            if goes_on and waiting is not None:
                yield out(np.array([rank]), waiting)
            sizes[0] += last_size if goes_on else 0
            first_size += int(sizes[ranks[starts] == block].sum()) - (last_size if goes_on and ranks[0] == block else 0)
            closing, rank, last_size = data[:width, -1].tolist(), int(ranks[-1]), int(sizes[-1])
            waiting = None if several[-1] else data[:, -1:]
            take = np.repeat(several, np.diff(np.r_[starts, data.shape[1]]))
            yield out(ranks[take], data[:, take])
        if waiting is not None:
            yield out(np.array([rank]), waiting)
        if opening is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rank]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([opening]), pa.array([closing]),
                    pa.array([[first_size == 1, last_size == 1]]),
                ],
                names=names,
            )

    names = [field.split()[0] for field in RANKED.split(", ")]
    order = [*keys, "mark", "at"]
    spark = rows.sparkSession
    sorted_ = rows.repartitionById(ranges, F.col("part").cast("int")).select(*order).sortWithinPartitions(*order)
    staged = stage(sorted_.mapInArrow(numbered, RANKED), "ranks")
    result = staged.where("mark IS NOT NULL").select("rank", "mark", "at")
    moved, last, before = [], None, None
    # One row per range comes to the driver.
    ends = sorted(staged.where("mark IS NULL").select("rank", "opening", "closing", "alone").collect(), key=lambda row: row["rank"])
    for row, after in zip(ends, [*ends[1:], None]):
        first = row["rank"] >> BLOCK_SHIFT << BLOCK_SHIFT
        comes, goes = before is not None and before["closing"] == row["opening"], after is not None and row["closing"] == after["opening"]
        single = row["rank"] == first
        if comes:
            moved.append((first, last))
        elif row["alone"][0] and not (single and goes):
            moved.append((first, None))
        if row["alone"][1] and not goes and not single:
            moved.append((row["rank"], None))
        last, before = last if comes and single else row["rank"], row
    if not moved:
        return result
    table = spark.createDataFrame([(rank, known, True) for rank, known in moved], "rank bigint, known bigint, changed boolean")
    corrected = result.join(F.broadcast(table), "rank", "left").where("changed IS NULL OR known IS NOT NULL")
    return corrected.select(F.coalesce("known", "rank").alias("rank"), "mark", "at")


def phrases_of(at):
    return F.shiftright(at, PHRASE_SHIFT).bitwiseAND(F.lit(PHRASE_MASK))


def paired(ranks: DataFrame, span: int, bounds: np.ndarray | None = None) -> DataFrame:
    """(part, first, second, mark, at): the ranks of an anchor and of one that many phrases on, ``span`` or what is left to rank."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            data = stacked(batch)
            if waiting is not None:
                data = np.concatenate([waiting, data], axis=1)
            if not data.shape[1]:
                continue
            texts = changes(np.stack([data[1], data[2] >> SUB_SHIFT]))
            cut = np.flatnonzero(texts)[-1]  # the last text may go on
            waiting = data[:, cut:]
            yield looked_up(data[:, :cut], texts[:cut])
        if waiting is not None:
            yield looked_up(waiting, changes(np.stack([waiting[1], waiting[2] >> SUB_SHIFT])))

    def looked_up(data: np.ndarray, texts: np.ndarray) -> pa.RecordBatch:
        rank, mark, at = data
        left = ((at >> PHRASE_SHIFT) & PHRASE_MASK) - span
        code = (np.cumsum(texts) << 32) + ((at >> PLACE_SHIFT) & PLACE_MASK)
        asked = np.flatnonzero(left > 0)
        goal = code[asked] + np.minimum(left[asked], span)
        found = np.minimum(np.searchsorted(code, goal), max(len(code) - 1, 0))
        good = code[found] == goal if len(code) else np.empty(0, bool)  # else a unique string lies on the way
        return placed([rank[asked[good]], rank[found[good]], mark[asked[good]], at[asked[good]]], bounds, ["first", "second", "mark", "at"])

    dealt = ranks.where(phrases_of("at") >= span).repartition(partitions(ranks.sparkSession), "mark").sortWithinPartitions("mark", "at")
    return dealt.mapInArrow(pairs, f"part bigint, first bigint, second bigint, {PLACED}")


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """(mark, at) of the anchors whose phrases, as far as every string of theirs holds them, some other position has too."""
    count = partitions(texts.sparkSession)
    named = f"part bigint, first bigint, {PLACED}"
    bounds = bounds_of(few(texts).mapInArrow(phrase_batches(None), named), ["first"], count)
    ranks, span, done = ranked(texts.mapInArrow(phrase_batches(bounds), named), ["first"], count), 1, []
    while True:
        done.append(ranks.where(phrases_of("at") <= span))
        if ranks.where(phrases_of("at") > span).isEmpty():
            break
        # Those that are done keep their rank for others' sake, but are listed once.
        bounds = bounds_of(paired(few(ranks), span), ["first", "second"], count)
        ranks = ranked(paired(ranks, span, bounds), ["first", "second"], count)
        span *= 2
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.where("at % 2 = 1").select("mark", "at")


def digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def family_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, context, mark, at) of the families listed: what all their strings share, and all their bytes."""
    for batch in batches:
        marks, subs, listed = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
        rows = ([], [], [], [])
        for text, raw, anchors, firsts in parsed(batch.column(2)):
            begins, ends = families(len(raw), firsts)
            data = raw.tobytes()
            for place in np.unique(listed[text].values.to_numpy(zero_copy_only=False)).tolist():
                anchor, begin, end = int(anchors[place]), int(begins[place]), int(ends[place])
                rows[0].append(digest(data[anchor : anchor + CERTAIN]))
                rows[1].append(digest(b"%d,%d," % (anchor - begin, end - anchor) + data[begin : end + LENGTH]))
                rows[2].append(marks[text])
                rows[3].append((subs[text] << SUB_SHIFT) | (place << PLACE_SHIFT))
        yield longs([np.array(column, np.int64) for column in rows], ["core", "context", "mark", "at"])


def classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, at, kind): which families are repeated whole and which have to be compared string by string.

    Rows come sorted by core, context and position. A family that is alone in its core has
    no partner and goes. The first and the last core of a batch may go on in the next batch or range, so they count as
    having several contexts, which costs a comparison and changes no result.
    """
    held, again = None, False  # the last row so far, and whether the row before it had the same context
    for batch in batches:
        data = stacked(batch)
        if held is not None:
            data = np.concatenate([held, data], axis=1)
        data = data[:, changes(data)]  # rows that repeat an id may come twice
        if data.shape[1] > 1:
            yield judged(data, again, data.shape[1] - 1)
            again = bool((data[:2, -1] == data[:2, -2]).all())
        held = data[:, -1:] if data.shape[1] else None
    if held is not None:
        yield judged(held, again, 1)


def judged(data: np.ndarray, again: bool, count: int) -> pa.RecordBatch:
    """The kinds of the first ``count`` rows."""
    core, context = changes(data[:1]), changes(data[:2])
    before = np.r_[again, ~context[1:]]
    after = np.r_[~context[1:], False]
    number = np.cumsum(core) - 1
    several = np.bincount(number, context) > 1
    several[[0, -1]] = True
    # Of every context one family is compared, for the sake of the others in its core.
    kinds = ((before | after) * WHOLE + (several[number] & ~before) * TEST)[:count]
    take = np.flatnonzero(kinds)
    return longs([data[2, take], data[3, take], kinds[take]], ["mark", "at", "kind"])


def window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, string, mark, at) of every string of the families to compare; ``at`` holds its first byte."""
    for batch in batches:
        marks, subs, flags = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
        rows: list[list[int]] = [[], [], [], []]
        for text, raw, anchors, firsts in parsed(batch.column(2)):
            begins, ends = families(len(raw), firsts)
            data = raw.tobytes()
            marked = flags[text].values.to_numpy(zero_copy_only=False)
            for place in np.unique(marked[marked & TEST > 0] >> 2).tolist():
                anchor, first, last = int(anchors[place]), int(begins[place]), int(ends[place])
                size = last - first + 1
                rows[0] += [digest(data[anchor : anchor + CERTAIN])] * size
                rows[1] += [digest(data[begin : begin + LENGTH]) for begin in range(first, last + 1)]
                rows[2] += [marks[text]] * size
                rows[3] += range((subs[text] << SUB_SHIFT) | first, ((subs[text] << SUB_SHIFT) | last) + 1)
        yield longs([np.array(column, np.int64) for column in rows], ["core", "string", "mark", "at"])


def removed_bytes(size: int, copied: bool, whole: list[tuple[int, int]], starts: list[int]) -> np.ndarray:
    """Which bytes of a text go: those of whole families (first and last begin) and of single strings."""
    change = np.zeros(size + 1, np.int64)
    if copied and size >= LENGTH:
        return np.ones(size, bool)
    for begin, end in [*whole, *((start, start) for start in starts)]:
        change[begin] += 1
        change[end + LENGTH] -= 1
    return np.cumsum(change[:-1]) > 0


def twice_at_least(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(mark, at) of the rows whose keys another position has too."""
    spark = rows.sparkSession
    count = partitions(spark)
    bounds = bounds_of(few(rows), keys, count)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield placed(list(stacked(batch)), bounds, [*keys, "mark", "at"])

    fields = ", ".join(f"{key} bigint" for key in keys)
    return ranked(rows.mapInArrow(dealt, f"part bigint, {fields}, {PLACED}"), keys, count).select("mark", "at")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: byte counts, removed runs, the checksum of the kept bytes and, if asked for, these."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc"), F.xxhash64(text).alias("mark"),
        F.shiftrightunsigned(F.xxhash64(F.lit(LENGTH), text), 42).alias("sub"), text.alias("text"),
    )
    anchors = repeated_anchors(chosen.select("mark", "sub", "text"))
    own = [F.col("mark"), F.shiftright("at", SUB_SHIFT).alias("sub")]
    known = ["mark", "sub"]
    copies = stage(chosen.groupBy(known).agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least")), "copies")
    first = F.col("doc").eqNullSafe(F.col("least"))
    place = F.shiftright("at", PLACE_SHIFT).bitwiseAND(F.lit(PLACE_MASK))
    listed = anchors.select(*own, place.alias("place")).groupBy(known).agg(F.collect_set("place").alias("places")).join(copies, known)
    met = chosen.join(listed, known).where(first).select("mark", "sub", "text", "places")
    order = ["core", "context", "mark", "at"]
    rows = stage(met.mapInArrow(family_batches, f"core bigint, context bigint, {PLACED}"), "families")
    kinds = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(classified, f"{PLACED}, kind bigint")
    flags = kinds.select(*own, (F.shiftleft(place, 2) + F.col("kind")).alias("flag")).groupBy(known).agg(F.collect_set("flag").alias("flags"))
    flags = stage(flags, "flags")
    compared = flags.join(copies, known).where(F.exists("flags", lambda flag: flag.bitwiseAND(F.lit(TEST)) > 0))
    strings = chosen.join(compared, known).where(first).select("mark", "sub", "text", "flags")
    strings = stage(strings.mapInArrow(window_batches, f"core bigint, string bigint, {PLACED}"), "strings")
    twice = twice_at_least(strings, ["core", "string"])
    starts = twice.select(*own, F.col("at").bitwiseAND(F.lit((1 << SUB_SHIFT) - 1)).alias("start")).groupBy(known).agg(F.collect_set("start").alias("starts"))
    found = copies.join(flags, known, "left").join(starts, known, "left")
    found = found.where("n > 1 OR flags IS NOT NULL").select(*known, (F.col("n") > 1).alias("copied"), "flags", "starts")
    rows = chosen.join(found, known, "left").select("doc", "text", "copied", "flags", "starts")
    return rows.mapInArrow(kept_batches(with_text), f"{RESULT}, kept binary" if with_text else RESULT)


def kept_batches(with_text: bool):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, edges = text_bytes(batch.column(1))
            copied, flags, starts = (batch.column(place).to_pylist() for place in (2, 3, 4))
            flagged = pc.if_else(pa.array([bool(own) for own in flags], pa.bool_()), batch.column(1), "")
            marked = {text: firsts for text, _, _, firsts in parsed(flagged)}
            rows = []
            for text, (begin, end) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                own, size = raw[begin:end], end - begin
                gone = np.zeros(0, bool)
                if copied[text] or flags[text] or starts[text]:
                    whole = []
                    if flags[text]:
                        begins, ends = families(size, marked[text])
                        whole = [(int(begins[flag >> 2]), int(ends[flag >> 2])) for flag in flags[text] if flag & WHOLE]
                    gone = removed_bytes(size, bool(copied[text]), whole, starts[text] or [])
                data = own.tobytes() if not gone.any() else own[~gone].tobytes()
                spans = int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
                rows.append((size, size - len(data), spans, hashlib.sha256(data).hexdigest(), data))
            sizes, lost, spans, sums, left = zip(*rows) if rows else [()] * 5
            arrays = [batch.column(0), *(pa.array(column, pa.int64()) for column in (sizes, lost, spans)), pa.array(sums, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(left, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return kept
