"""Sum-of-squares online packing of documents into token windows.

Each task packs the documents of its input split as they come. A document gives
as many full windows as it fills by itself; its rest goes into the open window,
or a new one, for which the sum over fill levels of the squared number of open
windows is least. An array holds that number per level, so a choice reads the
array and never the windows.

What is still open when a split ends is staged, and goes through a second pass of the
same kind: neighbouring splits make groups of about ``GROUP`` open windows, and each group's
pieces are placed anew, together. So a small split does not decide how much
the method places.

What is open when a group ends is closed: the emptiest windows are taken apart, and their
pieces fill the fullest ones, cut where a window is full. What is left, less than a window per group, is cut into
windows whose lengths are powers of two. So no window is padded. ``closed`` marks the pieces that were
moved or cut in that; all others lie where the sum of squares put them. Memory of a task is
its split's or group's open windows, besides one batch of texts.

Defined results: a null text is an empty one, whose document is the end id alone;
null document ids are kept; repeated rows are packed once per row; an empty table
gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import small_batches, stage

WINDOW = 2048
END_ID = 1
GROUP = 4096  # open windows of a group, 32 MB of ids; a group ends with the split that reaches it
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, sequence_length bigint, closed boolean"
)
NAMES = [part.split()[0] for part in PIECES.split(", ")]
# Pieces of windows that a split leaves open come with their ids, split and place there instead of a sequence.
STAGED = f"{PIECES}, split bigint, at bigint, ids binary"
OPEN = "doc_id bigint, start bigint, doc_tokens bigint, split bigint, at bigint, ids binary, part bigint"
SECOND = 1 << 62  # sequences of the second pass are numbered from here
EMITTED = 512
# Letters and digits up to here are the same in every Unicode version, so both
# libraries split such texts alike.
_BEYOND_LATIN = re.compile("[^\x00-ɏ‐-‧€]")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of the byte-level vocabulary.

    ``tokenizers`` defines the ids. Texts of Latin letters without the special
    token's name go through ``tiktoken`` with the same vocabulary, which gives the
    same ids four times as fast.
    """

    def __init__(self, folder_path=None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = folder_path or public_tokenizers.path
        self.slow = Tokenizer.from_file(path("byte_bpe_50k.json"))
        with open(path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        """The text's ids and the end id."""
        if _SPECIAL in text or not text.isascii() and _BEYOND_LATIN.search(text):
            found = self.slow.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array([*found, END_ID], "<u4")


class SumOfSquares:
    """Open windows by fill level, and the choice of the level for a piece."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def choose(self, size: int) -> int:
        """The fill level to add a piece to; 0 is a new window. Ties go to the fullest."""
        level = np.flatnonzero(self.levels[: self.window - size + 1])
        change = 2 * (self.levels[level + size] - self.levels[level]) + 2
        if len(level) and level[-1] == self.window - size:
            change[-1] -= 1  # a full window is no longer counted
        least = len(change) - 1 - int(np.argmin(change[::-1])) if len(change) else -1
        return int(level[least]) if least >= 0 and change[least] <= 2 * self.levels[size] + 1 else 0

    def add(self, size: int, piece) -> list | None:
        """Place a piece of fewer ids than a window; returns the window's pieces if it is full now."""
        level = self.choose(size)
        if level:
            self.levels[level] -= 1
            pieces = self.open[level].pop()
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.levels[level + size] += 1
        self.open.setdefault(level + size, []).append(pieces)
        return None

    def rest(self) -> list[list]:
        """All open windows, fullest first, as lists of pieces."""
        return [pieces for level in sorted(self.open, reverse=True) for pieces in self.open[level]]


def rest_lengths(total: int, window: int = WINDOW) -> list[int]:
    """Lengths that leave no padding: full windows, then powers of two."""
    tail = total % window
    return [window] * (total // window) + [1 << bit for bit in range(tail.bit_length() - 1, -1, -1) if tail >> bit & 1]


def cut(piece: tuple, length: int) -> tuple[tuple, tuple]:
    """A piece (document, start, ids, document's tokens, closed) as its first ids and the others."""
    doc, start, ids, whole, _ = piece
    return (doc, start, ids[:length], whole, True), (doc, start + length, ids[length:], whole, True)


def close(windows: list[list], window: int = WINDOW) -> Iterator[list]:
    """Windows without padding out of open ones, fullest first: pieces of the last ones fill up the first ones."""
    size = lambda pieces: sum(len(piece[2]) for piece in pieces)
    first, last = 0, len(windows) - 1
    while first < last:
        gap = window - size(windows[first])
        while gap and first < last:
            piece = windows[last].pop()
            if len(piece[2]) > gap:
                piece, others = cut(piece, gap)
                windows[last].append(others)
            windows[first].append((*piece[:4], True))
            gap -= len(piece[2])
            last -= not windows[last]
        if not gap:
            yield windows[first]
            first += 1
    if first == last:
        todo = windows[first][::-1]
        for length in rest_lengths(size(todo), window):
            pieces = []
            while length:
                piece = todo.pop()
                if len(piece[2]) > length:
                    piece, others = cut(piece, length)
                    todo.append(others)
                pieces.append((*piece[:4], True))
                length -= len(piece[2])
            yield pieces


class Rows:
    """Pieces of finished windows as rows, with sequences numbered from a start."""

    def __init__(self, sequence: int):
        self.sequence, self.rows = sequence, []

    def add(self, pieces: list) -> None:
        offset, length = 0, sum(len(piece[2]) for piece in pieces)
        for doc, start, ids, whole, closed in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), whole, self.sequence, offset, length, closed))
            offset += len(ids)
        self.sequence += 1

    def columns(self) -> list[pa.Array]:
        """The rows so far, which are forgotten here."""
        columns = list(zip(*self.rows)) or [()] * len(NAMES)
        self.rows = []
        return [pa.array(column, pa.bool_() if name == "closed" else pa.int64()) for name, column in zip(NAMES, columns)]


def pack_splits(window: int):
    """The finished windows of a split, then the pieces of its open ones with their ids."""
    names = [part.split()[0] for part in STAGED.split(", ")]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = TaskContext.get().partitionId()
        encoder, packer, out = Encoder(), SumOfSquares(window), Rows(split << 40)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text or "")
                full = len(ids) // window * window
                for start in range(0, full, window):
                    out.add([(doc, start, ids[start : start + window], len(ids), False)])
                if full < len(ids):
                    if pieces := packer.add(len(ids) - full, (doc, full, ids[full:].copy(), len(ids), False)):
                        out.add(pieces)
            columns = out.columns()
            none = [pa.nulls(len(columns[0]), kind) for kind in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *none], names=names)
        left = [piece for pieces in packer.rest() for piece in pieces]
        for at in range(0, len(left), EMITTED):
            part = left[at : at + EMITTED]
            held = {
                "doc_id": [piece[0] for piece in part], "start": [piece[1] for piece in part], "doc_tokens": [piece[3] for piece in part],
                "split": [split] * len(part), "at": range(at, at + len(part)), "ids": [piece[2].tobytes() for piece in part],
            }
            kinds = {"ids": pa.binary(), "closed": pa.bool_()}
            columns = [pa.array(held[name], kinds.get(name, pa.int64())) if name in held else pa.nulls(len(part), kinds.get(name, pa.int64())) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return packed


def pack_group(window: int):
    """The windows of all pieces that a group's splits have left, none of them open in the end."""

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("split", "ascending"), ("at", "ascending")])
        packer, out = SumOfSquares(window), Rows(SECOND + (table["part"][0].as_py() << 40))
        of = [table[name].to_pylist() for name in ("doc_id", "start", "ids", "doc_tokens")]
        for doc, start, ids, whole in zip(*of):
            ids = np.frombuffer(ids, "<u4")
            if pieces := packer.add(len(ids), (doc, start, ids, whole, False)):
                out.add(pieces)
        for pieces in close(packer.rest(), window):
            out.add(pieces)
        return pa.Table.from_arrays(out.columns(), names=NAMES)

    return packed


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """One row per piece: document, place in it, length, checksum, and place in a sequence.

    ``sequence_id`` holds the number of the input split, or of the group, above 40 bits of its
    own count, so it is the same when a lost task runs again.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    staged = stage(chosen.mapInArrow(pack_splits(window), STAGED), "packed")
    left = staged.where(F.col("ids").isNotNull())
    # One row per split, so one task numbers the groups whatever the size of the table.
    sizes = left.groupBy("split").agg(F.sum(F.octet_length("ids")).alias("bytes"))
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(4 * window * group))
    parts = stage(sizes.select("split", part.alias("part")), "packing-groups")
    grouped = left.join(parts, "split").select(*(name.split()[0] for name in OPEN.split(", ")))
    again = grouped.groupBy("part").applyInArrow(pack_group(window), PIECES)
    return staged.where(F.col("ids").isNull()).select(*NAMES).unionByName(again)
