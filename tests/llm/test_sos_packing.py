import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import sos_packing
from llm.common import table
from llm.queries import QUERIES
from llm.sos_packing import Encoder, SumOfSquares, pack, rest_lengths

from .helpers import docs_frame, edge_rows


def check(rows, texts):
    """Every id lies in one piece, sequences have no gap and need no padding."""
    encoder, pieces, sequences = Encoder(), defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append(row)
    for doc, text in texts.items():
        ids = np.array([*encoder.slow.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for row in sorted(pieces.pop(doc), key=lambda row: row["start"]):
            part = ids[at : at + row["length"]]
            assert (row["start"], row["doc_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += row["length"]
        assert at == len(ids)
    assert not pieces
    for found in sequences.values():
        found.sort(key=lambda row: row["offset"])
        total = sum(row["length"] for row in found)
        assert [row["offset"] for row in found] == [sum(row["length"] for row in found[:at]) for at in range(len(found))]
        assert total == 2048 or total & (total - 1) == 0
        assert all(row["sequence_length"] == total for row in found)


def test_packing_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").collect()
    check(QUERIES["op5_sos_packing"](spark, sf_dir).collect(), {row["doc_id"]: row["text"] for row in docs})


def test_edges(spark):
    texts = {row[0]: row[1] for row in edge_rows() if row[0] not in (5, None)} | {30: "<|endoftext|> 漢字 ١٢ é", 31: "it's ok ʕ"}
    check(pack(docs_frame(spark, list(texts.items()))).collect(), texts)
    repeated = pack(docs_frame(spark, [(1, "a b")] * 3 + [(None, None)])).collect()
    assert sum(row["length"] for row in repeated if row["doc_id"] == 1) == 9 and len([row for row in repeated if row["doc_id"] is None]) == 1
    assert pack(docs_frame(spark, [])).collect() == []


def test_choice_has_the_least_sum_of_squares():
    rng, packer, levels = random.Random(5), SumOfSquares(64), defaultdict(int)
    for _ in range(600):
        size = rng.randrange(1, 64)

        def after(level):
            new = dict(levels)
            if level:
                new[level] -= 1
            if level + size < 64:
                new[level + size] = new.get(level + size, 0) + 1
            return sum(count**2 for count in new.values())

        options = [level for level, count in levels.items() if count and level + size <= 64] + [0]
        chosen = packer.choose(size)
        assert chosen in options and after(chosen) == min(map(after, options))
        packer.add(size, size)
        if chosen:
            levels[chosen] -= 1
        if chosen + size < 64:
            levels[chosen + size] += 1
    assert all(packer.levels[level] == levels[level] == len(packer.open.get(level, [])) for level in range(64))


@pytest.mark.parametrize("splits", [1, 4, 32])
def test_nearly_all_tokens_lie_where_the_sum_of_squares_puts_them(spark, splits):
    docs = table(spark, "/root/testdata/sf0.1", "documents").repartition(splits, "doc_id")
    rows = pack(docs).groupBy("closed").agg(F.sum("length").alias("ids")).collect()
    ids = {row["closed"]: row["ids"] for row in rows}
    assert ids[True] <= 0.05 * (ids[True] + ids[False])


@pytest.mark.parametrize("group", [1, 3, 1000])
def test_groups_of_open_windows_of_any_size(spark, sf_dir, group):
    docs = table(spark, sf_dir, "documents")
    rows = pack(docs.repartition(6), group=group).collect()
    check(rows, {row["doc_id"]: row["text"] for row in docs.collect()})
    assert len({row["sequence_id"] >> 40 for row in rows if row["sequence_id"] >= sos_packing.SECOND}) >= (2 if group == 1 else 1)


def test_closing_fills_the_fullest_with_the_emptiest():
    rng = random.Random(8)
    for _ in range(50):
        windows = [[(number, 0, np.arange(rng.randrange(1, 60)), 60, False)] for number in range(rng.randrange(12))]
        windows.sort(key=lambda pieces: -len(pieces[0][2]))
        total, sizes = sum(len(pieces[0][2]) for pieces in windows), {pieces[0][0]: len(pieces[0][2]) for pieces in windows}
        closed = list(sos_packing.close(windows, 64))
        lengths = [sum(len(piece[2]) for piece in pieces) for pieces in closed]
        assert sum(lengths) == total and lengths[: total // 64] == [64] * (total // 64) and all(size & (size - 1) == 0 for size in lengths)
        found = defaultdict(list)
        for pieces in closed:
            for doc, start, ids, _, _ in pieces:
                assert ids[0] == start and len(ids)
                found[doc] += ids.tolist()
        assert {doc: sorted(ids) for doc, ids in found.items()} == {doc: list(range(size)) for doc, size in sizes.items()}


@pytest.mark.parametrize("total", [0, 1, 2047, 2048, 5000])
def test_rest_needs_no_padding(total):
    lengths = rest_lengths(total)
    assert sum(lengths) == total and all(length <= 2048 and length & (length - 1) == 0 for length in lengths)


def test_both_encoders_agree():
    encoder = Encoder()
    for text in ["Ünï cödé ßtraße", "a\tb\r\n  c", "“quoted” – 3€", "don't we'll"]:
        assert encoder.ids(text).tolist() == [*encoder.slow.encode(text, add_special_tokens=False).ids, 1]
    assert sos_packing.END_ID == 1
