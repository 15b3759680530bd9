import hashlib
import re

import pytest

from llm import secret_links
from llm.secret_links import KINDS, SCOPE, complete_in_text, find_secrets, mask, mask_secrets, scan

from .helpers import docs_frame, edge_rows

KEY = "AKIA" + "B7" * 8
HEX = "0123456789abcdef"


def plain(text):
    """Base spans by the stated patterns, filtered after matching."""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def linked_plainly(text):
    base, weak = scan(text)
    role = lambda span: secret_links.ROLES[KINDS[span[2]]]
    out = []
    for span in weak:
        near = {role(other) for other in base + weak if other[0] <= span[1] + SCOPE and other[1] >= span[0] - SCOPE}
        rule = {3: {"secret"} <= near, 4: bool({"identifier", "endpoint"} & near), 5: {"identifier", "secret"} <= near}
        if rule[span[2]]:
            out.append((span[0], span[2], span[1]))
    return out


TEXTS = [
    f"{KEY} is used", f"password = '{'q' * 12}'", f"password = '{'q' * 11}'", "password=token:abcdefghijklmnop", f"é {HEX} ö", "deadbeef",
    "Secret: short7 at https://db.example.com/x user=alice", "user=alice", "https://db.example.com/x", "secret: short7", "AKIA12 AKIA" + "C" * 14,
    "user=alice " + "z " * 300 + f"api_key={'k' * 20}", "user=alice " + "z " * 90 + f"api_key={'k' * 20}", "ſecret=abcdefghijklmnop tokEN='AAAAAAAAAAAA'",
    ("login: bob secret=shorty1 https://h.example/ " + "pad " * 40) * 30,
]


def test_spans_agree_with_plain_search(spark):
    rows = {row["doc_id"]: row for row in find_secrets(docs_frame(spark, list(enumerate(TEXTS)))).collect()}
    assert len(rows) == len(TEXTS)
    for doc, text in enumerate(TEXTS):
        base, row = plain(text), rows[doc]
        name = lambda spans: ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop in spans)
        assert row["base_sha256"] == hashlib.sha256(name(base).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(kind == at for _, kind, _ in base) for at in range(3)]
        assert row["spans"] == name(sorted(base + linked_plainly(text)))


def test_weak_parts_alone_are_not_reported(spark):
    rows = {row["doc_id"]: row["spans"] for row in find_secrets(docs_frame(spark, list(enumerate(TEXTS)))).collect()}
    assert rows[6] == "weak:0:14,endpoint:18:42,ident:43:53"
    assert rows[7] == rows[8] == rows[9] == rows[11].split(",assign")[0][:0] == ""
    assert rows[11].startswith("assign:") and rows[12].startswith("ident:0:10,assign:")


def test_masking_keeps_all_rows_and_other_columns(spark):
    docs = docs_frame(spark, list(enumerate(TEXTS)) + [(0, TEXTS[0])] + edge_rows())
    masked = mask_secrets(docs, length_col="n_chars")
    assert masked.columns == docs.columns
    rows = masked.collect()
    assert len(rows) == docs.count()
    texts = [row["text"] for row in rows]
    assert texts.count("[access] is used") == 2 and "password = 'qqqqqqqqqqq'" in texts
    assert all(row["n_chars"] == len(row["text"] or "") and row["key"] == 7 for row in rows)


def test_masked_texts_agree_with_plain_search(spark):
    rows = mask_secrets(docs_frame(spark, list(enumerate(TEXTS))), length_col="n_chars").collect()
    span = lambda start, kind, stop: {"start": start, "kind": kind, "stop": stop}
    expected = {doc: mask(text, [span(*found) for found in sorted(plain(text) + linked_plainly(text))]) for doc, text in enumerate(TEXTS)}
    assert {row["doc_id"]: row["text"] for row in rows} == expected
    assert sum(expected[doc] != text for doc, text in enumerate(TEXTS)) > 5


def test_candidates_that_nothing_in_the_text_completes(spark):
    assert complete_in_text([], [(0, 9, 5), (20, 30, 5)]) == []
    assert complete_in_text([], [(0, 9, 3), (20, 30, 4)]) == [(0, 9, 3), (20, 30, 4)]
    assert complete_in_text([(0, 30, 2)], [(40, 50, 3), (60, 70, 5)]) == [(40, 50, 3), (60, 70, 5)]
    for text in TEXTS:
        base, weak = scan(text)
        linked = {span for span in linked_plainly(text)}
        assert linked <= {(start, kind, stop) for start, stop, kind in complete_in_text(base, weak)}


def test_edges(spark):
    rows = find_secrets(docs_frame(spark, edge_rows())).collect()
    assert len(rows) == len(edge_rows())
    empty = hashlib.sha256(b"").hexdigest()
    assert all(row["base_sha256"] == empty and row["spans"] == "" for row in rows if row["doc_id"] != 9)
    assert find_secrets(docs_frame(spark, [])).collect() == []
    assert mask_secrets(docs_frame(spark, [])).collect() == []


@pytest.mark.parametrize("text", [HEX * 5000, "token=" * 2000 + "a" * 40, "://" * 5000])
def test_long_runs(text):
    base, weak = scan(text)
    assert [(start, kind, stop) for start, stop, kind in base] == plain(text)
