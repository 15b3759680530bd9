"""Frames for the tests of the llm operators."""

from __future__ import annotations

import random

# Names that the operators use inside, as columns a caller might have too.
CLASHES = "key long, cell long, block long, guest long, place long, score long, lang_pred long, mix long, chance long, window long, words long, `a.b` long"

WORDS = [f"w{number}" for number in range(400)]


def docs_frame(spark, rows, extra: bool = True):
    """(doc_id, text, lang, source, n_chars) from (doc_id, text[, lang[, source]]), with clashing columns."""
    full = [(row[0], row[1], row[2] if len(row) > 2 else "en", row[3] if len(row) > 3 else "s", len(row[1] or "")) for row in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        full = [row + (7,) * 12 for row in full]
        schema += ", " + CLASHES
    return spark.createDataFrame(full, schema)


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(count))


def edge_rows() -> list[tuple]:
    """Nulls, blanks, a very long text, repeated rows, rows that repeat an id, and null ids."""
    long = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, prose(2, 80)), (5, prose(2, 80)), (5, prose(3, 80)), (6, long), (7, long + " tail"),
        (8, prose(2, 80)), (None, prose(2, 80)), (None, None), (None, prose(4, 60)), (None, prose(4, 60)), (9, "x" * 50_000), (10, "Ünï cödé"),
    ]
