"""Language identification in two steps: family first, then the languages within it.

A text becomes counts of letter pairs and triples of its UTF-8 bytes (lower-cased,
everything but letters a space), hashed into ``FEATURES`` places; the square roots
of the counts are scaled to length one. Families are not given but found: the
languages' mean vectors are joined, nearest first, until about the square root of
their number is left. One linear support vector machine per family separates it from
the others; within a family, one per pair of languages, and the most pairs won
decide, then the sum of margins.

The machines are trained by dual coordinate descent on at most ``SAMPLE`` labelled
documents, the same number at most of each language, those with the least hash of
their id. Everything else reads whole texts of all documents.

Defined results: a null text or one without a letter is ``und`` with score 0; so is
every text when no language is learned; with one language every other text has it,
with score 1; rows without a label teach nothing; repeated rows are predicted each;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from llm.common import free_name, small_batches

PAIR_BITS, TRIPLE_BITS = 9, 11
FEATURES = (1 << PAIR_BITS) + (1 << TRIPLE_BITS)
SAMPLE = 3000
PER_LANGUAGE = 600
EPOCHS = 20
COST = 4.0
STEEPNESS = 4.0
CHUNK_BYTES = 1 << 20
UNDETERMINED = "und"
RESULT = "doc_id bigint, lang_pred string, score double"

# Bytes that are letters of ASCII, or part of a character beyond it; all others are spaces.
LETTERS = bytes(byte if 97 <= byte <= 122 or byte >= 128 else 32 for byte in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """The unit vector of a text; zero when it has no pair of characters."""
    raw = b" " + b" ".join(text.lower().encode().translate(LETTERS).split()) + b" "
    total = np.zeros(FEATURES)
    for at in range(0, max(1, len(raw) - 2), CHUNK_BYTES):
        code = np.frombuffer(raw, np.uint8, min(CHUNK_BYTES + 2, len(raw) - at), at).astype(np.uint32)
        pairs = code[:-1] << np.uint32(8) | code[1:]
        triples = pairs[:-1] << np.uint32(8) | code[2:]
        # A pair counts with the triple that begins with it, so chunks may overlap.
        for codes, bits, begin in ((pairs[:-1], PAIR_BITS, 0), (triples, TRIPLE_BITS, 1 << PAIR_BITS)):
            places = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
            total[begin : begin + (1 << bits)] += np.bincount(places, minlength=1 << bits)
    np.sqrt(total, out=total)
    length = np.linalg.norm(total)
    return (total / length if length else total).astype("<f4")


def support_vector_machine(points: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Weights, the last one for a constant, of the hinge loss by dual coordinate descent; balanced by class."""
    points = np.hstack([points, np.ones((len(points), 1), points.dtype)]).astype(np.float64)
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    limit, size = COST * 0.5 / share, (points**2).sum(axis=1)
    weights, dual, order = np.zeros(points.shape[1]), np.zeros(len(points)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for at in order.permutation(len(points)):
            slope = signs[at] * (weights @ points[at]) - 1
            value = min(max(dual[at] - slope / size[at], 0.0), limit[at])
            if value != dual[at]:
                weights += (value - dual[at]) * signs[at] * points[at]
                dual[at] = value
    return weights


def families(means: np.ndarray) -> list[list[int]]:
    """Groups of languages: those with the nearest mean vectors are joined until few are left."""
    groups = [[place] for place in range(len(means))]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        centre = [means[group].mean(axis=0) for group in groups]
        one, other = min(combinations(range(len(groups)), 2), key=lambda pair: np.linalg.norm(centre[pair[0]] - centre[pair[1]]))
        groups[one] = sorted(groups[one] + groups[other])
        del groups[other]
    return groups


@dataclass
class LanguageTree:
    languages: list[str]
    families: list[list[int]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[int, int], np.ndarray]

    def predict(self, vector: np.ndarray) -> tuple[str, float]:
        """The language and a score: the smaller of the chances of the family and of the closest pair won."""
        if not self.languages:
            return UNDETERMINED, 0.0
        point, sure = np.append(vector, 1.0), np.inf
        family = self.families[0]
        if len(self.families) > 1:
            margins = self.family_weights @ point
            best = int(np.argmax(margins))
            family = self.families[best]
            sure = (margins[best] - np.delete(margins, best).max()) / 2
        if len(family) == 1:
            return self.languages[family[0]], chance(sure)
        won, sums = dict.fromkeys(family, 0), dict.fromkeys(family, 0.0)
        against = {}
        for one, other in combinations(family, 2):
            margin = float(self.pair_weights[one, other] @ point)
            won[one if margin >= 0 else other] += 1
            sums[one] += margin
            sums[other] -= margin
            against[one, other], against[other, one] = margin, -margin
        best = max(family, key=lambda place: (won[place], sums[place]))
        return self.languages[best], chance(min(sure, *(against[best, other] for other in family if other != best)))


def chance(margin: float) -> float:
    return 1.0 if margin == np.inf else float(1 / (1 + np.exp(-STEEPNESS * np.clip(margin, -50, 50))))


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(text).tobytes() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["lang", "vector"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageTree:
    """Train on a bounded sample of the labelled rows."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'")
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE).collect()}
    if not sizes:
        return LanguageTree([], [], np.empty((0, 0)), {})
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(sizes)))
    # A hash below this share of its range leaves about as many rows as wanted.
    bound = F.element_at(F.create_map(*(F.lit(x) for lang, size in sizes.items() for x in (lang, min(1.0, each / size)))), F.col("lang"))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(place < bound).select("lang", "text").limit(2 * SAMPLE).mapInArrow(feature_batches, "lang string, vector binary").collect()
    picked.sort(key=lambda row: (row["lang"], bytes(row["vector"])))
    points = np.stack([np.frombuffer(row["vector"], "<f4") for row in picked])
    labels = np.array([row["lang"] for row in picked])
    languages = sorted(set(labels.tolist()))
    of = np.array([languages.index(label) for label in labels])
    groups = families(np.stack([points[of == place].mean(axis=0) for place in range(len(languages))]))
    group_of = np.array([next(at for at, group in enumerate(groups) if place in group) for place in range(len(languages))])[of]
    family_weights = [support_vector_machine(points, np.where(group_of == at, 1.0, -1.0)) for at in range(len(groups))] if len(groups) > 1 else []
    pair_weights = {}
    for group in groups:
        for one, other in combinations(group, 2):
            both = (of == one) | (of == other)
            pair_weights[one, other] = support_vector_machine(points[both], np.where(of[both] == one, 1.0, -1.0))
    return LanguageTree(languages, groups, np.array(family_weights), pair_weights)


def with_language(docs: DataFrame, tree: LanguageTree, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """The frame with the two columns added, from the whole text; columns of these names are replaced."""
    others = [name for name in docs.columns if name.lower() not in (lang_name.lower(), score_name.lower())]
    given = docs.select(F.col(text_col).cast("string").alias(free_name(docs, "text_read")), *(F.col(f"`{name}`") for name in others))
    fields = given.schema.fields[1:]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                tree.predict(features(text)) if text and has_letter(text) else (UNDETERMINED, 0.0) for text in batch.column(0).to_pylist()
            ]
            columns = [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=names)

    small_batches(docs.sparkSession)
    schema = StructType([*fields, StructField(lang_name, StringType()), StructField(score_name, DoubleType())])
    names = schema.names
    return given.toDF(*(f"c{at}" for at in range(len(fields) + 1))).mapInArrow(predicted, schema)


def drop_undetermined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that have a language, which replaces their label; learned from the rows that are not held out."""
    tree = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    named = with_language(docs, tree, text_col, lang, score).where(F.col(lang) != UNDETERMINED)
    return named.select(*(F.col(lang).alias(name) if name == lang_col else F.col(f"`{name}`") for name in docs.columns))


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether the id's checksum has the remainder of the held-out fold; a null id has not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("bigint").cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out; predict all rows: doc_id, held_out, lang_pred, score."""
    tree = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    return with_language(chosen, tree).select("doc_id", "held_out", "lang_pred", "score")
