"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell, a combination of source, language and topic. Raking
scales the cells' weights to the target of one margin after the other, again and
again, until all margins hold within ``TOLERANCE``. A document's wish is its cell's
weight per token; one factor for all turns wishes into probabilities of at most 1
that keep ``keep`` of the tokens as expected; a hash of the id decides.

Targets are a margin's shares: given, or the corpus's own shares to the power
``TEMPER``, so that a source with a third of all tokens gets less and rare languages
more. Cells are a table in Spark however many there are; only aggregates over all
cells reach the driver. Documents are not shuffled when the table of cells is small
enough for Spark to send it to them; otherwise they are joined by cell, and Spark splits large
cells.

Defined results: a null in a margin is a value of its own; a null text has no
tokens, and documents without tokens are kept with their cell's probability; a
target for a value that doesn't occur is left out, a value without target in a
given margin has share 0; repeated rows are decided alike; null ids by their text; an empty table
gives an empty result; other columns are kept by ``sample`` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import free_name, own_columns, stage

TEMPER = 0.7
KEEP = 0.6
TOLERANCE = 1e-4
ROUNDS = 30
SEED = 20240607
SCALES = 64
WORD = "[^\\x20\\x09-\\x0D]+"
MARGINS = ("source", "lang", "topic")


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """A coarse topic told by the form of the text."""
    return (
        F.when(text.isNull() | (F.length(text) == 0), "empty")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("```")) | F.contains(text, F.lit("();")), "code")
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("://")), "contact")
        .when(F.length(text) < 600, "note")
        .when(F.length(text) < 6000, "article")
        .otherwise("book")
    )


def targets(cells: DataFrame, margin: str, wanted: dict | None, temper: float = TEMPER) -> DataFrame:
    """(margin, target): the share each value is to have, of the values that occur with tokens."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    if wanted is None:
        share = F.pow(F.col("tokens").cast("double"), F.lit(temper))
    else:
        pairs = [F.lit(value) for pair in wanted.items() for value in pair]
        share = F.coalesce(F.element_at(F.create_map(*pairs), F.col(margin)), F.lit(0.0)).cast("double")
    total = sums.agg(F.sum(share)).first()[0] or 1.0
    return sums.select(margin, (share / total).alias("target"))


def gap(weighted: DataFrame, goal: dict[str, DataFrame], margins) -> float:
    """The largest difference between a value's share and its target."""
    found = None
    for margin in margins:
        sums = weighted.groupBy(margin).agg(F.sum("weight").alias("sum")).join(goal[margin], margin)
        off = sums.select(F.abs(F.col("sum") - F.col("target")).alias("off"))
        found = off if found is None else found.unionByName(off)
    return (found.agg(F.max("off")).first()[0] or 0.0) if found is not None else 0.0


def rake(cells: DataFrame, wanted: dict[str, dict] | None = None, margins=MARGINS, temper: float = TEMPER) -> DataFrame:
    """The cells with ``weight``, shares that add up to 1 and meet every margin's targets where they can."""
    goal = {margin: stage(targets(cells, margin, (wanted or {}).get(margin), temper), "targets") for margin in margins}
    weighted = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(ROUNDS):
        for margin in margins:
            sums = weighted.groupBy(margin).agg(F.sum("weight").alias("sum"))
            factor = sums.join(goal[margin], margin).select(
                margin, F.when(F.col("sum") > 0, F.col("target") / F.col("sum")).otherwise(0.0).alias("factor")
            )
            weighted = weighted.join(factor, margin).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        weighted = stage(weighted, "raked")
        if gap(weighted, goal, margins[:-1]) <= TOLERANCE:  # the last margin has just been met
            break
    return weighted


def probabilities(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """The cells with the probability of their documents: min(1, factor * weight / tokens).

    The factor that keeps ``keep`` of all tokens as expected is bracketed by one
    aggregate over a row of factors, then by another one between the two nearest.
    """
    wish = F.col("weight") / F.col("tokens")
    total, top, low = raked.agg(F.sum("tokens"), F.max(wish), F.min(F.when(F.col("weight") > 0, wish))).first()
    if not total or not top:
        return raked.withColumn("probability", F.lit(0.0))
    low, high = keep / top / 2, 1 / low
    for _ in range(3):
        steps = [low * (high / low) ** (step / (SCALES - 1)) for step in range(SCALES)]
        kept = raked.agg(*(F.sum(F.col("tokens") * F.least(F.lit(1.0), wish * step)).alias(f"k{at}") for at, step in enumerate(steps))).first()
        at = next((at for at in range(SCALES) if kept[at] >= keep * total), SCALES - 1)
        low, high = steps[max(at - 1, 0)], steps[at]
    return raked.withColumn("probability", F.least(F.lit(1.0), wish * high))


def with_cells(docs: DataFrame, name: str, text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """The frame with a struct ``name``: the margins as keys (null told from every text) and the document's tokens."""
    key = {margin: F.coalesce(F.concat(F.lit("="), F.col(margin).cast("string")), F.lit("null")) for margin in ("source", "lang")}
    key["topic"] = F.concat(F.lit("="), topic_of(F.col(text_col)) if topic is None else topic)
    cell = F.struct(*(key[margin].alias(margin) for margin in MARGINS), token_count(F.col(text_col)).alias("tokens"))
    return docs.select(*own_columns(docs), cell.alias(name))


def mix(docs: DataFrame, wanted: dict[str, dict] | None = None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", name: str = "mix") -> DataFrame:
    """The frame with a struct ``name``: the margins, tokens, weight per token, probability and whether the document is drawn.

    ``wanted`` maps a margin to shares per value, written ``=value`` or ``null``. A
    column that is already called ``name`` is replaced.
    """
    docs = docs.drop(name)
    chance = free_name(docs.withColumn(name, F.lit(0)), "chance")
    known = with_cells(docs, name, text_col)
    cells = known.groupBy(*(F.col(f"{name}.{margin}").alias(margin) for margin in MARGINS)).agg(F.sum(f"{name}.tokens").alias("tokens"))
    chances = stage(probabilities(rake(stage(cells, "cells"), wanted), keep), "chances")
    chances = chances.select(F.struct(*MARGINS, (F.col("weight") / F.col("tokens")).alias("weight"), "probability").alias(chance))
    same = [F.col(f"{name}.{margin}") == F.col(f"{chance}.{margin}") for margin in MARGINS]
    joined = known.join(chances, same[0] & same[1] & same[2], "left")
    # Cells without tokens hold no weight; their documents cost nothing and stay.
    probability = F.coalesce(F.col(f"{chance}.probability"), F.lit(1.0))
    identity = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.col(text_col)), F.lit(""))
    place = F.pmod(F.xxhash64(F.lit(SEED), identity), F.lit(1 << 52)) / float(1 << 52)
    drawn = F.struct(
        *(F.col(f"{name}.{field}").alias(field) for field in (*MARGINS, "tokens")), F.col(f"{chance}.weight").alias("weight"),
        probability.alias("probability"), (place < probability).alias("drawn"),
    )
    return joined.select(*own_columns(docs), drawn.alias(name))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents that are drawn, with their own columns."""
    name = free_name(docs, "mix")
    return mix(docs, name=name, **options).where(f"{name}.drawn").select(*own_columns(docs))
