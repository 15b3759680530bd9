"""A corpus made ready for training: five stages, each of them one of the operators.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again by the next one. All but the last return the columns of ``documents``:

1. language: documents without a language go, the others carry the one found;
2. near duplicates: one document of each group stays;
3. secrets: every span found is replaced by its kind, all documents stay;
4. mixing: documents are drawn by the probabilities that source, language and topic
   targets give them;
5. packing: token sequences for training.

The stages' modules say what nulls, empty texts, repeated rows and empty tables give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.common import stage, table
from llm.language_tree import drop_undetermined
from llm.raking import sample
from llm.secret_links import mask_secrets
from llm.sos_packing import pack
from llm.vector_join import first_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_undetermined(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs, length_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# The language machines, the draw and the token ids are not SQL; tests/llm holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
