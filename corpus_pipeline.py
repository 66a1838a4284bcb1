"""The corpus pipeline: clean, mix and shard ``documents`` with the operators of ``claimspan.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored
and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimspan.llm.common import Scratch, read
from claimspan.llm.decontaminate import clean
from claimspan.llm.interleave import interleave
from claimspan.llm.mixture import mixed_rows
from claimspan.llm.near_dup import one_of_each
from claimspan.llm.rank_order import with_language

#: SQL has no counterpart of the language, near-duplicate and mixing stages; tests hold them against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are in some language: those without a text or a letter, or with nothing of a learned one, go."""
    return with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose words are not copied from test items by a twentieth or more."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the shard and the slot they are written to."""
    return interleave(docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        name, stage = STAGES[-1]
        return scratch.table(stage(spark, docs, sf_dir), name, keep=True)
