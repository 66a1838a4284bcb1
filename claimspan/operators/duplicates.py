"""Repeated keys found on hashes, so that only suspected keys are shuffled whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspan.operators.quality import key_violations
from claimspan.sources.scratch import written


def _missing(key: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in key])


def suspected_hashes(df: DataFrame, *key: str) -> DataFrame:
    """``h``: the 64-bit hashes that more than one row with a whole key has."""
    hashes = df.where(~_missing(key)).select(F.xxhash64(*key).alias("h"))
    return hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("h")


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """What ``quality.key_violations`` gives (keys that are missing or occur more than once, with
    their row counts), for tables whose keys are nearly all different.

    A first pass counts 64-bit hashes, which are all that is shuffled of a row, however
    long its key. The hashes met twice are stored; a second pass keeps the rows that have
    one (without a shuffle where they are few enough to broadcast, as Spark sees by
    their stored size) and counts those by the key itself, so two keys that share a
    hash are told apart. Rows without a whole key are combined before their shuffle,
    like those of a key that holds a third of the table. Columns that are not part of
    the key are not read.
    """
    suspects = written(suspected_hashes(df, *key), "suspects")
    held = df.select(F.struct(*key).alias("k"), _missing(key).alias("missing"), F.xxhash64(*key).alias("h"))
    twice = held.where(~F.col("missing")).join(suspects, "h", "left_semi")
    found = twice.select("k").unionAll(held.where("missing").select("k"))
    return key_violations(found.select("k.*"), *key)
