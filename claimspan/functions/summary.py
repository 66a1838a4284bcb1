"""A stored summary that measures and datasets are answered from, and distinct patients that roll up.

A summary holds the additive totals of ``functions.measures`` per combination of its
keys. Each load or batch adds its own part; parts are summed when read, so nothing
is rewritten. A model that carries a summary (``ClaimsModel.summary``) answers every
total whose keys the summary has without reading the fact.

Each dimension that a key comes from has a flag, whether the claims of a cell found
their row in it: a total by insurer counts claims of unknown hospitals, and one by
hospital tier does not, as on the fact.

Distinct patients are not additive. A cell keeps a sketch of its patients, which can
be merged over any keys (standard error ``PATIENT_ERROR``). Where patients have dense
numbers, ``patient_bitmaps`` are exact and can be merged as well; they take 4 KB per
cell and 32,768 numbers, which suits coarse keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspan.functions.measures import TOTALLED, additive_totals, flag_of, with_attributes
from claimspan.model import ATTRIBUTES, ClaimsModel
from claimspan.operators.groups import rows_within
from claimspan.sources.scratch import shuffles_freed, written

_LG_K = 14
#: Standard error of ``approximate_patients``, as a share of the count.
PATIENT_ERROR = 1.04 / 2 ** (_LG_K / 2)
SKETCH = "patients_sketch"
#: A dimension of at most so many rows is broadcast (its keys and one number each); claims are shuffled to larger ones.
FEW_ROWS = 500_000

SUMMARY_KEYS = ["year", "quarter", "month", "month_name", "insurer", "plan_type", "hospital_tier", "treatment_type", "diagnosis_name", "state"]


def _coded(dim: DataFrame, key: str, names: list[str], code: str) -> tuple[DataFrame, DataFrame]:
    """(``key``, ``code``) of a dimension, and ``code`` with the attributes it stands for.

    Rows with the same attributes have the same number. The numbers are stored, so that both tables hold the same ones.
    """
    dim = dim.select(key, *[F.col(ATTRIBUTES[a][2]).alias(a) for a in names])
    values = written(dim.select(*names).distinct().withColumn(code, F.monotonically_increasing_id()), "codes")
    # Values have several columns, so fewer of them are broadcast than of keys.
    few = rows_within(values, FEW_ROWS // 10)
    found = values.withColumnsRenamed({a: f"_of_{a}" for a in names}).hint("broadcast" if few else "merge")
    equal = reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(f"_of_{a}")) for a in names])
    return dim.join(found, equal).select(key, code), values


def summarise(
    m: ClaimsModel, keys: list[str] = SUMMARY_KEYS, store: Callable[[DataFrame, str], DataFrame] = written
) -> DataFrame:
    """The summary of a model's claims: one row per combination of ``keys`` and flags.

    With many keys there are almost as many cells as claims, so claims are added up once, and
    until then a claim carries one number per dimension in place of the attributes: a claim
    whose row is not found has none, which is what the flags say.

    Claims are shuffled once per dimension of more than ``FEW_ROWS`` rows. Between two of
    those, what is still needed of a claim goes through ``store``, so the shuffle files of one are gone
    before the next one writes its own.
    """
    claims, values, fields = m.claims, {}, {}
    for a in keys:
        if a in ATTRIBUTES:
            fields.setdefault(ATTRIBUTES[a][:2], []).append(a)
    own = [a for a in keys if a not in ATTRIBUTES]
    large = {f for f, key in fields if not rows_within(getattr(m, f).select(key), FEW_ROWS)}
    # Small dimensions first: their numbers are shorter than their keys. Patients come last, theirs is the largest.
    order = sorted(fields.items(), key=lambda f: (f[0][0] in large, f[0][0] == "patients"))
    shuffled = False
    for at, ((field, key), names) in enumerate(order):
        if shuffled:
            left = [k for (_, k), _ in order[at:]]
            claims = store(claims.select(*dict.fromkeys([*own, *left, "patient_id", *TOTALLED, *[f"_{f}" for f in values]])), "coded-claims")
        coded, values[field] = _coded(getattr(m, field), key, names, f"_{field}")
        claims = claims.join(coded.hint("merge" if field in large else "broadcast"), key, "left")
        shuffled = field in large
    cells = claims.groupBy(*[f"_{f}" for f in values], *own).agg(
        *[e.alias(n) for n, e in additive_totals().items()], F.hll_sketch_agg("patient_id", F.lit(_LG_K)).alias(SKETCH)
    )
    for field, named in values.items():
        cells = cells.join(named, f"_{field}", "left")
    flags = [F.col(f"_{f}").isNotNull().alias(flag_of(f)) for f in values]
    return cells.select(*keys, *flags, *additive_totals(), SKETCH)


def add_part(summary: DataFrame, path: str, load: str) -> None:
    """Store the summary of one load or batch; the same load again replaces its part."""
    add_parts(summary.withColumn("load", F.lit(load)), path)


def add_parts(summary: DataFrame, path: str) -> None:
    """Store the summaries of several loads in one pass; the column ``load``, one of the keys, tells them apart."""
    with shuffles_freed(summary.sparkSession):
        (
            summary.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load")
            .parquet(path)
        )


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """All parts of a stored summary, for ``ClaimsModel.summary``."""
    return spark.read.parquet(path).drop("load")


def approximate_patients(summary: DataFrame, by: list[str]) -> DataFrame:
    """Distinct patients per combination of ``by`` from the cells' sketches, off by ``PATIENT_ERROR`` as a rule."""
    used = [flag_of(ATTRIBUTES[a][0]) for a in by if a in ATTRIBUTES]
    for flag in dict.fromkeys(used):
        summary = summary.where(flag)
    return summary.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("patients"))


def patient_bitmaps(m: ClaimsModel, by: list[str], number: Column) -> DataFrame:
    """(``by``, bucket, bitmap): the patients of each combination as bits; ``number`` is a patient's number, from 0."""
    claims = with_attributes(m, by).withColumn("_number", number).where("_number is not null")
    return claims.groupBy(*by, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bitmap")
    )


def exact_patients(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Distinct patients per combination of ``by``, some of the bitmaps' keys."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy(*by).agg(F.sum("n").alias("patients"))
