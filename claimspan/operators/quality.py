"""Key, reference, null and value checks over a model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspan.model import ClaimsModel
from claimspan.schema import (
    FOREIGN_KEYS,
    MAX_LENGTHS,
    NOT_NULL,
    OPEN_STATUSES,
    PRIMARY_KEYS,
    REJECTED,
    REJECTION_REASONS,
    STATUSES,
    TIERS,
    TREATMENTS,
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys that are missing or occur more than once, with their row counts."""
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where((F.col("rows") > 1) | missing)


def key_summary(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: rows, distinct keys, rows without key and repeated keys."""
    parts = []
    for name, (df, key) in tables.items():
        missing = reduce(Column.__or__, [F.col(k).isNull() for k in key])
        counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            counts.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                F.count_if(~missing).alias("distinct_keys"),
                F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0)).alias("null_key_rows"),
                F.count_if(~missing & (F.col("rows") > 1)).alias("repeated_keys"),
            ).select(F.lit(name).alias("table"), "*")
        )
    return _union(parts)


def orphans(m: ClaimsModel, key: str) -> DataFrame:
    """Key values of the fact that have no dimension row, with claim counts.

    The fact is first reduced to one row per key value, so a frequent value
    costs the anti-join no more than a rare one. The values lie by key then, and the
    dimension's keys are brought to them: Spark's estimate of a column in compressed
    files is too low to broadcast millions of keys by.
    """
    dim = m.tables()[FOREIGN_KEYS[key]]
    used = (
        m.claims.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("claims"))
    )
    return used.join(dim.select(key).hint("merge"), key, "left_anti")


def reference_summary(m: ClaimsModel) -> DataFrame:
    """Per reference: orphan key values and the claims that carry them."""
    return _union(
        [
            orphans(m, key)
            .agg(
                F.count(F.lit(1)).alias("orphan_keys"),
                F.coalesce(F.sum("claims"), F.lit(0)).alias("orphan_claims"),
            )
            .select(F.lit(key).alias("reference"), "*")
            for key in FOREIGN_KEYS
        ]
    )


def _not_in(column: str, *known: object) -> Column:
    """Whether a value is none of the known ones; NULL is none of them."""
    return ~F.coalesce(F.col(column).isin(*known), F.lit(False))


def value_rules(table: str) -> dict[str, Column]:
    """Rule name -> condition that marks a row as breaking it."""
    rules = {f"{c} missing": F.col(c).isNull() for c in NOT_NULL[table]}
    for column, longest in MAX_LENGTHS[table].items():
        rules[f"{column} longer than {longest}"] = F.length(column) > longest
    if table == "fact_claims":
        rejected = F.coalesce(F.col("status") == REJECTED, F.lit(False))
        is_open = F.coalesce(F.col("status").isin(*OPEN_STATUSES), F.lit(False))
        rules |= {
            "status unknown": _not_in("status", *STATUSES),
            "treatment unknown": _not_in("treatment_type", *TREATMENTS),
            "reason unknown": F.col("rejection_reason").isNotNull() & _not_in("rejection_reason", *REJECTION_REASONS),
            "claimed amount negative": F.col("claim_amount") < 0,
            "approved amount negative": F.col("approved_amount") < 0,
            "settlement days negative": F.col("settlement_days") < 0,
            "reason without rejection": F.col("rejection_reason").isNotNull() & ~rejected,
            "rejection without reason": F.col("rejection_reason").isNull() & rejected,
            "open claim settled": F.col("settlement_days").isNotNull() & is_open,
            "closed claim unsettled": F.col("settlement_days").isNull() & ~is_open,
            "approved above claimed": F.col("approved_amount") > F.col("claim_amount"),
            "unpaid status with payment": (rejected | is_open) & (F.col("approved_amount") != 0),
            "emergency flag not 0 or 1": _not_in("is_emergency", 0, 1),
            "readmission flag not 0 or 1": _not_in("is_readmission", 0, 1),
        }
    if table == "dim_providers":
        rules["tier unknown"] = _not_in("tier", *TIERS)
    return rules


def value_violations(df: DataFrame, table: str, rules: dict[str, Column] | None = None) -> DataFrame:
    """(rule, violations) for every rule of the table, from a single pass."""
    rules = value_rules(table) if rules is None else rules
    counted = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def findings(m: ClaimsModel) -> DataFrame:
    """All checks as (check, table, rule, violations)."""
    tables = m.tables()
    keys = key_summary({t: (df, [PRIMARY_KEYS[t]]) for t, df in tables.items()})
    parts = [
        keys.select(
            F.lit("key").alias("check"),
            "table",
            F.lit("repeated key").alias("rule"),
            F.col("repeated_keys").alias("violations"),
        ),
        reference_summary(m).select(
            F.lit("reference").alias("check"),
            F.lit("fact_claims").alias("table"),
            F.col("reference").alias("rule"),
            F.col("orphan_claims").alias("violations"),
        ),
    ]
    for table, df in tables.items():
        parts.append(
            value_violations(df, table).select(
                F.lit("value").alias("check"), F.lit(table).alias("table"), "rule", "violations"
            )
        )
    return _union(parts)
