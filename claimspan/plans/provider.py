"""Hospital reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.functions.numeric import mean, ratio
from claimspan.model import ClaimsModel
from claimspan.operators.ranking import MAX_GLOBAL_ROWS, ranked_with_tiles
from claimspan.plans import fixed, top
from claimspan.schema import APPROVED, REJECTED
from claimspan.sources.scratch import written


def hospital_insurer_performance(
    m: ClaimsModel, min_claims: int = 10, limit: int | None = 30
) -> DataFrame:
    """Hospital and insurer pairs graded by rejections and settlement time."""
    pairs = (
        m.claims.join(m.policies.select("policy_id", "insurer"), "policy_id")
        .groupBy("provider_id", "insurer")
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.sum("claim_amount").alias("total_claimed"),
            F.sum("approved_amount").alias("total_approved"),
            F.count_if(F.col("status") == REJECTED).alias("rejected_count"),
            mean(F.sum("settlement_days"), F.count("settlement_days")).alias("avg_settlement_days"),
        )
        .where(F.col("total_claims") >= min_claims)
    )
    rate, days = F.col("rejection_rate"), F.col("avg_settlement_days")
    # Graded on the rounded rate, as the report shows it.
    poor, below, best = fixed.PAIR_POOR, fixed.PAIR_BELOW, fixed.PAIR_BEST
    grade = (
        F.when((rate > poor[0]) & (days > poor[1]), fixed.PAIR_POOR_LABEL)
        .when((rate > below[0]) | (days > below[1]), fixed.PAIR_BELOW_LABEL)
        .when((rate <= best[0]) & (days <= best[1]), fixed.PAIR_BEST_LABEL)
        .otherwise(fixed.PAIR_LABEL)
    )
    out = (
        pairs.join(m.providers.select("provider_id", "hospital_name", "tier"), "provider_id")
        .select(
            "provider_id",
            "hospital_name",
            "tier",
            "insurer",
            "total_claims",
            "total_claimed",
            "total_approved",
            "rejected_count",
            "avg_settlement_days",
            ratio("rejected_count", "total_claims").alias("rejection_rate"),
            ratio("total_approved", "total_claimed").alias("approval_value_pct"),
            mean("total_approved", "total_claims", 0).alias("avg_payout_per_claim"),
        )
        .withColumn("performance_grade", grade)
    )
    order = [rate.desc(), days.desc_nulls_first(), F.col("provider_id").asc(), F.col("insurer").asc()]
    return top(out, order, limit)


def hospital_approval_rank(
    m: ClaimsModel,
    min_claims: int = 50,
    limit: int | None = 20,
    dense: bool = True,
    max_rows: int = MAX_GLOBAL_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Hospitals ranked by approval rate, and their quartile."""
    hospitals = (
        m.claims.groupBy("provider_id")
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            F.count_if(F.col("status") == APPROVED).alias("approved_claims"),
        )
        .where(F.col("total_claims") >= min_claims)
        .join(m.providers.select("provider_id", "hospital_name", "tier", "accreditation"), "provider_id")
        .select(
            "provider_id",
            "hospital_name",
            "tier",
            "accreditation",
            "total_claims",
            "approved_claims",
            ratio("approved_claims", "total_claims").alias("approval_rate_pct"),
        )
    )
    ranked = ranked_with_tiles(
        written(hospitals, "hospitals"),
        "approval_rate_pct",
        "provider_id",
        "approval_rank",
        "performance_quartile",
        dense=dense,
        max_rows=max_rows,
        slices=slices,
    )
    return top(ranked, [F.col("approval_rank").asc(), F.col("provider_id").asc()], limit)
