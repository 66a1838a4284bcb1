"""Top patients per state and settlement percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspan.functions.numeric import mean, ratio
from claimspan.model import ClaimsModel
from claimspan.operators.groups import null_safe_join
from claimspan.sources.scratch import written


def top_patients_by_state(m: ClaimsModel, k: int = 5) -> DataFrame:
    """The ``k`` patients with the highest claims of each state."""
    who = m.patients.select("patient_id", "age", "gender", "state", "chronic_condition")
    per_patient = (
        m.claims.groupBy("patient_id")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum("claim_amount").alias("total_claimed"),
            F.sum("approved_amount").alias("total_approved"),
        )
        .join(who, "patient_id")
        .select(*who.columns, "claim_count", "total_claimed", "total_approved")
    )
    # Used twice below; stored so that the fact is read once.
    patients = written(per_patient, "patient-totals")
    states = patients.groupBy("state").agg(
        F.sum("total_claimed").alias("_state_total"), F.count("total_claimed").alias("_state_patients")
    )
    # A rank with a bound is cut down in every task before the shuffle, so a
    # large state sends at most k rows per task.
    w = Window.partitionBy("state").orderBy(
        F.col("total_claimed").desc_nulls_first(), F.col("patient_id").asc()
    )
    best = patients.withColumn("state_rank", F.row_number().over(w)).where(F.col("state_rank") <= k)
    return (
        null_safe_join(best, states, ["state"])
        .select(
            *patients.columns,
            "state_rank",
            ratio("total_claimed", "_state_total").alias("pct_of_state_claims"),
            mean("_state_total", "_state_patients", 0).alias("state_avg_claim"),
        )
        .orderBy("state", "state_rank")
    )


def settlement_percentile(m: ClaimsModel) -> DataFrame:
    """Each settled claim's percentile by settlement days within its insurer.

    The rank depends on the days alone, so it is found on counts per insurer
    and number of days and joined back: no insurer's claims are gathered in one
    task, and a window holds no more rows than there are numbers of days. Equal
    days share a rank, (claims with fewer days) / (claims - 1), or 0 for one claim.
    """
    settled = (
        m.claims.where(F.col("settlement_days").isNotNull())
        .join(m.policies.select("policy_id", "insurer"), "policy_id")
        .select("insurer", "claim_id", "settlement_days")
    )
    days, n = F.col("settlement_days"), F.col("n")
    counts = settled.groupBy("insurer", "settlement_days").agg(F.count(F.lit(1)).alias("n"))
    all_of = Window.partitionBy("insurer")
    below = F.sum("n").over(all_of.orderBy("settlement_days").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - n
    total = F.sum("n").over(all_of)
    lookup = written(  # stored, so that its size is known and claims are not shuffled for it
        counts.select(
            "insurer",
            "settlement_days",
            F.when(total > 1, below / (total - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
            mean(F.sum(days * n).over(all_of), total, 1).alias("insurer_avg_days"),
            F.min(days).over(all_of).alias("insurer_min_days"),
            F.max(days).over(all_of).alias("insurer_max_days"),
        ),
        "settlement-ranks",
    )
    return (
        null_safe_join(settled, lookup, ["insurer", "settlement_days"])
        .select(
            "insurer",
            "claim_id",
            "settlement_days",
            F.round("percent_rank", 4).alias("percentile_rank"),
            "insurer_avg_days",
            "insurer_min_days",
            "insurer_max_days",
        )
        .orderBy("insurer", "settlement_days", "claim_id")
    )
