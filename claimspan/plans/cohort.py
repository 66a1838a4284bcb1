"""Retention, running totals and first and last claims of patients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.functions.numeric import mean, quarter_label
from claimspan.model import ClaimsModel
from claimspan.operators.groups import MAX_GROUP_ROWS
from claimspan.operators.timeline import running_totals
from claimspan.plans import fixed, top


def cohort_retention(m: ClaimsModel) -> DataFrame:
    """Activity per signup quarter and calendar quarter."""
    # A patient is one row per quarter after this, so counting rows counts patients.
    per_patient = (
        m.dated_claims("year", "quarter")
        .groupBy("patient_id", "year", "quarter")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("claim_amount").alias("claimed"),
            F.count("claim_amount").alias("valued"),
        )
    )
    signup = m.patients.select("patient_id", quarter_label("registration_date").alias("signup_cohort"))
    return (
        per_patient.join(signup, "patient_id")
        .groupBy(
            "signup_cohort",
            F.col("year").alias("activity_year"),
            F.col("quarter").alias("activity_quarter"),
        )
        .agg(
            F.count(F.lit(1)).alias("active_patients"),
            F.sum("n").alias("total_claims"),
            F.sum("claimed").alias("total_claimed"),
            mean(F.sum("claimed"), F.sum("valued"), 0).alias("avg_claim"),
            mean(F.sum("claimed"), F.count(F.lit(1)), 0).alias("revenue_per_active_patient"),
        )
        .orderBy("signup_cohort", "activity_year", "activity_quarter")
    )


def patient_running_total(
    m: ClaimsModel,
    patients: Sequence[str] | None = fixed.DEFAULT_PATIENTS,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Running amount and count of each chosen patient (``None``: all)."""
    claims = m.claims
    if patients is not None:
        claims = claims.where(F.col("patient_id").isin(*patients))
    dated = claims.join(m.dates.select("date_key", "full_date"), "date_key").select(
        "claim_id", "patient_id", "full_date", "claim_amount"
    )
    totals = running_totals(
        dated, "patient_id", "full_date", "claim_id", "claim_amount", max_group_rows, slices
    )
    return totals.withColumnsRenamed(
        {"running_total": "running_total_claims", "cumulative_count": "cumulative_claim_count"}
    ).orderBy("patient_id", "full_date", "claim_id")


def first_last_claim(m: ClaimsModel, limit: int | None = 50) -> DataFrame:
    """First and latest claim of the patients with most claims."""
    claims = m.claims
    order = [F.col("total_claims").desc(), F.col("patient_id").asc_nulls_last()]
    if limit is not None:
        # Counting is cheap; the ends are looked up for the kept patients only.
        counts = claims.join(m.dates.select("date_key"), "date_key").groupBy("patient_id").agg(
            F.count(F.lit(1)).alias("total_claims")
        )
        kept = top(counts, order, limit).select(F.col("patient_id").alias("_kept"))
        claims = claims.join(kept, F.col("patient_id").eqNullSafe(F.col("_kept")), "left_semi")
    dated = claims.join(m.dates.select("date_key", "full_date"), "date_key")
    place = F.struct("full_date", "claim_id")
    first = F.min_by(F.struct("claim_id", "full_date", "diagnosis_name", "claim_amount"), place)
    last = F.max_by(F.struct("claim_id", "full_date"), place)
    ends = dated.groupBy("patient_id").agg(
        first.alias("first"), last.alias("last"), F.count(F.lit(1)).alias("total_claims")
    )
    return ends.select(
        "patient_id",
        F.col("first.claim_id").alias("first_claim_id"),
        F.col("first.full_date").alias("first_claim_date"),
        F.col("first.diagnosis_name").alias("first_diagnosis"),
        F.col("first.claim_amount").alias("first_claim_amount"),
        F.col("last.claim_id").alias("latest_claim_id"),
        F.col("last.full_date").alias("latest_claim_date"),
        "total_claims",
    ).orderBy(*order)
