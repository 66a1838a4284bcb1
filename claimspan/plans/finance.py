"""Premium, payout, cost and trend reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspan.functions.measures import growth_pct, previous_year, totals
from claimspan.functions.numeric import banded, mean, ratio
from claimspan.model import ClaimsModel
from claimspan.operators.groups import null_safe_join
from claimspan.operators.ordered import MAX_GROUP_ROWS, exact_percentiles, percentile_sketch, sketched_brackets
from claimspan.plans import fixed, top
from claimspan.schema import REJECTED
from claimspan.sources.scratch import written


def loss_ratio_by_insurer_quarter(
    m: ClaimsModel,
    policies_per_plan: int = 50,
    bands: tuple[tuple[float, str], ...] = fixed.LOSS_BANDS,
    otherwise: str = fixed.LOSS_OTHERWISE,
) -> DataFrame:
    """Claims paid against an estimate of the premium earned, per insurer and quarter."""
    quarters = totals(
        m,
        ["insurer", "year", "quarter"],
        ["claim_count", "claimed", "approved", "rejected_count"],
    )
    premium = m.policies.groupBy("insurer").agg(
        F.call_function("div", F.sum("annual_premium") * policies_per_plan, F.lit(4)).alias(
            "estimated_quarterly_premium"
        )
    )
    paid, earned = F.col("approved"), F.col("estimated_quarterly_premium")
    exact_pct = paid * 100 / F.nullif(earned, F.lit(0))
    return (
        quarters.join(premium, "insurer")
        .select(
            "insurer",
            "year",
            "quarter",
            F.col("claim_count").alias("total_claims"),
            F.col("claimed").alias("gross_claims"),
            paid.alias("net_claims_paid"),
            "estimated_quarterly_premium",
            ratio(paid, earned).alias("loss_ratio_pct"),
            banded(exact_pct, list(bands), otherwise).alias("profitability_status"),
            ratio("rejected_count", "claim_count").alias("rejection_rate_pct"),
        )
        .orderBy("insurer", "year", "quarter")
    )


def rejection_root_cause(m: ClaimsModel, limit: int | None = 30) -> DataFrame:
    """Rejections per insurer and reason, with the diagnoses and states they hit."""
    # One row per patient and cause before the patient table is joined, then
    # one per state: the lists are built from combined rows only.
    rejected = (
        m.claims.where(F.col("status") == REJECTED)
        .join(m.policies.select("policy_id", "insurer"), "policy_id")
        .groupBy("insurer", "rejection_reason", "diagnosis_name", "patient_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("claim_amount").alias("value"),
            F.count("claim_amount").alias("valued"),
        )
    )
    causes = (
        rejected.join(m.patients.select("patient_id", "state"), "patient_id")
        .groupBy("insurer", "rejection_reason", "diagnosis_name", "state")
        .agg(F.sum("n").alias("n"), F.sum("value").alias("value"), F.sum("valued").alias("valued"))
    )

    def listed(column: str):
        return F.array_join(F.array_sort(F.collect_set(column)), ", ")

    out = causes.groupBy("insurer", "rejection_reason").agg(
        F.sum("n").alias("total_rejections"),
        F.sum("value").alias("total_value_rejected"),
        mean(F.sum("value"), F.sum("valued"), 0).alias("avg_amount_per_rejection"),
        listed("diagnosis_name").alias("diagnoses_affected"),
        listed("state").alias("states_affected"),
    )
    order = [F.col("total_rejections").desc(), F.col("insurer").asc(), F.col("rejection_reason").asc()]
    return top(out, order, limit)


def state_access_cost(m: ClaimsModel) -> DataFrame:
    """Volumes, cost and care quality per patient state."""
    sums = {
        "n": F.count(F.lit(1)),
        "claimed": F.sum("claim_amount"),
        "valued": F.count("claim_amount"),
        "approved": F.sum("approved_amount"),
        "days": F.sum("settlement_days"),
        "settled": F.count("settlement_days"),
        "emergencies": F.sum("is_emergency"),
        "readmissions": F.sum("is_readmission"),
        "approvals": F.count_if(F.col("status") == "Approved"),
    }
    # Claims are added up per patient and hospital; both distinct counts are then counts of
    # combined rows, without a copy of the rows for each of them.
    pairs = (
        m.claims.groupBy("patient_id", "provider_id")
        .agg(*[e.alias(n) for n, e in sums.items()])
        .join(m.patients.select("patient_id", "state"), "patient_id")
        .join(m.providers.select("provider_id"), "provider_id", "left_semi")
    )
    hospitals = pairs.groupBy("state", "provider_id").agg(*[F.sum(n).alias(n) for n in sums])
    states = hospitals.groupBy("state").agg(F.count(F.lit(1)).alias("hospitals_used"), *[F.sum(n).alias(n) for n in sums])
    patients = pairs.select("state", "patient_id").distinct().groupBy("state").agg(F.count(F.lit(1)).alias("total_patients"))
    states = null_safe_join(states, patients, ["state"])
    return states.select(
        "state",
        "total_patients",
        "hospitals_used",
        F.col("n").alias("total_claims"),
        F.col("claimed").alias("total_claimed"),
        F.col("approved").alias("total_approved"),
        mean("claimed", "valued", 0).alias("avg_claim_amount"),
        mean("days", "settled", 1).alias("avg_settlement_days"),
        ratio("emergencies", "n").alias("emergency_pct"),
        ratio("readmissions", "n").alias("readmission_pct"),
        ratio("approvals", "n").alias("approval_rate_pct"),
        mean("claimed", "total_patients", 0).alias("claim_per_patient"),
    ).orderBy(F.col("total_claimed").desc_nulls_first(), F.col("state").asc_nulls_last())


def diagnosis_cost_benchmark(
    m: ClaimsModel, max_group_rows: int = MAX_GROUP_ROWS, slices: int | None = None
) -> DataFrame:
    """Cost distribution per diagnosis, with exact percentiles.

    Claims are read twice: for the aggregate with a sketch of the amounts, and
    for the values that the sketch leaves in question.
    """
    keys = ["diagnosis_code", "diagnosis_name"]
    main = m.claims.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_cases"),
        mean(F.sum("claim_amount"), F.count("claim_amount"), 0).alias("avg_cost"),
        F.min("claim_amount").alias("min_cost"),
        F.max("claim_amount").alias("max_cost"),
        F.round(F.stddev_samp("claim_amount"), 0).alias("stddev_cost"),
        mean(F.sum("approved_amount"), F.count("approved_amount"), 0).alias("avg_approved"),
        F.sum("approved_amount").alias("_approved"),
        F.count("approved_amount").alias("_approved_n"),
        F.sum("claim_amount").alias("_claimed"),
        F.count("claim_amount").alias("_claimed_n"),
        mean(F.sum("length_of_stay"), F.count("length_of_stay"), 1).alias("avg_los"),
        percentile_sketch("claim_amount").alias("_sketch"),
    )
    main = written(main, "diagnosis-costs")
    fractions = {"p25_cost": 0.25, "median_cost": 0.50, "p75_cost": 0.75, "p95_cost": 0.95}
    brackets = sketched_brackets(main, keys, "_sketch", fractions)
    spread = exact_percentiles(m.claims, keys, "claim_amount", fractions, max_group_rows, slices, brackets=brackets)
    # Mean approved over mean claimed; the same rows stand under both means
    # unless an amount is missing.
    approved_pct = F.when(
        F.col("_approved_n") == F.col("_claimed_n"), ratio("_approved", "_claimed")
    ).otherwise(
        F.round(
            mean("_approved", "_approved_n") * 100 / F.nullif(mean("_claimed", "_claimed_n"), F.lit(0.0)),
            2,
        )
    )
    return (
        null_safe_join(main, spread, keys, "left")
        .select(
            *keys,
            "total_cases",
            "avg_cost",
            "min_cost",
            "max_cost",
            "stddev_cost",
            *[F.round(name, 0).alias(name) for name in fractions],
            "avg_approved",
            approved_pct.alias("avg_approval_pct"),
            "avg_los",
        )
        .orderBy(F.col("total_cases").desc(), *keys)
    )


def insurer_scorecard(
    m: ClaimsModel,
    grade_a: tuple[float, float] = fixed.GRADE_A,
    grade_b: tuple[float, float] = fixed.GRADE_B,
    grade_d: float = fixed.GRADE_D,
) -> DataFrame:
    """Volumes, payout, rates and a grade per insurer.

    A: approval above 60 % and under 30 days; B: above 50 % and under 45 days;
    D: rejection above 20 %; C: the rest. The first that fits counts.
    """
    t = totals(m, ["insurer"], count_patients=True)
    n, days = F.col("claim_count"), mean("settlement_total", "settled_count")
    approved, rejected = F.col("approved_count") * 100 / n, F.col("rejected_count") * 100 / n
    grade = (
        F.when((approved > grade_a[0]) & (days < grade_a[1]), fixed.GRADE_A_LABEL)
        .when((approved > grade_b[0]) & (days < grade_b[1]), fixed.GRADE_B_LABEL)
        .when(rejected > grade_d, fixed.GRADE_D_LABEL)
        .otherwise(fixed.GRADE_C_LABEL)
    )
    return t.select(
        "insurer",
        n.alias("total_claims"),
        F.col("unique_patients"),
        F.col("claimed").alias("gross_claims_value"),
        F.col("approved").alias("total_paid_out"),
        ratio("approved", "claimed").alias("payout_ratio_pct"),
        mean("settlement_total", "settled_count", 1).alias("avg_settlement_days"),
        ratio("approved_count", n).alias("approval_rate"),
        ratio("rejected_count", n).alias("rejection_rate"),
        ratio("emergency_count", n).alias("emergency_claim_pct"),
        ratio("readmission_count", n).alias("readmission_pct"),
        grade.alias("overall_grade"),
    ).orderBy(F.col("approval_rate").desc(), "insurer")


CUBE_KEYS = [
    "year",
    "month",
    "month_name",
    "insurer",
    "hospital_tier",
    "treatment_type",
    "diagnosis_name",
    "state",
]


def monthly_trend_cube(m: ClaimsModel) -> DataFrame:
    """Eleven measures at the finest grain a dashboard slices by."""
    t = totals(m, CUBE_KEYS, count_patients=True)
    return t.select(
        *CUBE_KEYS,
        "claim_count",
        "unique_patients",
        F.col("claimed").alias("gross_claims"),
        F.col("approved").alias("net_paid"),
        mean("claimed", "claimed_count").alias("avg_claim"),
        "approved_count",
        "rejected_count",
        mean("settlement_total", "settled_count").alias("avg_settlement_days"),
        mean("stay_total", "stay_count").alias("avg_los"),
        "emergency_count",
        "readmission_count",
    ).orderBy(*CUBE_KEYS)


def insurer_moving_average(m: ClaimsModel, months: int = 3) -> DataFrame:
    """Monthly claim amounts per insurer with trailing means over ``months`` rows.

    Rows, not calendar months: a month without claims is skipped, not zero.
    """
    monthly = totals(m, ["insurer", "year", "month"], ["claimed", "claimed_count"])
    w = Window.partitionBy("insurer").orderBy("year", "month").rowsBetween(1 - months, 0)
    return monthly.select(
        "insurer",
        "year",
        "month",
        F.col("claimed").alias("total_claim_amount"),
        mean(F.sum("claimed").over(w), F.count("claimed").over(w), 0).alias("moving_avg_3month"),
        F.round(F.avg(mean("claimed", "claimed_count")).over(w), 0).alias("moving_avg_per_claim"),
    ).orderBy("insurer", "year", "month")


def insurer_yoy_growth(m: ClaimsModel, lead: bool = False) -> DataFrame:
    """Yearly claims and amounts per insurer against the previous year.

    ``lead=True`` adds the next year's figures instead of growth.
    """
    yearly = totals(m, ["insurer", "year"], ["claim_count", "claimed"]).select(
        "insurer", "year", F.col("claim_count").alias("claims"), F.col("claimed").alias("amount")
    )
    shifted = previous_year(yearly, ["insurer"], ["claims", "amount"], lead=lead)
    columns = [
        "insurer",
        "year",
        F.col("claims").alias("total_claims"),
        F.col("amount").alias("total_amount"),
    ]
    if lead:
        columns += [
            F.col("next_claims").alias("next_year_claims"),
            F.col("next_amount").alias("next_year_amount"),
        ]
    else:
        columns += [
            F.col("prev_claims").alias("prev_year_claims"),
            F.col("prev_amount").alias("prev_year_amount"),
            growth_pct("claims", "prev_claims").alias("yoy_claims_growth_pct"),
            growth_pct("amount", "prev_amount").alias("yoy_amount_growth_pct"),
        ]
    return shifted.select(*columns).orderBy("insurer", "year")
