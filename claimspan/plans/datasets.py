"""The data behind each dashboard visual."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.functions.measures import (
    MEASURES,
    growth_pct,
    measure,
    moving_average,
    previous_year,
    running_total,
    share_of_total,
    share_within,
    status_label,
    totals,
    trend_arrow,
    year_to_date,
)
from claimspan.functions.numeric import mean, ratio
from claimspan.model import ClaimsModel
from claimspan.operators.groups import MAX_GROUP_ROWS
from claimspan.operators.ranking import MAX_GLOBAL_ROWS, ranked_with_tiles
from claimspan.plans import cohort, finance, fixed, fraud, risk
from claimspan.schema import APPROVED, STATUSES, TREATMENTS
from claimspan.sources.scratch import written

KPI_CARDS = [
    "total_claims",
    "total_claimed",
    "approved_value",
    "avg_claim",
    "approval_rate_pct",
    "payout_ratio_pct",
]


def kpi_summary(m: ClaimsModel, names: list[str] | None = None) -> DataFrame:
    """One row of headline figures."""
    return measure(m, names or KPI_CARDS)


def insurer_kpis(m: ClaimsModel) -> DataFrame:
    """Every measure per insurer, with its share of all claims and a status."""
    t = share_of_total(measure(m, list(MEASURES), ["insurer"]), "total_claims", "share_of_claims_pct")
    return t.withColumn("status", status_label("approval_rate_pct", 60, 50)).orderBy("insurer")


def plan_shares(m: ClaimsModel) -> DataFrame:
    """Claims per insurer and plan as shares of the insurer and of everything."""
    t = totals(m, ["insurer", "plan_type"], ["claim_count", "claimed"])
    t = share_within(t, ["insurer"], "claimed", "pct_within_insurer")
    return share_of_total(t, "claimed", "pct_of_total").orderBy("insurer", "plan_type")


def yearly_growth(m: ClaimsModel) -> DataFrame:
    """Claims and amounts per year, growth and its arrow."""
    t = totals(m, ["year"], ["claim_count", "claimed"])
    t = previous_year(t, [], ["claim_count", "claimed"])  # one row per year
    return t.select(
        "year",
        "claim_count",
        "claimed",
        growth_pct("claim_count", "prev_claim_count").alias("yoy_claims_pct"),
        growth_pct("claimed", "prev_claimed").alias("yoy_amount_pct"),
    ).withColumn("arrow", trend_arrow("yoy_claims_pct")).orderBy("year")


def monthly_time_measures(m: ClaimsModel) -> DataFrame:
    """Per insurer and month: year to date, running total and moving average."""
    t = totals(m, ["insurer", "year", "month"], ["claim_count", "claimed"])
    order = ["year", "month"]
    t = year_to_date(t, ["insurer"], "claim_count", "ytd_claims")
    t = running_total(t, ["insurer"], order, "claimed", "running_claimed")
    t = moving_average(t, ["insurer"], order, "claimed", "moving_avg_claimed")
    return t.orderBy("insurer", *order)


def rank_by(
    m: ClaimsModel,
    attribute: str,
    name: str,
    max_rows: int = MAX_GLOBAL_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Values of one attribute ranked by a measure, highest first."""
    t = written(measure(m, [name], [attribute]), "measured")
    ranked = ranked_with_tiles(
        t, name, attribute, "rank", "quartile", dense=False, max_rows=max_rows, slices=slices
    )
    return ranked.drop("quartile").orderBy("rank", attribute)


def monthly_trend(m: ClaimsModel, ahead: int = 3) -> DataFrame:
    """Claims per month with a straight line fitted through them, drawn
    ``ahead`` months further."""
    index = F.col("year") * 12 + F.col("month")
    t = written(
        totals(m, ["year", "month"], ["claim_count", "claimed"]).withColumn("month_index", index),
        "months",
    )
    line = t.agg(
        F.regr_slope("claimed", "month_index").alias("slope"),
        F.regr_intercept("claimed", "month_index").alias("base"),
        F.max("month_index").alias("last"),
    )
    months = F.explode(F.sequence(F.col("last") + 1, F.col("last") + ahead)).alias("month_index")
    future = line.select(months).select(
        F.floor((F.col("month_index") - 1) / 12).cast("int").alias("year"),
        ((F.col("month_index") - 1) % 12 + 1).cast("int").alias("month"),
        F.lit(None).cast("long").alias("claim_count"),
        F.lit(None).cast("long").alias("claimed"),
        F.col("month_index").cast("int"),
    )
    slope, base = line.select("slope").scalar(), line.select("base").scalar()
    return (
        t.unionByName(future)
        .select(
            "year",
            "month",
            "claim_count",
            "claimed",
            F.round(base + slope * F.col("month_index"), 0).alias("trend"),
            F.col("claimed").isNull().alias("is_forecast"),
        )
        .orderBy("year", "month")
    )


DRILL_KEYS = ["insurer", "treatment_type", "diagnosis_name"]


def decomposition(m: ClaimsModel, keys: list[str] | None = None) -> DataFrame:
    """Totals at every level of a drill-down path; ``level`` is its depth.

    The levels are built on totals per full path, so claims are read once and
    not repeated per level.
    """
    keys = keys or DRILL_KEYS
    leaves = totals(m, keys, ["claim_count", "claimed", "approved"])
    depth = sum((1 - F.grouping(k) for k in keys[1:]), 1 - F.grouping(keys[0]))
    return (
        leaves.rollup(*keys)
        .agg(
            F.sum("claim_count").alias("claim_count"),
            F.sum("claimed").alias("claimed"),
            F.sum("approved").alias("approved"),
            depth.cast("int").alias("level"),
        )
        .orderBy("level", *keys)
    )


def claim_size_histogram(m: ClaimsModel, width: int = 1_000_000, bins: int = 12) -> DataFrame:
    """Claims per amount bin; the last bin is open."""
    bin_no = F.least(
        F.call_function("div", F.col("claim_amount"), F.lit(width)), F.lit(bins - 1).cast("long")
    )
    return (
        m.claims.where(F.col("claim_amount").isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("claim_count"), F.sum("claim_amount").alias("claimed"))
        .select(
            "bin",
            (F.col("bin") * width).alias("from_amount"),
            F.when(F.col("bin") < bins - 1, (F.col("bin") + 1) * width).alias("below_amount"),
            "claim_count",
            "claimed",
        )
        .orderBy("bin")
    )


def rejection_shares(m: ClaimsModel) -> DataFrame:
    """Each reason's share of an insurer's rejections."""
    t = finance.rejection_root_cause(m, limit=None).select(
        "insurer", "rejection_reason", "total_rejections", "total_value_rejected"
    )
    t = share_within(t, ["insurer"], "total_rejections", "pct_of_rejections")
    return t.orderBy("insurer", "rejection_reason")


def hospital_matrix(m: ClaimsModel) -> DataFrame:
    """Claims per hospital and status, one column per status."""
    names = {s: s.lower().replace(" ", "_") for s in STATUSES}
    counts = m.claims.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("total_claims"),
        *[F.count_if(F.col("status") == s).alias(n) for s, n in names.items()],
    )
    return (
        counts.join(m.providers.select("provider_id", "hospital_name", "tier"), "provider_id")
        .select(
            "provider_id",
            "hospital_name",
            "tier",
            "total_claims",
            *names.values(),
            ratio("approved", "total_claims").alias("approval_rate_pct"),
        )
        .orderBy("provider_id")
    )


INFLUENCERS = ["insurer", "treatment_type", "diagnosis_name", "hospital_tier", "is_emergency",
               "is_readmission"]


def rejection_influencers(m: ClaimsModel, attributes: list[str] | None = None) -> DataFrame:
    """Rejection rate, lift and support of each value of each attribute.

    Lift is the rate over the rate of all claims; support is the share of claims.
    """
    attributes = attributes or INFLUENCERS
    # Stored: the overall rate is taken from the same combined rows.
    cells = written(totals(m, attributes, ["claim_count", "rejected_count"]), "influencer-cells")
    texts = cells.select(
        *[F.col(a).cast("string").alias(a) for a in attributes], "claim_count", "rejected_count"
    )
    values = (
        texts.unpivot(["claim_count", "rejected_count"], attributes, "attribute", "value")
        .groupBy("attribute", "value")
        .agg(F.sum("claim_count").alias("claims"), F.sum("rejected_count").alias("rejections"))
    )
    claims = cells.agg(F.sum("claim_count")).scalar()
    rejections = cells.agg(F.sum("rejected_count")).scalar()
    rate, overall = F.col("rejections") / F.col("claims"), rejections / F.nullif(claims, F.lit(0))
    return values.select(
        "attribute",
        "value",
        "claims",
        "rejections",
        ratio("rejections", "claims").alias("rejection_rate_pct"),
        F.round(rate / F.nullif(overall, F.lit(0.0)), 3).alias("lift"),
        ratio("claims", claims).alias("support_pct"),
    ).orderBy("attribute", "value")


def treatment_trend(m: ClaimsModel) -> DataFrame:
    """Claims per month, one column per treatment type."""
    t = totals(m, ["year", "month", "treatment_type"], ["claim_count"])
    names = {v: v.lower().replace(" ", "_") for v in TREATMENTS}
    return (
        t.groupBy("year", "month")
        .pivot("treatment_type", list(names))
        .agg(F.sum("claim_count"))
        .na.fill(0, list(names))
        .withColumnsRenamed(names)
        .orderBy("year", "month")
    )


def risk_distribution(m: ClaimsModel) -> DataFrame:
    """Patients and their claims per risk category."""
    t = risk.scored_patients(m).groupBy("risk_category").agg(
        F.count(F.lit(1)).alias("patients"),
        F.sum("total_claimed").alias("total_claimed"),
    )
    return share_within(t, [], "patients", "pct_of_patients").orderBy("risk_category")


def anomaly_scatter(m: ClaimsModel) -> DataFrame:
    """Every claim's amount and z-score."""
    return fraud.amount_zscores(m).select(
        "claim_id", "patient_id", "diagnosis_name", "claim_amount", "z_score"
    )


def high_frequency_claimants(m: ClaimsModel) -> DataFrame:
    """Per patient: frequent claims, their value and the busiest 90 days."""
    kept = fraud.frequent_claims(m).groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("flagged_claims"),
        F.sum("claim_amount").alias("flagged_amount"),
        F.max("claims_in_90_days").alias("most_in_90_days"),
        F.count_if(F.col("fraud_risk_level") == fixed.HIGH_RISK).alias("high_risk_claims"),
    )
    who = m.patients.select("patient_id", "age", "city", "chronic_condition")
    return kept.join(who, "patient_id").orderBy(F.col("most_in_90_days").desc(), "patient_id")


# Lower bounds of the age bands.
AGE_BANDS = ((75, "75+"), (60, "60-74"), (45, "45-59"), (30, "30-44"), (18, "18-29"))


def risk_heatmap(m: ClaimsModel) -> DataFrame:
    """Mean risk score and patients per age band and chronic condition."""
    age = F.col("age")
    band = None
    for lower, label in AGE_BANDS:
        band = F.when(age >= lower, label) if band is None else band.when(age >= lower, label)
    return (
        risk.scored_patients(m)
        .groupBy(band.otherwise("0-17").alias("age_band"), "chronic_condition")
        .agg(
            F.count(F.lit(1)).alias("patients"),
            mean(F.sum("risk_score"), F.count("risk_score"), 1).alias("avg_risk_score"),
        )
        .orderBy("age_band", "chronic_condition")
    )


def emergency_funnel(m: ClaimsModel) -> DataFrame:
    """Per hospital tier: all, emergency and approved emergency claims."""
    emergency = F.col("is_emergency") == 1
    counts = m.claims.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("all_claims"),
        F.count_if(emergency).alias("emergency"),
        F.count_if(emergency & (F.col("status") == APPROVED)).alias("approved_emergency"),
    )
    stages = ["all_claims", "emergency", "approved_emergency"]
    return (
        counts.join(m.providers.select("provider_id", F.col("tier").alias("hospital_tier")), "provider_id")
        .groupBy("hospital_tier")
        .agg(*[F.sum(s).alias(s) for s in stages])
        .select(
            "hospital_tier",
            *stages,
            ratio("emergency", "all_claims").alias("emergency_pct"),
            ratio("approved_emergency", "emergency").alias("approved_emergency_pct"),
        )
        .orderBy("hospital_tier")
    )


def patient_profile(m: ClaimsModel, patient_id: str | None = None) -> DataFrame:
    """Score, first and latest claim of one patient (``None``: everyone)."""
    if patient_id is not None:
        chosen = F.col("patient_id") == patient_id
        m = replace(m, claims=m.claims.where(chosen), patients=m.patients.where(chosen))
    ends = cohort.first_last_claim(m, limit=None).drop("total_claims")
    return risk.scored_patients(m).join(ends, "patient_id").orderBy("patient_id")


def patient_claims(
    m: ClaimsModel, patient_id: str, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """The claims of one patient in date order, with running totals."""
    totals_so_far = cohort.patient_running_total(m, [patient_id], max_group_rows).drop(
        "patient_id", "claim_amount"
    )
    claims = m.claims.where(F.col("patient_id") == patient_id)
    return (
        claims.join(totals_so_far, "claim_id")
        .join(m.providers.select("provider_id", "hospital_name"), "provider_id")
        .join(m.policies.select("policy_id", "insurer", "plan_type"), "policy_id")
        .orderBy("full_date", "claim_id")
    )


DATASETS: dict[str, Callable[[ClaimsModel], DataFrame]] = {
    "kpi_summary": kpi_summary,
    "insurer_kpis": insurer_kpis,
    "insurer_scorecard": finance.insurer_scorecard,
    "plan_shares": plan_shares,
    "yearly_growth": yearly_growth,
    "monthly_time_measures": monthly_time_measures,
    "monthly_trend": monthly_trend,
    "decomposition": decomposition,
    "geography": finance.state_access_cost,
    "claim_size_histogram": claim_size_histogram,
    "rejection_shares": rejection_shares,
    "hospital_matrix": hospital_matrix,
    "rejection_influencers": rejection_influencers,
    "treatment_trend": treatment_trend,
    "risk_distribution": risk_distribution,
    "anomaly_scatter": anomaly_scatter,
    "high_frequency_claimants": high_frequency_claimants,
    "risk_heatmap": risk_heatmap,
    "emergency_funnel": emergency_funnel,
    "patient_profile": patient_profile,
}


def build_datasets(m: ClaimsModel, target: str, names: list[str] | None = None) -> list[str]:
    """Write each dataset as Parquet under ``target``; returns the paths."""
    paths = []
    for name in names or list(DATASETS):
        path = f"{target}/{name}"
        DATASETS[name](m).write.mode("overwrite").parquet(path)
        paths.append(path)
    return paths
