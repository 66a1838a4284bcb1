"""Fraud and anomaly reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.functions.numeric import mean
from claimspan.model import ClaimsModel
from claimspan.operators.groups import MAX_GROUP_ROWS
from claimspan.operators.timeline import next_two, trailing_days
from claimspan.plans import fixed, top
from claimspan.sources.scratch import written


def frequent_claims(
    m: ClaimsModel,
    days: int = fixed.FREQUENT_DAYS,
    medium: int = fixed.FREQUENT_MEDIUM,
    high: int = fixed.FREQUENT_HIGH,
    of_patient: tuple[str, ...] = (),
) -> DataFrame:
    """Claims that have at least ``medium`` claims of their patient in the
    trailing ``days`` days, themselves included.

    All claims of a patient count, those without a known hospital too. Claims
    without a patient are nobody's. ``of_patient`` names columns of the patient to
    add; they are joined to patients' days, not to claims.
    """
    timeline = (
        m.dated_claims("full_date")
        .where(F.col("patient_id").isNotNull())
        .withColumnRenamed("full_date", "claim_date")
    )
    n = F.col("claims_in_90_days")
    # Only patients' days with enough claims meet the claims again.
    frequent = (
        trailing_days(timeline.select("patient_id", "claim_date"), "patient_id", "claim_date", days, "claims_in_90_days")
        .where(n >= medium)
        .join(m.patients.select("patient_id", *of_patient), "patient_id", "inner" if of_patient else "left_semi")
    )
    return (
        timeline.select("patient_id", "claim_id", "claim_date", "claim_amount", "diagnosis_name", "provider_id")
        .join(frequent, ["patient_id", "claim_date"])
        .select("patient_id", "claim_id", "claim_date", "claim_amount", "diagnosis_name", "provider_id", "claims_in_90_days", *of_patient)
        .withColumn("fraud_risk_level", F.when(n >= high, fixed.HIGH_RISK).otherwise(fixed.MEDIUM_RISK))
    )


def fraud_frequency_90d(
    m: ClaimsModel,
    days: int = fixed.FREQUENT_DAYS,
    medium: int = fixed.FREQUENT_MEDIUM,
    high: int = fixed.FREQUENT_HIGH,
    limit: int | None = 100,
) -> DataFrame:
    """The most frequent claimants' claims, with patient and hospital."""
    order = [
        F.col("claims_in_90_days").desc(),
        F.col("claim_amount").desc_nulls_first(),
        F.col("claim_id").asc(),
    ]
    described = ("age", "city", "chronic_condition")
    hospitals = m.providers.select("provider_id", "hospital_name")
    if limit is None:  # every claim is kept, so it meets each dimension once
        every = frequent_claims(m, days, medium, high, described).join(hospitals, "provider_id")
        kept = [c for c in every.columns if c not in (*described, "hospital_name")]
        return every.select(*kept, *described, "hospital_name").orderBy(*order)
    # Claims of unknown hospitals count, but have no place in the report: they
    # go before the cut, on the map side. Only the kept claims are described.
    known = frequent_claims(m, days, medium, high).join(m.providers.select("provider_id"), "provider_id", "left_semi")
    kept = top(known, order, limit)
    return (
        kept.join(m.patients.select("patient_id", *described), "patient_id")
        .join(hospitals, "provider_id")
        .select(*kept.columns, *described, "hospital_name")
        .orderBy(*order)
    )


def amount_zscores(m: ClaimsModel) -> DataFrame:
    """Every claim with its z-score within its diagnosis code.

    Statistics are per code alone, so a code with two names does not double
    its claims.
    """
    stats = written(
        m.claims.groupBy("diagnosis_code").agg(
            mean(F.sum("claim_amount"), F.count("claim_amount")).alias("mean_amount"),
            F.stddev_samp("claim_amount").alias("stddev_amount"),
        ),
        "diagnosis-stats",
    )
    z = (F.col("claim_amount") - F.col("mean_amount")) / F.nullif(F.col("stddev_amount"), F.lit(0.0))
    return m.claims.select(
        "claim_id", "patient_id", "diagnosis_code", "diagnosis_name", "claim_amount"
    ).join(stats, "diagnosis_code").withColumn("z_score", F.round(z, 2))


def amount_zscore_outliers(
    m: ClaimsModel,
    outlier: float = fixed.OUTLIER_Z,
    extreme: float = fixed.EXTREME_Z,
    limit: int | None = 50,
) -> DataFrame:
    """Claims far from the mean of their diagnosis, furthest first."""
    z = F.col("z_score")
    flag = (
        F.when(z > extreme, fixed.EXTREME_LABEL)
        .when(z > outlier, fixed.OUTLIER_LABEL)
        .when(z < -outlier, fixed.LOW_LABEL)
        .otherwise(fixed.NORMAL_LABEL)
    )
    out = amount_zscores(m).where(F.abs(z) > outlier).select(
        "claim_id",
        "patient_id",
        "diagnosis_name",
        "claim_amount",
        F.round("mean_amount", 0).alias("diagnosis_avg"),
        "z_score",
        flag.alias("anomaly_flag"),
    )
    return top(out, [F.abs("z_score").desc(), F.col("claim_id").asc()], limit)


def claim_escalation(
    m: ClaimsModel,
    min_runs: int = 2,
    limit: int | None = 30,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Patients with several runs of three strictly rising claims in a row."""
    claims = m.dated_claims("full_date").where(F.col("patient_id").isNotNull())
    triples = next_two(
        claims, "patient_id", "full_date", "claim_id", "claim_amount", max_group_rows, slices
    )
    rising = triples.where(
        (F.col("second") > F.col("current")) & (F.col("third") > F.col("second"))
    )
    runs = (
        rising.groupBy("patient_id")
        .agg(
            F.count(F.lit(1)).alias("escalation_count"),
            F.max("third").alias("max_claim_in_escalation"),
            mean(F.sum(F.col("third") - F.col("current")), F.count(F.lit(1)), 0).alias(
                "avg_escalation_amount"
            ),
        )
        .where(F.col("escalation_count") >= min_runs)
    )
    order = [
        F.col("escalation_count").desc(),
        F.col("max_claim_in_escalation").desc(),
        F.col("patient_id").asc(),
    ]
    kept = top(runs.join(m.patients.select("patient_id"), "patient_id", "left_semi"), order, limit)
    return (
        kept.join(m.patients.select("patient_id", "age", "chronic_condition", "city"), "patient_id")
        .select(
            "patient_id",
            "age",
            "chronic_condition",
            "city",
            "escalation_count",
            "max_claim_in_escalation",
            "avg_escalation_amount",
        )
        .orderBy(*order)
    )


def claims_above_provider_avg(
    m: ClaimsModel, factor: float = 2.5, limit: int | None = 50
) -> DataFrame:
    """Claims above ``factor`` times the mean of their hospital."""
    means = written(
        m.claims.where(F.col("provider_id").isNotNull())
        .groupBy("provider_id")
        .agg(
            mean(F.sum("claim_amount"), F.count("claim_amount")).alias("_mean"),
            mean(F.sum("claim_amount"), F.count("claim_amount"), 0).alias("provider_avg_claim"),
        )
        .join(m.providers.select("provider_id"), "provider_id", "left_semi"),
        "provider-means",
    )
    amount = F.col("claim_amount")
    above = (
        m.claims.join(means, "provider_id")
        .where(amount > F.col("_mean") * factor)
        .select(
            "claim_id",
            "patient_id",
            "provider_id",
            "diagnosis_name",
            "claim_amount",
            "provider_avg_claim",
            (amount - F.col("_mean")).alias("deviation_from_avg"),
            "status",
        )
    )
    order = [F.col("deviation_from_avg").desc(), F.col("claim_id").asc()]
    return (
        top(above, order, limit)
        .join(m.providers.select("provider_id", "hospital_name"), "provider_id")
        .select(
            "claim_id",
            "patient_id",
            "provider_id",
            "hospital_name",
            "diagnosis_name",
            "claim_amount",
            "provider_avg_claim",
            "deviation_from_avg",
            "status",
        )
        .orderBy(*order)
    )
