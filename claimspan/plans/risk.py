"""Patient risk score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspan.functions.numeric import banded, mean
from claimspan.model import ClaimsModel
from claimspan.plans import fixed, top


@dataclass(frozen=True)
class RiskRules:
    """Points and thresholds of the five factors; a count must exceed its bound."""

    full_age: int = fixed.FULL_AGE
    age_points: int = fixed.AGE_POINTS
    severe: tuple[str, ...] = fixed.SEVERE_CONDITIONS
    moderate: tuple[str, ...] = fixed.MODERATE_CONDITIONS
    healthy: str = fixed.NO_CONDITION
    condition_points: tuple[int, int, int, int] = fixed.CONDITION_POINTS
    claim_bands: tuple[tuple[int, int], ...] = fixed.CLAIM_POINTS
    claim_base: int = fixed.CLAIM_BASE
    emergency_bands: tuple[tuple[int, int], ...] = fixed.EMERGENCY_POINTS
    readmission_bands: tuple[tuple[int, int], ...] = fixed.READMISSION_POINTS
    high: int = fixed.HIGH_SCORE
    medium: int = fixed.MEDIUM_SCORE

    def score(self) -> Column:
        age, condition = F.col("age"), F.col("chronic_condition")
        severe, moderate, healthy, other = self.condition_points
        by_age = F.when(age > self.full_age, self.age_points).otherwise(
            F.round(age * float(self.age_points) / self.full_age).cast("int")
        )
        by_condition = (
            F.when(condition.isin(*self.severe), severe)
            .when(condition.isin(*self.moderate), moderate)
            .when(condition == self.healthy, healthy)
            .otherwise(other)
        )
        return (
            by_age
            + by_condition
            + banded(F.col("total_claims"), list(self.claim_bands), self.claim_base)
            + banded(F.col("emergency_count"), list(self.emergency_bands), 0)
            + banded(F.col("readmission_count"), list(self.readmission_bands), 0)
        )

    def category(self, score: str) -> Column:
        s = F.col(score)
        return (
            F.when(s >= self.high, fixed.HIGH_RISK)
            .when(s >= self.medium, fixed.MEDIUM_RISK)
            .otherwise(fixed.LOW_RISK)
        )


def scored_patients(m: ClaimsModel, rules: RiskRules | None = None) -> DataFrame:
    """Every patient with claims, scored. The fact is combined per patient
    before it meets the patient table."""
    rules = rules or RiskRules()
    metrics = m.claims.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.sum("claim_amount").alias("total_claimed"),
        F.sum("is_emergency").alias("emergency_count"),
        F.sum("is_readmission").alias("readmission_count"),
        mean(F.sum("length_of_stay"), F.count("length_of_stay"), 1).alias("avg_length_of_stay"),
    )
    who = m.patients.select("patient_id", "age", "gender", "state", "chronic_condition")
    return (
        metrics.join(who, "patient_id")
        .withColumn("risk_score", rules.score())
        .select(
            "patient_id",
            "age",
            "gender",
            "state",
            "chronic_condition",
            "total_claims",
            "total_claimed",
            "emergency_count",
            "readmission_count",
            "avg_length_of_stay",
            "risk_score",
            rules.category("risk_score").alias("risk_category"),
        )
    )


def patient_risk_score(
    m: ClaimsModel, rules: RiskRules | None = None, limit: int | None = 100
) -> DataFrame:
    """Patients by falling risk score."""
    order = [F.col("risk_score").desc_nulls_first(), F.col("patient_id").asc()]
    return top(scored_patients(m, rules), order, limit)
