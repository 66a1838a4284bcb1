"""The five tables every report works on, and slicer filters over them.

A model must be consistent: each fact row finds its patient, provider, policy
and date. ``sources.load.load_all`` checks that before it publishes tables, and
``filter_model`` keeps it so. Reports rely on it to attach descriptive columns
after a top-k has cut the rows down, not before.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ClaimsModel:
    claims: DataFrame
    dates: DataFrame
    patients: DataFrame
    providers: DataFrame
    policies: DataFrame
    #: A stored summary of the claims (``functions.summary``); totals whose keys it has are taken from it.
    summary: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.claims.sparkSession

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dates,
            "dim_patients": self.patients,
            "dim_providers": self.providers,
            "dim_policies": self.policies,
            "fact_claims": self.claims,
        }

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> ClaimsModel:
        return cls(
            claims=tables["fact_claims"],
            dates=tables["dim_date"],
            patients=tables["dim_patients"],
            providers=tables["dim_providers"],
            policies=tables["dim_policies"],
        )

    def dated_claims(self, *date_columns: str) -> DataFrame:
        """Claims with columns of their day. The calendar is small; Spark
        broadcasts it when its size estimate is under the threshold."""
        return self.claims.join(self.dates.select("date_key", *date_columns), "date_key")


# Attribute -> (model field, join key, column in that table).
ATTRIBUTES: dict[str, tuple[str, str, str]] = {
    **{c: ("dates", "date_key", c) for c in
       ("full_date", "day", "month", "month_name", "quarter", "year", "day_of_week", "is_weekend")},
    **{c: ("policies", "policy_id", c) for c in ("insurer", "plan_type")},
    "hospital_name": ("providers", "provider_id", "hospital_name"),
    "speciality": ("providers", "provider_id", "speciality"),
    "hospital_tier": ("providers", "provider_id", "tier"),
    "hospital_city": ("providers", "provider_id", "city"),
    "hospital_state": ("providers", "provider_id", "state"),
    "accreditation": ("providers", "provider_id", "accreditation"),
    **{c: ("patients", "patient_id", c) for c in
       ("age", "gender", "city", "state", "chronic_condition", "blood_group", "registration_date")},
}


def filter_model(m: ClaimsModel, **slicers: object) -> ClaimsModel:
    """Apply slicers to the whole model: ``filter_model(m, year=2023, insurer=["A", "B"])``.

    A slicer is any name in ``ATTRIBUTES`` or any fact column; its value is one
    value or a list of them. Dimension slicers reach the fact through a
    semi-join on the surviving keys.
    """
    summary = m.summary
    if summary is not None and not set(slicers) <= set(summary.columns):
        summary = None  # its cells are not fine enough
    fact_where: list = []
    dim_where: dict[str, list] = {}
    keys: dict[str, str] = {}
    for name, wanted in slicers.items():
        listed = isinstance(wanted, Iterable) and not isinstance(wanted, str)
        values = list(wanted) if listed else [wanted]
        if summary is not None:
            summary = summary.where(F.col(name).isin(values))
            if name in ATTRIBUTES:
                summary = summary.where(f"_in_{ATTRIBUTES[name][0]}")
        if name in ATTRIBUTES:
            field, key, column = ATTRIBUTES[name]
            dim_where.setdefault(field, []).append(F.col(column).isin(values))
            keys[field] = key
        elif name in m.claims.columns:
            fact_where.append(F.col(name).isin(values))
        else:
            raise ValueError(f"unknown slicer {name!r}")

    # A fact stored by year prunes its folders directly.
    if "year" in slicers and "claim_year" in m.claims.columns:
        wanted = slicers["year"]
        years = [wanted] if isinstance(wanted, int) else list(wanted)
        fact_where.append(F.col("claim_year").isin(years))

    claims = m.claims
    for condition in fact_where:
        claims = claims.where(condition)
    dims = {}
    for field, conditions in dim_where.items():
        dim = getattr(m, field)
        for condition in conditions:
            dim = dim.where(condition)
        dims[field] = dim
        claims = claims.join(dim.select(keys[field]), keys[field], "left_semi")
    return replace(m, claims=claims, summary=summary, **dims)
