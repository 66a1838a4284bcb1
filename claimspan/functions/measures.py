"""Named measures over any attributes of the model.

A measure is a formula over additive totals (counts and sums). Totals are
taken once, per claim attribute and patient where patients are involved, and
added up from there: the patient dimension is joined to combined rows, never to
single claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspan.functions.numeric import mean, ratio
from claimspan.model import ATTRIBUTES, ClaimsModel
from claimspan.schema import APPROVED, REJECTED

#: The columns of a claim that the totals are made of.
TOTALLED = ["claim_amount", "approved_amount", "status", "is_emergency", "is_readmission", "settlement_days", "length_of_stay"]


def additive_totals() -> dict[str, Column]:
    """The counts and sums every measure is made of."""
    status = F.col("status")
    return {
        "claim_count": F.count(F.lit(1)),
        "claimed": F.sum("claim_amount"),
        "claimed_count": F.count("claim_amount"),
        "approved": F.sum("approved_amount"),
        "approved_count": F.count_if(status == APPROVED),
        "rejected_count": F.count_if(status == REJECTED),
        "emergency_count": F.sum("is_emergency"),
        "readmission_count": F.sum("is_readmission"),
        "settlement_total": F.sum("settlement_days"),
        "settled_count": F.count("settlement_days"),
        "stay_total": F.sum("length_of_stay"),
        "stay_count": F.count("length_of_stay"),
    }


def with_attributes(m: ClaimsModel, names: list[str]) -> DataFrame:
    """Claims joined with just the dimensions that hold the named attributes."""
    claims = m.claims
    wanted: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for name in names:
        if name in ATTRIBUTES:
            field, key, column = ATTRIBUTES[name]
            wanted.setdefault((field, key), []).append((column, name))
    for (field, key), columns in wanted.items():
        dim = getattr(m, field).select(key, *[F.col(c).alias(n) for c, n in columns])
        claims = claims.join(dim, key)
    return claims


def totals(m: ClaimsModel, by: list[str], wanted: list[str] | None = None,
           count_patients: bool = False) -> DataFrame:
    """Additive totals per combination of ``by``; optionally ``unique_patients``.

    With a patient attribute, or to count patients, claims are first combined
    per patient. Each patient then has one row per combination, so counting
    rows counts patients.
    """
    formulas = additive_totals()
    wanted = list(formulas) if wanted is None else wanted
    if m.summary is not None and not count_patients and set(by) <= set(m.summary.columns):
        return _from_summary(m.summary, by, wanted)
    of_patient = [a for a in by if a in ATTRIBUTES and ATTRIBUTES[a][0] == "patients"]
    others = [a for a in by if a not in of_patient]
    claims = with_attributes(m, others)
    if not of_patient and not count_patients:
        return claims.groupBy(*by).agg(*[formulas[w].alias(w) for w in wanted])

    per_patient = claims.groupBy("patient_id", *[a for a in others if a != "patient_id"]).agg(
        *[formulas[w].alias(w) for w in wanted]
    )
    if of_patient:
        dim = m.patients.select("patient_id", *[F.col(ATTRIBUTES[a][2]).alias(a) for a in of_patient])
        per_patient = per_patient.join(dim, "patient_id")
    sums = [F.sum(w).alias(w) for w in wanted]
    if count_patients:
        sums.append(F.count("patient_id").alias("unique_patients"))
    return per_patient.groupBy(*by).agg(*sums)


def flag_of(field: str) -> str:
    """The column of a summary that says whether a cell's claims are known in this dimension."""
    return f"_in_{field}"


def _from_summary(summary: DataFrame, by: list[str], wanted: list[str]) -> DataFrame:
    """Totals added up from the cells of a summary, whose keys include ``by``."""
    for field in dict.fromkeys(ATTRIBUTES[a][0] for a in by if a in ATTRIBUTES):
        summary = summary.where(flag_of(field))
    counts = {n for n in wanted if n.endswith("_count") and n not in ("emergency_count", "readmission_count")}
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) if n in counts else F.sum(n).alias(n) for n in wanted]
    return summary.groupBy(*by).agg(*sums)


# Measure -> (totals it needs, formula). Amounts are whole currency units; a
# crore is ten million.
MEASURES: dict[str, tuple[list[str], object]] = {
    "total_claims": (["claim_count"], lambda: F.col("claim_count")),
    "total_claimed": (["claimed"], lambda: F.col("claimed")),
    "total_claimed_crore": (["claimed"], lambda: F.col("claimed") / F.lit(1e7)),
    "approved_value": (["approved"], lambda: F.col("approved")),
    "avg_claim": (["claimed", "claimed_count"], lambda: mean("claimed", "claimed_count", 2)),
    "approval_rate_pct": (["approved_count", "claim_count"],
                          lambda: ratio("approved_count", "claim_count")),
    "rejection_rate_pct": (["rejected_count", "claim_count"],
                           lambda: ratio("rejected_count", "claim_count")),
    # Paid over claimed. Paid over estimated premium is in the insurer-quarter report.
    "payout_ratio_pct": (["approved", "claimed"], lambda: ratio("approved", "claimed")),
    "emergency_rate_pct": (["emergency_count", "claim_count"],
                           lambda: ratio("emergency_count", "claim_count")),
    "readmission_rate_pct": (["readmission_count", "claim_count"],
                             lambda: ratio("readmission_count", "claim_count")),
    "avg_settlement_days": (["settlement_total", "settled_count"],
                            lambda: mean("settlement_total", "settled_count", 1)),
    "avg_length_of_stay": (["stay_total", "stay_count"],
                           lambda: mean("stay_total", "stay_count", 1)),
}


def measure(m: ClaimsModel, names: list[str], by: list[str] | None = None) -> DataFrame:
    """The named measures per combination of ``by`` (one row if empty)."""
    by = by or []
    needed = list(dict.fromkeys(t for n in names for t in MEASURES[n][0]))
    return totals(m, by, needed).select(*by, *[MEASURES[n][1]().alias(n) for n in names])


# --- time and share measures, on tables of totals ----------------------------

def previous_year(df: DataFrame, by: list[str], values: list[str], lead: bool = False) -> DataFrame:
    """Add each value of the previous (or next) row of the same group in year order."""
    w = Window.partitionBy(*by).orderBy("year")
    shift, prefix = (F.lead, "next") if lead else (F.lag, "prev")
    return df.withColumns({f"{prefix}_{v}": shift(v).over(w) for v in values})


def growth_pct(now: str, before: str) -> Column:
    """Change against an earlier value in percent; NULL without one."""
    return ratio(F.col(now) - F.col(before), before)


def year_to_date(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Running sum over the months of each year."""
    w = Window.partitionBy(*by, "year").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.withColumn(name, F.sum(value).over(w))


def running_total(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Running sum over a table of totals (months of a group, not claims)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.withColumn(name, F.sum(value).over(w))


def moving_average(df: DataFrame, by: list[str], order: list[str], total: str, name: str,
                   rows: int = 3, scale: int = 0) -> DataFrame:
    """Mean of the last ``rows`` rows; gaps in the calendar are not filled."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, Window.currentRow)
    return df.withColumn(name, mean(F.sum(total).over(w), F.count(total).over(w), scale))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percent of the grand total."""
    whole = df.agg(F.sum(value))
    return df.withColumn(name, ratio(value, whole.scalar()))


def share_within(df: DataFrame, within: list[str], value: str, name: str) -> DataFrame:
    """Percent of the total of the row's group."""
    return df.withColumn(name, ratio(value, F.sum(value).over(Window.partitionBy(*within))))


def trend_arrow(growth: str | Column) -> Column:
    """Up, down or level sign for a growth figure."""
    g = F.col(growth) if isinstance(growth, str) else growth
    return F.when(g > 0, "▲").when(g < 0, "▼").when(g == 0, "▬")


def status_label(rate: str | Column, good: float, fair: float) -> Column:
    """GOOD at or above ``good``, FAIR at or above ``fair``, else POOR."""
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.when(r >= good, "GOOD").when(r >= fair, "FAIR").when(r.isNotNull(), "POOR")
