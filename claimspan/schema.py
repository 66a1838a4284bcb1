"""The claims star schema: column types, keys, references and value domains."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_INT, _LONG, _STR, _DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()

# Dimensions first, the fact table last: the order in which they are loaded.
TABLES: dict[str, T.StructType] = {
    "dim_date": _struct(
        ("date_key", _INT),
        ("full_date", _DATE),
        ("day", _INT),
        ("month", _INT),
        ("month_name", _STR),
        ("quarter", _INT),
        ("year", _INT),
        ("day_of_week", _STR),
        ("is_weekend", _INT),
    ),
    "dim_patients": _struct(
        ("patient_id", _STR),
        ("age", _INT),
        ("gender", _STR),
        ("city", _STR),
        ("state", _STR),
        ("chronic_condition", _STR),
        ("blood_group", _STR),
        ("registration_date", _DATE),
    ),
    "dim_providers": _struct(
        ("provider_id", _STR),
        ("hospital_name", _STR),
        ("speciality", _STR),
        ("city", _STR),
        ("state", _STR),
        ("tier", _STR),
        ("bed_capacity", _INT),
        ("accreditation", _STR),
    ),
    "dim_policies": _struct(
        ("policy_id", _STR),
        ("insurer", _STR),
        ("plan_type", _STR),
        ("annual_premium", _INT),
        ("coverage_limit", _LONG),
        ("deductible", _INT),
        ("copay_pct", _INT),
        ("waiting_period_days", _INT),
        ("claim_settlement_ratio", T.DecimalType(4, 2)),
    ),
    "fact_claims": _struct(
        ("claim_id", _STR),
        ("patient_id", _STR),
        ("provider_id", _STR),
        ("policy_id", _STR),
        ("date_key", _INT),
        ("diagnosis_code", _STR),
        ("diagnosis_name", _STR),
        ("treatment_type", _STR),
        ("claim_amount", _LONG),
        ("approved_amount", _LONG),
        ("status", _STR),
        ("rejection_reason", _STR),
        ("settlement_days", _INT),
        ("length_of_stay", _INT),
        ("is_emergency", _INT),
        ("is_readmission", _INT),
    ),
}

# A sixth file that can be read but belongs to no report.
DIAGNOSIS_REFERENCE = _struct(
    ("diagnosis_code", _STR), ("diagnosis_name", _STR), ("avg_cost_inr", _INT)
)

PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_patients": "patient_id",
    "dim_providers": "provider_id",
    "dim_policies": "policy_id",
    "fact_claims": "claim_id",
}

# Fact column -> the dimension whose key it must match (same column name there).
FOREIGN_KEYS = {
    "patient_id": "dim_patients",
    "provider_id": "dim_providers",
    "policy_id": "dim_policies",
    "date_key": "dim_date",
}

NOT_NULL = {table: [key] for table, key in PRIMARY_KEYS.items()}
NOT_NULL["dim_date"] = ["date_key", "full_date"]
NOT_NULL["fact_claims"] = ["claim_id", *FOREIGN_KEYS]

# Longest text each column may hold.
MAX_LENGTHS = {
    "dim_date": {"month_name": 20, "day_of_week": 15},
    "dim_patients": {
        "patient_id": 10,
        "gender": 10,
        "city": 50,
        "state": 50,
        "chronic_condition": 50,
        "blood_group": 5,
    },
    "dim_providers": {
        "provider_id": 10,
        "hospital_name": 100,
        "speciality": 50,
        "city": 50,
        "state": 50,
        "tier": 10,
        "accreditation": 10,
    },
    "dim_policies": {"policy_id": 10, "insurer": 50, "plan_type": 30},
    "fact_claims": {
        "claim_id": 15,
        "patient_id": 10,
        "provider_id": 10,
        "policy_id": 10,
        "diagnosis_code": 10,
        "diagnosis_name": 50,
        "treatment_type": 20,
        "status": 25,
        "rejection_reason": 50,
    },
}

# Claim statuses, rejection reasons and treatment types.
APPROVED = "Approved"
REJECTED = "Rejected"
PENDING = "Pending"
PARTIALLY_APPROVED = "Partially Approved"
UNDER_REVIEW = "Under Review"
STATUSES = (APPROVED, REJECTED, PENDING, PARTIALLY_APPROVED, UNDER_REVIEW)
OPEN_STATUSES = (PENDING, UNDER_REVIEW)
REJECTION_REASONS = (
    "Incomplete Documents",
    "Pre-existing Condition",
    "Waiting Period Not Over",
    "Policy Lapsed",
    "Claim Exceeds Coverage",
    "Non-Covered Treatment",
    "Fraud Suspected",
)
TREATMENTS = ("IPD", "OPD", "Day Care", "Emergency")
TIERS = ("Tier 1", "Tier 2", "Tier 3")
