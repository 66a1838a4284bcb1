from __future__ import annotations

import datetime as dt

import pytest

from claimspan.model import ClaimsModel
from claimspan.schema import TABLES
from claimspan.session import session
from claimspan.sources.star import from_star

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star(spark):
    return from_star(spark, SMALL)


DAY0 = dt.date(2022, 1, 1)

PATIENT = dict(age=45, gender="Female", city="Pune", state="Maharashtra", chronic_condition="None",
               blood_group="O+", registration_date=dt.date(2021, 5, 1))
PROVIDER = dict(hospital_name="City Hospital", speciality="Cardiology", city="Pune",
                state="Maharashtra", tier="Tier 1", bed_capacity=100, accreditation="NABH")
POLICY = dict(insurer="Alpha", plan_type="Individual", annual_premium=24000, coverage_limit=500000,
              deductible=0, copay_pct=10, waiting_period_days=30, claim_settlement_ratio=None)
CLAIM = dict(patient_id="P1", provider_id="H1", policy_id="POL1", diagnosis_code="D1",
             diagnosis_name="Asthma", treatment_type="IPD", claim_amount=1000, approved_amount=900,
             status="Approved", rejection_reason=None, settlement_days=10, length_of_stay=2,
             is_emergency=0, is_readmission=0)


def _frame(spark, table, rows):
    schema = TABLES[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


@pytest.fixture(scope="session")
def make_model(spark):
    """A model from the fields that matter: claims give ``day`` (0 is 2022-01-01)."""

    def build(claims, patients=(), providers=(), policies=()):
        facts = []
        for i, c in enumerate(claims):
            c = dict(c)
            day = c.pop("day", 0)
            facts.append({**CLAIM, "claim_id": f"C{i:04d}", "date_key": day + 1, **c})
        last = max((c["date_key"] for c in facts), default=1)
        dates = []
        for k in range(1, last + 1):
            d = DAY0 + dt.timedelta(days=k - 1)
            dates.append(dict(date_key=k, full_date=d, day=d.day, month=d.month,
                              month_name=d.strftime("%B"), quarter=(d.month + 2) // 3, year=d.year,
                              day_of_week=d.strftime("%A"), is_weekend=int(d.weekday() > 4)))

        def dim(key, given, default):
            known = {r[key]: {**default, **r} for r in given}
            for c in facts:
                known.setdefault(c[key], {**default, key: c[key]})
            return list(known.values())

        return ClaimsModel.from_tables({
            "dim_date": _frame(spark, "dim_date", dates),
            "dim_patients": _frame(spark, "dim_patients", dim("patient_id", patients, PATIENT)),
            "dim_providers": _frame(spark, "dim_providers", dim("provider_id", providers, PROVIDER)),
            "dim_policies": _frame(spark, "dim_policies", dim("policy_id", policies, POLICY)),
            "fact_claims": _frame(spark, "fact_claims", facts),
        })

    return build


def rows(df):
    return [r.asDict() for r in df.collect()]


def same(a, b):
    """Same rows, whatever their order."""
    assert sorted(a.columns) == sorted(b.columns)
    columns = sorted(a.columns)
    left = sorted((tuple(r[c] for c in columns) for r in a.collect()), key=repr)
    right = sorted((tuple(r[c] for c in columns) for r in b.collect()), key=repr)
    assert left == right
    return left
