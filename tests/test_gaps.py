"""Unknown references, missing amounts and wrong headers."""

from __future__ import annotations

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from claimspan.functions.measures import measure
from claimspan.operators import quality
from claimspan.plans import finance, fraud
from claimspan.plans.datasets import DATASETS
from claimspan.schema import TABLES
from claimspan.sources import scratch
from claimspan.sources.tables import read_with_rejects
from claimspan.streaming import ingest
from tests.conftest import rows

REPORTS = {
    "frequency": lambda m, k: fraud.fraud_frequency_90d(m, medium=1, limit=k),
    "escalation": lambda m, k: fraud.claim_escalation(m, min_runs=1, limit=k),
    "above mean": lambda m, k: fraud.claims_above_provider_avg(m, 1.2, limit=k),
}


@pytest.mark.parametrize("name", list(REPORTS))
def test_cut_rows_are_those_of_known_references(star, name):
    """With a third of the patients and hospitals unknown, the first k rows are the head of all rows."""
    some = lambda df, key: df.where(F.pmod(F.xxhash64(key), F.lit(3)) != 0)
    m = replace(star, patients=some(star.patients, "patient_id"), providers=some(star.providers, "provider_id"))
    every = rows(REPORTS[name](m, None))
    assert len(every) > 7
    assert rows(REPORTS[name](m, 7)) == every[:7]


def test_claims_without_a_hospital_count(star, make_model):
    """The 90 days hold all claims of a patient; only the report leaves out those without a known hospital or patient."""
    m = make_model([{"day": d, "provider_id": h} for d, h in ((0, None), (1, "H1"), (2, None), (3, "H1"))] + [{"patient_id": None}] * 4)
    assert [r["claims_in_90_days"] for r in rows(fraud.fraud_frequency_90d(m))] == [4]
    assert [(r["flagged_claims"], r["most_in_90_days"]) for r in rows(DATASETS["high_frequency_claimants"](m))] == [(2, 4)]
    holes = replace(star, claims=star.claims.withColumn("provider_id", F.expr("if(claim_amount % 3 = 0, null, provider_id)")))
    counts = lambda x: {r["claim_id"]: r["claims_in_90_days"] for r in rows(fraud.frequent_claims(x))}
    assert counts(holes) == counts(star)


def test_means_are_over_known_amounts(make_model):
    m = make_model([{"claim_amount": a} for a in (100, None, 300, None)])
    assert rows(measure(m, ["avg_claim", "total_claims"])) == [{"avg_claim": 200.0, "total_claims": 4}]
    assert [r["avg_claim"] for r in rows(finance.monthly_trend_cube(m))] == [200.0]
    assert [r["moving_avg_per_claim"] for r in rows(finance.insurer_moving_average(m))] == [200.0]
    assert rows(measure(make_model([{"claim_amount": None}]), ["avg_claim"])) == [{"avg_claim": None}]


def test_value_rules_see_nulls_and_domains(make_model):
    m = make_model([{"status": None, "is_emergency": None, "claim_amount": -5, "approved_amount": -9, "treatment_type": "Bogus",
                     "settlement_days": -1, "rejection_reason": "None of these"}])
    broken = {r["rule"] for r in rows(quality.value_violations(m.claims, "fact_claims")) if r["violations"]}
    assert broken >= {"status unknown", "emergency flag not 0 or 1", "claimed amount negative", "approved amount negative",
                      "treatment unknown", "settlement days negative", "reason unknown", "reason without rejection"}
    tiers = m.providers.withColumn("tier", F.lit(None).cast("string"))
    assert {r["rule"] for r in rows(quality.value_violations(tiers, "dim_providers")) if r["violations"]} == {"tier unknown"}


def _swapped(table, a, b):
    names = [f.name for f in TABLES[table]]
    i, j = names.index(a), names.index(b)
    names[i], names[j] = names[j], names[i]
    return ",".join(names)


def test_swapped_columns_are_refused(spark, tmp_path):
    header = _swapped("dim_policies", "insurer", "plan_type")
    (tmp_path / "dim_policies.csv").write_text(f"{header}\nPOL9,Family,Gamma,11111,400000,0,20,60,0.91\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_with_rejects(spark, str(tmp_path), "dim_policies")[0].collect()


def test_swapped_columns_of_a_stream_are_refused(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    header = _swapped("fact_claims", "patient_id", "provider_id")
    (inbox / "a.csv").write_text(header + "\n" + ",".join("1" for _ in TABLES["fact_claims"]) + "\n")
    dates = spark.createDataFrame([(1, 2022)], "date_key int, year int")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.ingest(
            ingest.claim_files(spark, str(inbox)), dates, str(tmp_path / "t"), str(tmp_path / "c"), str(tmp_path / "r")
        ).awaitTermination()


def test_what_is_stored_leaves_no_shuffle_files(spark):
    """The shuffle files of a finished write would else stay until the driver collects its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {str(found.apply(i).getName()) for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    with scratch.released(spark) as store:
        assert len(rows(store(df, "a"))) == 700
    assert len(rows(scratch.written(df, "b"))) == 700
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
