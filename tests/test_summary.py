"""The stored summary gives what the fact gives, without reading it."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from claimspan.functions import summary
from claimspan.functions.measures import MEASURES, measure
from claimspan.model import filter_model
from claimspan.plans import datasets, finance
from tests.conftest import rows, same
from tests.test_plans import plan


@pytest.fixture(scope="module")
def both(spark, star, tmp_path_factory):
    """A model with claims of unknown dimensions, plain and with a summary in three parts."""
    third = F.pmod(F.xxhash64("claim_id"), F.lit(3))
    claims = star.claims.withColumns({
        "provider_id": F.expr("if(claim_amount % 5 = 0, null, provider_id)"),
        "policy_id": F.expr("if(claim_amount % 7 = 0, 'POL0', policy_id)"),
        "settlement_days": F.expr("if(claim_amount % 2 = 0, null, settlement_days)"),
    })
    m = replace(star, claims=claims, patients=star.patients.where("patient_id <> 'P3'"))
    path = str(tmp_path_factory.mktemp("summary"))
    for k in (0, 1, 2, 1):  # a load that runs again replaces its part
        summary.add_part(summary.summarise(replace(m, claims=m.claims.where(third == k))), path, f"load{k}")
    return m, replace(m, summary=summary.read_summary(spark, path))


@pytest.mark.parametrize("by", [[], ["insurer"], ["year", "month"], ["hospital_tier", "state"], ["treatment_type"]])
def test_measures_are_the_same_either_way(both, by):
    plain, quick = both
    same(measure(plain, list(MEASURES), by), measure(quick, list(MEASURES), by))
    assert "FileScan parquet" in plan(measure(quick, list(MEASURES), by))
    assert "lineitem" not in plan(measure(quick, list(MEASURES), by))
    assert "lineitem" in plan(measure(plain, list(MEASURES), by))


def test_keys_that_a_summary_lacks_are_read_from_claims(both):
    plain, quick = both
    same(measure(plain, ["total_claims"], ["hospital_name"]), measure(quick, ["total_claims"], ["hospital_name"]))
    assert "lineitem" in plan(measure(quick, ["total_claims"], ["hospital_name"]))


@pytest.mark.parametrize("slicers", [dict(year=1996), dict(hospital_tier="Tier 1", insurer=["Brand#1", "Brand#2"]), dict(city="ASIA")])
def test_slicers(both, slicers):
    plain, quick = (filter_model(m, **slicers) for m in both)
    assert same(measure(plain, list(MEASURES), ["quarter"]), measure(quick, list(MEASURES), ["quarter"]))
    assert ("lineitem" in plan(measure(quick, ["total_claims"]))) == ("city" in slicers)


def test_reports_and_datasets_from_the_summary(both):
    plain, quick = both
    for build in (finance.loss_ratio_by_insurer_quarter, finance.insurer_moving_average, finance.insurer_yoy_growth,
                  datasets.DATASETS["monthly_trend"], datasets.DATASETS["treatment_trend"], datasets.DATASETS["decomposition"]):
        same(build(plain), build(quick))
        assert "lineitem" not in plan(build(quick))


def test_empty_claims(star, spark, tmp_path):
    none = replace(star, claims=star.claims.where("false"))
    summary.add_part(summary.summarise(none), str(tmp_path / "s"), "x")
    quick = replace(none, summary=summary.summarise(none))
    assert rows(measure(quick, list(MEASURES))) == rows(measure(none, list(MEASURES)))


def test_patients_roll_up(star):
    exact = {r["year"]: r["n"] for r in rows(
        star.dated_claims("year").groupBy("year").agg(F.count_distinct("patient_id").alias("n")))}
    number = F.substring("patient_id", 2, 20).cast("bigint")
    bits = summary.patient_bitmaps(star, ["year", "month", "insurer"], number)
    assert {r["year"]: r["patients"] for r in rows(summary.exact_patients(bits, ["year"]))} == exact
    near = {r["year"]: r["patients"] for r in rows(summary.approximate_patients(summary.summarise(star), ["year"]))}
    assert all(abs(near[y] - n) <= 4 * summary.PATIENT_ERROR * n + 1 for y, n in exact.items())


def test_claims_are_added_up_once(star):
    stages = plan(summary.summarise(star))
    assert "keys=[patient_id" not in stages  # no cells per patient
    added_up = [line for line in stages.splitlines() if "hll_sketch_agg" in line]
    assert added_up and not any("month_name" in line for line in added_up)  # numbers are shuffled, not names


def test_loads_stored_in_one_pass(star, spark, tmp_path):
    third = F.pmod(F.xxhash64("claim_id"), F.lit(3))
    one, each = str(tmp_path / "one"), str(tmp_path / "each")
    claims = star.claims.withColumn("load", F.concat(F.lit("load"), third))
    summary.add_parts(summary.summarise(replace(star, claims=claims), [*summary.SUMMARY_KEYS, "load"]), one)
    for k in range(3):
        summary.add_part(summary.summarise(replace(star, claims=star.claims.where(third == k))), each, f"load{k}")
    assert same(spark.read.parquet(one).drop(summary.SKETCH), spark.read.parquet(each).drop(summary.SKETCH))
    same(*(summary.approximate_patients(summary.read_summary(spark, p), ["insurer"]) for p in (one, each)))
    # one of them again
    summary.add_parts(summary.summarise(replace(star, claims=claims.where("load = 'load1'")), [*summary.SUMMARY_KEYS, "load"]), one)
    assert same(spark.read.parquet(one).drop(summary.SKETCH), spark.read.parquet(each).drop(summary.SKETCH))


def test_missing_attributes_are_not_missing_rows(make_model):
    """Null attributes, and claims whose key is null or unknown."""
    m = make_model(
        [{"policy_id": p, "patient_id": q} for p in ("POL1", "POL2", "POL3", None, "POL9") for q in ("P1", "P2", None)],
        policies=[{"policy_id": "POL1", "insurer": None, "plan_type": None}, {"policy_id": "POL2", "plan_type": None}],
        patients=[{"patient_id": "P2", "state": None}],
    )
    m = replace(m, policies=m.policies.where("policy_id <> 'POL9'"), patients=m.patients.where("patient_id is not null"))
    quick = replace(m, summary=summary.summarise(m))
    for by in (["insurer"], ["insurer", "plan_type", "state"], ["state", "year"]):
        assert same(measure(m, list(MEASURES), by), measure(quick, list(MEASURES), by))


def test_between_two_large_dimensions_claims_are_stored(both, monkeypatch):
    """Each of their shuffles is an execution of its own; small dimensions come first and are broadcast."""
    plain, _ = both
    want = rows(summary.summarise(plain).drop(summary.SKETCH))
    plans = []

    def store(df, label):
        plans.append(plan(df))
        return summary.written(df, label)

    summary.summarise(plain, store=store)
    assert not plans
    monkeypatch.setattr(summary, "FEW_ROWS", 15)  # only the hospitals are fewer
    found = summary.summarise(plain, store=store)
    texts, keys = [*plans, plan(found)], ["date_key", "policy_id", "patient_id"]
    assert [[k for k in keys if f"SortMergeJoin [{k}#" in t] for t in texts] == [[k] for k in keys]
    assert ["lineitem" in t for t in texts] == [True, False, False] and "BroadcastHashJoin [provider_id" in texts[0]
    same(found.drop(summary.SKETCH), plain.spark.createDataFrame(want, found.drop(summary.SKETCH).schema))


def test_a_small_table_is_broadcast_not_its_large_partner(star):
    text = plan(star.patients.select("state").distinct())
    assert "BuildRight" in text and "rightHint=(strategy=broadcast)" in plan(star.patients, "extended")
