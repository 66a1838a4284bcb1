"""Physical plans on a stored model: what is read, shuffled and joined."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from claimspan.model import filter_model
from claimspan.operators import quality
from claimspan.plans import cohort, finance, fraud, provider, ranking, risk
from claimspan.plans.datasets import DATASETS
from claimspan.sources.tables import read_model, with_claim_year, write_table


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    for name, df in star.tables().items():
        if name == "fact_claims":
            write_table(with_claim_year(df, star.dates), f"{root}/{name}", ("claim_year",))
        else:
            write_table(df, f"{root}/{name}")
    return read_model(spark, root)


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def fact_scans(text):
    return [line for line in text.splitlines() if "FileScan" in line and "fact_claims" in line]


def test_no_cross_joins_and_no_python(stored):
    for name, build in {**registry._reports(), **DATASETS}.items():
        text = plan(build(stored))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "Python" not in text and "InPandas" not in text, name


def test_scorecard_joins_policies_without_shuffling_claims(stored):
    text = plan(finance.loss_ratio_by_insurer_quarter(stored))
    assert "SortMergeJoin" not in text
    # Between the claims and the shuffle of their totals there are only
    # broadcast joins and the map-side part of the aggregate.
    claims_at = text.index("fact_claims")
    shuffle_at = text.rindex("Exchange hashpartitioning", 0, claims_at)
    between = text[shuffle_at:claims_at]
    assert "partial_sum" in between and between.count("BroadcastHashJoin") == 2


def test_patient_table_meets_combined_rows(stored, spark):
    """With a patient table too large to broadcast, only totals are shuffled to it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (risk.scored_patients(stored), cohort.cohort_retention(stored)):
            text = plan(df)
            assert "SortMergeJoin" in text
            join = text[text.index("SortMergeJoin [patient_id"):]
            assert join.index("HashAggregate") < join.index("fact_claims")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(finance.rejection_root_cause(stored))
    (scan,) = fact_scans(text)
    assert "EqualTo(status,Rejected)" in scan
    read = scan.split("ReadSchema: ")[1]
    assert "settlement_days" not in read and "claim_id" not in read
    (scan,) = fact_scans(plan(cohort.patient_running_total(stored, ["P1", "P2"]))[:100_000])
    assert "In(patient_id, [P1,P2])" in scan


def test_year_slicer_prunes_folders(stored):
    m = filter_model(stored, year=1996)
    text = plan(finance.insurer_scorecard(m))
    for scan in fact_scans(text):
        assert "PartitionFilters: [isnotnull(claim_year" in scan and "1996" in scan


def test_top_k_is_taken_per_task(stored):
    for df in (risk.patient_risk_score(stored), fraud.fraud_frequency_90d(stored),
               fraud.amount_zscore_outliers(stored), provider.hospital_insurer_performance(stored)):
        assert "TakeOrderedAndProject" in plan(df)


def test_rank_within_state_is_cut_before_the_shuffle(stored):
    text = plan(ranking.top_patients_by_state(stored))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_windows_on_claims_are_partitioned(stored):
    for df in (fraud.frequent_claims(stored), cohort.patient_running_total(stored, None),
               fraud.claim_escalation(stored)):
        assert "Exchange SinglePartition" not in plan(df).split("Window", 1)[1]


def test_windows_of_one_key_share_a_shuffle(stored):
    text = plan(cohort.patient_running_total(stored, None))
    assert text.count("Exchange hashpartitioning(patient_id") == 1


def test_hot_branch_appears_only_when_needed(stored):
    assert "Union" not in plan(fraud.claim_escalation(stored))
    assert "Union" in plan(fraud.claim_escalation(stored, max_group_rows=30))


def test_trailing_counts_are_taken_over_combined_days(stored):
    text = plan(fraud.frequent_claims(stored))
    window = text[text.index("Window ["):]
    assert window.index("HashAggregate") < window.index("fact_claims")


def test_small_lookups_are_broadcast_by_size(stored, spark):
    df = fraud.amount_zscores(stored)
    assert "BroadcastHashJoin" in plan(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(fraud.amount_zscores(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_patients_are_broadcast_as_few_rows(stored):
    text = plan(cohort.first_last_claim(stored))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "TakeOrderedAndProject" in text


def test_partitioned_write_spreads_one_year(spark, tmp_path):
    df = spark.range(20_000).select("id", F.lit(2022).alias("y"))
    write_table(df.repartition(8), str(tmp_path / "t"), ("y",))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


def test_diagnosis_benchmark_reads_claims_twice(stored, monkeypatch):
    from claimspan.operators import groups, ordered

    texts = []
    real = finance.written

    def noted(df, label):
        texts.append(plan(df))
        return real(df, label)

    for module in (finance, ordered, groups):
        monkeypatch.setattr(module, "written", noted)
    texts.append(plan(finance.diagnosis_cost_benchmark(stored)))
    assert sum(len(fact_scans(t)) for t in texts) == 2
    assert "Expand" not in plan(finance.state_access_cost(stored))


def test_reference_check_broadcasts_no_dimension(stored):
    """The estimate of one column in compressed files is low: millions of keys would go through the driver."""
    text = plan(quality.reference_summary(stored))
    assert text.count("SortMergeJoin") == 4 and "Broadcast" not in text
