"""Reports against a slow but obvious form of the same answer."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimspan.functions.measures import MEASURES, measure, share_of_total, totals
from claimspan.plans import cohort, datasets, finance, fraud, ranking
from tests.conftest import rows, same


def _dated(m):
    return m.dated_claims("full_date")


def test_frequency_equals_self_join(star):
    c = _dated(star)
    a = c.select("claim_id", "patient_id", F.col("full_date").alias("d"))
    b = c.select(F.col("patient_id").alias("p"), F.col("full_date").alias("e"))
    near = (F.col("p") == F.col("patient_id")) & F.date_diff("d", "e").between(0, 90)
    brute = a.join(b, near).groupBy("claim_id").agg(F.count("*").alias("claims_in_90_days"))
    same(brute.where("claims_in_90_days >= 3"),
         fraud.frequent_claims(star).select("claim_id", "claims_in_90_days"))


def test_escalation_equals_three_way_join(star):
    w = Window.partitionBy("patient_id").orderBy("full_date", "claim_id")
    n = _dated(star).select("patient_id", "claim_amount", F.row_number().over(w).alias("i"))
    b = n.select("patient_id", F.col("claim_amount").alias("two"), (F.col("i") - 1).alias("i"))
    c = n.select("patient_id", F.col("claim_amount").alias("three"), (F.col("i") - 2).alias("i"))
    rising = n.join(b, ["patient_id", "i"]).join(c, ["patient_id", "i"]).where(
        "two > claim_amount and three > two")
    brute = rising.groupBy("patient_id").agg(F.count("*").alias("escalation_count"),
                                             F.max("three").alias("max_claim_in_escalation"))
    same(brute.where("escalation_count >= 2"),
         fraud.claim_escalation(star, limit=None).select(brute.columns))


def test_above_average_equals_correlated_query(spark, star):
    star.claims.createOrReplaceTempView("c")
    brute = spark.sql("""select claim_id from c where claim_amount > (
        select sum(claim_amount) / count(claim_amount) * 1.5 from c x where x.provider_id = c.provider_id)""")
    got = same(brute, fraud.claims_above_provider_avg(star, 1.5, limit=None).select("claim_id"))
    assert got


def test_compact_percentile_equals_percent_rank(star):
    settled = star.claims.where("settlement_days is not null").join(star.policies, "policy_id")
    w = Window.partitionBy("insurer").orderBy("settlement_days")
    brute = settled.select("claim_id", F.round(F.percent_rank().over(w), 4).alias("percentile_rank"))
    same(brute, ranking.settlement_percentile(star).select("claim_id", "percentile_rank"))


def test_ends_equal_first_and_last_value(star):
    w = Window.partitionBy("patient_id").orderBy("full_date", "claim_id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    brute = _dated(star).select(
        "patient_id", F.first("claim_id").over(w).alias("first_claim_id"),
        F.last("claim_id").over(w).alias("latest_claim_id")).distinct()
    same(brute, cohort.first_last_claim(star, limit=None).select(brute.columns))


def test_top_k_is_the_head_of_the_whole(star):
    for report, order in (
        (fraud.fraud_frequency_90d, ["claims_in_90_days", "claim_amount"]),
        (cohort.first_last_claim, ["total_claims"]),
    ):
        part, whole = rows(report(star, limit=7)), rows(report(star, limit=None))
        assert part == whole[:7]
        values = [tuple(r[c] for c in order) for r in whole]
        assert values == sorted(values, reverse=True)


def test_patient_counts_equal_count_distinct(star):
    brute = star.claims.join(star.policies, "policy_id").groupBy("insurer").agg(
        F.count_distinct("patient_id").alias("unique_patients"))
    same(brute, totals(star, ["insurer"], ["claim_count"], count_patients=True).select(brute.columns))


def test_parts_add_up(star):
    n = star.claims.count()
    assert sum(r["claim_count"] for r in rows(finance.monthly_trend_cube(star))) == n
    assert sum(r["claim_count"] for r in rows(datasets.claim_size_histogram(star))) == n
    levels = {}
    for r in rows(datasets.decomposition(star)):
        levels[r["level"]] = levels.get(r["level"], 0) + r["claim_count"]
    assert levels == {0: n, 1: n, 2: n, 3: n}
    by_treatment = rows(datasets.treatment_trend(star))
    assert sum(r[c] for r in by_treatment for c in ("ipd", "opd", "day_care", "emergency")) == n


def test_shares_sum_to_100(star):
    for df, column, group in (
        (datasets.rejection_shares(star), "pct_of_rejections", "insurer"),
        (datasets.plan_shares(star), "pct_within_insurer", "insurer"),
    ):
        for r in df.groupBy(group).agg(F.sum(column).alias("s"), F.count("*").alias("n")).collect():
            assert abs(r["s"] - 100) <= 0.005 * r["n"] + 1e-9
    t = share_of_total(measure(star, ["total_claims"], ["state"]), "total_claims", "pct")
    assert abs(t.agg(F.sum("pct")).first()[0] - 100) < 0.2


def test_funnel_narrows_and_bands_cover_everyone(star):
    for r in rows(datasets.emergency_funnel(star)):
        assert r["all_claims"] >= r["emergency"] >= r["approved_emergency"] > 0
    with_claims = star.claims.select("patient_id").distinct().count()
    assert sum(r["patients"] for r in rows(datasets.risk_distribution(star))) == with_claims
    assert sum(r["patients"] for r in rows(datasets.risk_heatmap(star))) == with_claims


def test_every_measure_works_over_any_attribute(star):
    whole = rows(measure(star, list(MEASURES)))
    assert len(whole) == 1
    for by in (["state"], ["year", "gender"], ["hospital_tier", "insurer"], ["treatment_type", "city"]):
        got = measure(star, ["total_claims", "total_claimed"], by)
        assert sum(r["total_claims"] for r in rows(got)) == whole[0]["total_claims"]


def test_rank_by(star):
    got = rows(datasets.rank_by(star, "insurer", "total_claimed"))
    assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
    amounts = [r["total_claimed"] for r in got]
    assert amounts == sorted(amounts, reverse=True)
