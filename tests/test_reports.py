"""Reports on hand-made rows with answers worked out by hand."""

import datetime as dt

import pytest

from claimspan.model import filter_model
from claimspan.plans import cohort, datasets, finance, fraud, provider, ranking, risk
from tests.conftest import DAY0, rows


def test_premium_uses_whole_division(make_model):
    m = make_model(
        [dict(policy_id="POL1", claim_amount=10, approved_amount=1178787)],
        policies=[dict(policy_id="POL1", annual_premium=90000), dict(policy_id="POL2", annual_premium=4303)],
    )
    (r,) = rows(finance.loss_ratio_by_insurer_quarter(m))
    assert r["estimated_quarterly_premium"] == 1178787
    assert r["loss_ratio_pct"] == 100.0
    assert r["profitability_status"] == "HIGH RISK"  # exactly 100 is not above 100


@pytest.mark.parametrize(
    "paid, status",
    [(1010, "LOSS MAKING"), (1000, "HIGH RISK"), (810, "HIGH RISK"), (800, "MODERATE"),
     (610, "MODERATE"), (600, "PROFITABLE")],
)
def test_profitability_bands(make_model, paid, status):
    m = make_model([dict(approved_amount=paid)], policies=[dict(policy_id="POL1", annual_premium=80)])
    assert rows(finance.loss_ratio_by_insurer_quarter(m))[0]["profitability_status"] == status


def test_zero_premium_has_no_ratio(make_model):
    m = make_model([{}], policies=[dict(policy_id="POL1", annual_premium=0)])
    (r,) = rows(finance.loss_ratio_by_insurer_quarter(m))
    assert r["loss_ratio_pct"] is None and r["profitability_status"] == "PROFITABLE"


def _score(make_model, claims=1, emergencies=0, readmissions=0, **patient):
    m = make_model(
        [dict(is_emergency=int(i < emergencies), is_readmission=int(i < readmissions)) for i in range(claims)],
        patients=[dict(patient_id="P1", **patient)],
    )
    (r,) = rows(risk.patient_risk_score(m))
    return r["risk_score"], r["risk_category"]


def test_risk_score_edges(make_model):
    assert _score(make_model, age=60)[0] == 20 + 5
    assert _score(make_model, age=61)[0] == 20 + 5
    assert _score(make_model, age=59)[0] == 20 + 5  # 19.67 rounds up
    assert _score(make_model, age=30)[0] == 10 + 5
    assert _score(make_model, age=0, claims=5)[0] == 5
    assert _score(make_model, age=0, claims=6)[0] == 10
    assert _score(make_model, age=0, claims=15)[0] == 15
    assert _score(make_model, age=0, claims=16)[0] == 20
    assert _score(make_model, age=0, claims=4, emergencies=1)[0] == 5
    assert _score(make_model, age=0, claims=4, emergencies=3)[0] == 15
    assert _score(make_model, age=0, claims=4, emergencies=4)[0] == 20
    assert _score(make_model, age=0, claims=4, readmissions=2)[0] == 15
    assert _score(make_model, age=0, claims=4, readmissions=3)[0] == 25


def test_risk_score_conditions(make_model):
    points = {"None": 0, "Diabetes": 15, "COPD": 25, "Diabetes+Hypertension": 25, "Asthma": 10}
    for condition, expected in points.items():
        assert _score(make_model, age=0, chronic_condition=condition)[0] == 5 + expected
    assert _score(make_model, age=0, chronic_condition=None)[0] == 15


def test_risk_category(make_model):
    assert _score(make_model, age=70, chronic_condition="COPD", claims=16)[1] == "HIGH RISK"  # 65
    assert _score(make_model, age=45, chronic_condition="COPD")[1] == "MEDIUM RISK"  # 45
    assert _score(make_model, age=20)[1] == "LOW RISK"


def test_rejections_list_distinct_sorted_names(make_model):
    m = make_model(
        [dict(status="Rejected", rejection_reason="Policy Lapsed", diagnosis_name=d, patient_id=p,
              claim_amount=a)
         for d, p, a in [("Flu", "P1", 10), ("Asthma", "P2", 20), ("Flu", "P2", 25), ("Asthma", "P2", 0)]]
        + [dict(status="Approved")],
        patients=[dict(patient_id="P1", state="Kerala"), dict(patient_id="P2", state="Bihar")],
    )
    (r,) = rows(finance.rejection_root_cause(m))
    assert r["diagnoses_affected"] == "Asthma, Flu" and r["states_affected"] == "Bihar, Kerala"
    assert r["total_rejections"] == 4 and r["total_value_rejected"] == 55
    assert r["avg_amount_per_rejection"] == 14.0  # 13.75


def test_state_counts(make_model):
    m = make_model(
        [dict(patient_id="P1", provider_id="H1", claim_amount=100),
         dict(patient_id="P1", provider_id="H2", claim_amount=50),
         dict(patient_id="P2", provider_id="H2", claim_amount=51, status="Pending", settlement_days=None)],
    )
    (r,) = rows(finance.state_access_cost(m))
    assert (r["total_patients"], r["hospitals_used"], r["total_claims"]) == (2, 2, 3)
    assert r["claim_per_patient"] == 101.0 and r["avg_claim_amount"] == 67.0
    assert r["approval_rate_pct"] == 66.67 and r["avg_settlement_days"] == 10.0


def test_percentiles_interpolate_and_one_claim_has_no_deviation(make_model):
    m = make_model([dict(claim_amount=a) for a in (100, 200, 300, 500)]
                   + [dict(diagnosis_code="D2", diagnosis_name="Flu", claim_amount=7)])
    by_code = {r["diagnosis_code"]: r for r in rows(finance.diagnosis_cost_benchmark(m))}
    r = by_code["D1"]
    assert (r["p25_cost"], r["median_cost"], r["p75_cost"], r["p95_cost"]) == (175, 250, 350, 470)
    assert by_code["D2"]["stddev_cost"] is None and by_code["D2"]["p95_cost"] == 7


def test_scorecard_grades_in_order(make_model):
    def grade(statuses, days):
        m = make_model([dict(status=s, settlement_days=days) for s in statuses])
        return rows(finance.insurer_scorecard(m))[0]["overall_grade"]

    assert grade(["Approved"] * 7 + ["Rejected"] * 3, 29) == "A - EXCELLENT"
    assert grade(["Approved"] * 7 + ["Rejected"] * 3, 30) == "B - GOOD"
    assert grade(["Approved"] * 7 + ["Rejected"] * 3, 45) == "D - POOR"
    assert grade(["Approved"] * 5 + ["Pending"] * 5, 10) == "C - AVERAGE"
    assert grade(["Approved"] * 7 + ["Pending"] * 3, None) == "C - AVERAGE"


def test_trailing_window_edges(make_model):
    m = make_model([dict(day=d) for d in (0, 45, 90, 91)])
    got = {r["claim_date"]: r["claims_in_90_days"] for r in rows(fraud.frequent_claims(m))}
    assert got == {DAY0 + dt.timedelta(days=90): 3, DAY0 + dt.timedelta(days=91): 3}


def test_trailing_window_counts_all_of_the_day(make_model):
    m = make_model([dict(day=3)] * 5)
    assert [(r["claims_in_90_days"], r["fraud_risk_level"]) for r in rows(fraud.fraud_frequency_90d(m))] == [
        (5, "HIGH RISK")] * 5
    assert rows(fraud.fraud_frequency_90d(m))[0]["hospital_name"] == "City Hospital"


def test_cohorts(make_model):
    m = make_model(
        [dict(patient_id="P1", day=0), dict(patient_id="P1", day=1), dict(patient_id="P2", day=100)],
        patients=[dict(patient_id="P1", registration_date=dt.date(2021, 12, 31)),
                  dict(patient_id="P2", registration_date=dt.date(2022, 1, 1))],
    )
    got = [(r["signup_cohort"], r["activity_quarter"], r["active_patients"], r["total_claims"])
           for r in rows(cohort.cohort_retention(m))]
    assert got == [("2021-Q4", 1, 1, 2), ("2022-Q1", 2, 1, 1)]


def test_two_names_of_one_code_do_not_double_claims(make_model):
    claims = [dict(claim_amount=100, diagnosis_name=n) for n in ("A", "B") * 10] + [dict(claim_amount=900)]
    m = make_model(claims)
    assert fraud.amount_zscores(m).count() == len(claims)
    (r,) = rows(fraud.amount_zscore_outliers(m))
    assert r["claim_amount"] == 900 and r["anomaly_flag"] == "EXTREME OUTLIER - Investigate"


def test_single_claim_diagnosis_is_not_flagged(make_model):
    m = make_model([dict(diagnosis_code="D9")])
    assert rows(fraud.amount_zscores(m))[0]["z_score"] is None
    assert rows(fraud.amount_zscore_outliers(m)) == []


def test_pending_pairs_sort_first_among_equal_rates(make_model):
    open_claim = dict(status="Pending", settlement_days=None, approved_amount=0)
    m = make_model([dict(provider_id="H1")] * 10 + [dict(provider_id="H2", **open_claim)] * 10
                   + [dict(provider_id="H3")] * 9)
    got = rows(provider.hospital_insurer_performance(m))
    assert [r["provider_id"] for r in got] == ["H2", "H1"]
    assert got[0]["avg_settlement_days"] is None and got[0]["performance_grade"] == "AVERAGE"
    assert got[1]["performance_grade"] == "EXCELLENT"


def test_escalation_needs_strict_rises(make_model):
    m = make_model([dict(patient_id="P1", day=i, claim_amount=a) for i, a in enumerate((1, 2, 3, 4))]
                   + [dict(patient_id="P2", day=i, claim_amount=a) for i, a in enumerate((1, 2, 2, 3))])
    (r,) = rows(fraud.claim_escalation(m))
    assert (r["patient_id"], r["escalation_count"], r["max_claim_in_escalation"]) == ("P1", 2, 4)
    assert r["avg_escalation_amount"] == 2.0


def test_claims_above_hospital_mean(make_model):
    m = make_model([dict(claim_amount=10)] * 9 + [dict(claim_amount=110)])
    (r,) = rows(fraud.claims_above_provider_avg(m))
    assert (r["claim_amount"], r["provider_avg_claim"], r["deviation_from_avg"]) == (110, 20.0, 90.0)


def test_running_total_steps_while_count_is_shared(make_model):
    m = make_model([dict(day=0, claim_amount=5), dict(day=0, claim_amount=7), dict(day=2, claim_amount=1)])
    got = rows(cohort.patient_running_total(m, ["P1"]))
    assert [r["running_total_claims"] for r in got] == [5, 12, 13]
    assert [r["cumulative_claim_count"] for r in got] == [2, 2, 3]
    assert rows(cohort.patient_running_total(m)) == []  # the default patients are not here


def test_approval_ranks(make_model):
    def claims(h, ok):
        return [dict(provider_id=h, status="Approved" if i < ok else "Pending") for i in range(4)]

    m = make_model(claims("H1", 4) + claims("H2", 4) + claims("H3", 2) + claims("H4", 1) + claims("H5", 0))
    dense = rows(provider.hospital_approval_rank(m, min_claims=4))
    assert [(r["provider_id"], r["approval_rank"], r["performance_quartile"]) for r in dense] == [
        ("H1", 1, 1), ("H2", 1, 1), ("H3", 2, 2), ("H4", 3, 3), ("H5", 4, 4)]
    plain = rows(provider.hospital_approval_rank(m, min_claims=4, dense=False))
    assert [r["approval_rank"] for r in plain] == [1, 1, 3, 4, 5]
    assert rows(provider.hospital_approval_rank(m)) == []  # fewer than 50 claims


def test_moving_average_skips_gaps(make_model):
    m = make_model([dict(day=d, claim_amount=a) for d, a in ((0, 10), (35, 20), (130, 40), (160, 100))])
    got = [r["moving_avg_3month"] for r in rows(finance.insurer_moving_average(m))]
    assert got == [10, 15, 23, 53]


def test_growth_starts_empty(make_model):
    m = make_model([dict(day=0, claim_amount=100), dict(day=400, claim_amount=150), dict(day=401, claim_amount=0)])
    first, second = rows(finance.insurer_yoy_growth(m))
    assert first["prev_year_claims"] is None and first["yoy_claims_growth_pct"] is None
    assert (second["yoy_claims_growth_pct"], second["yoy_amount_growth_pct"]) == (100.0, 50.0)
    ahead, last = rows(finance.insurer_yoy_growth(m, lead=True))
    assert ahead["next_year_amount"] == 150 and last["next_year_amount"] is None


def test_negative_growth_rounds_away_from_zero(make_model):
    m = make_model([dict(day=0, claim_amount=80000), dict(day=400, claim_amount=79996)])
    # -0.005 % exactly
    assert rows(finance.insurer_yoy_growth(m))[1]["yoy_amount_growth_pct"] == -0.01


def test_top_patients(make_model):
    m = make_model([dict(patient_id=f"P{i}", claim_amount=10 * i) for i in range(1, 8)])
    got = rows(ranking.top_patients_by_state(m))
    assert [r["patient_id"] for r in got] == ["P7", "P6", "P5", "P4", "P3"]
    assert got[0]["pct_of_state_claims"] == 25.0 and got[0]["state_avg_claim"] == 40.0


def test_settlement_percentile(make_model):
    m = make_model([dict(settlement_days=d) for d in (1, 5, 5, 9)]
                   + [dict(settlement_days=None, status="Pending")]
                   + [dict(policy_id="POL2", settlement_days=3)],
                   policies=[dict(policy_id="POL2", insurer="Beta")])
    got = rows(ranking.settlement_percentile(m))
    assert [r["percentile_rank"] for r in got] == [0.0, 0.3333, 0.3333, 1.0, 0.0]
    assert (got[0]["insurer_avg_days"], got[0]["insurer_min_days"], got[0]["insurer_max_days"]) == (5.0, 1, 9)


def test_first_and_last_claim_break_ties_by_id(make_model):
    m = make_model([dict(day=1, claim_amount=1), dict(day=1, claim_amount=2), dict(day=4, claim_amount=3),
                    dict(day=4, claim_amount=4), dict(patient_id="P2", day=0)])
    for limit in (50, None, 1):
        got = rows(cohort.first_last_claim(m, limit))
        assert (got[0]["first_claim_id"], got[0]["latest_claim_id"], got[0]["total_claims"]) == ("C0000", "C0003", 4)
        assert len(got) == (1 if limit == 1 else 2)


def test_slicers_restrict_the_whole_model(make_model):
    m = make_model([dict(day=0), dict(day=400), dict(day=400, patient_id="P2", policy_id="POL2")],
                   patients=[dict(patient_id="P2", state="Goa")], policies=[dict(policy_id="POL2", insurer="Beta")])
    assert filter_model(m, year=2023).claims.count() == 2
    assert filter_model(m, year=[2022, 2023], insurer="Beta").claims.count() == 1
    assert filter_model(m, state="Goa", status="Approved").claims.count() == 1
    assert filter_model(m, insurer="Beta").policies.count() == 1
    with pytest.raises(ValueError):
        filter_model(m, planet="Mars")


def test_histogram_last_bin_is_open(make_model):
    m = make_model([dict(claim_amount=a) for a in (0, 9, 10, 25, 1000)])
    got = [(r["bin"], r["below_amount"], r["claim_count"]) for r in rows(datasets.claim_size_histogram(m, 10, 3))]
    assert got == [(0, 10, 2), (1, 20, 1), (2, None, 2)]


def test_forecast_follows_a_straight_line(make_model):
    m = make_model([dict(day=d, claim_amount=a) for d, a in ((0, 100), (31, 200), (60, 300))])
    got = rows(datasets.monthly_trend(m, ahead=2))
    assert [r["trend"] for r in got] == [100, 200, 300, 400, 500]
    assert [r["is_forecast"] for r in got] == [False] * 3 + [True] * 2


def test_patient_pages(make_model):
    m = make_model([dict(day=0), dict(day=5), dict(patient_id="P2")])
    (profile,) = rows(datasets.patient_profile(m, "P1"))
    assert profile["total_claims"] == 2 and profile["latest_claim_id"] == "C0001"
    assert [r["running_total_claims"] for r in rows(datasets.patient_claims(m, "P1"))] == [1000, 2000]


def test_influencer_lift(make_model):
    m = make_model([dict(treatment_type="OPD", status="Rejected", rejection_reason="Policy Lapsed")]
                   + [dict(treatment_type="IPD")] * 3)
    got = {(r["attribute"], r["value"]): r for r in rows(datasets.rejection_influencers(m))}
    assert got["treatment_type", "OPD"]["lift"] == 4.0
    assert got["treatment_type", "IPD"]["rejection_rate_pct"] == 0.0
    assert got["insurer", "Alpha"]["support_pct"] == 100.0


def test_labels(spark):
    from claimspan.functions.measures import status_label, trend_arrow

    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,)], "g double")
    assert [r[0] for r in df.select(trend_arrow("g")).collect()] == ["▲", "▼", "▬", None]
    assert [r[0] for r in df.select(status_label("g", 1, 0)).collect()] == ["GOOD", "POOR", "FAIR", None]
