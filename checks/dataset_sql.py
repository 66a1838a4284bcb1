"""Dashboard datasets, measures and load checks as SQL for DuckDB."""

from __future__ import annotations

from checks.report_sql import (
    APPROVED,
    ENDS,
    FREQUENT,
    FREQUENT_HOLES,
    REJECTED,
    RISK_COLUMNS,
    RISK_TABLES,
    ZSCORES,
    big,
    exact,
    integer,
    mean,
    on_star,
)

SQL: dict[str, str] = {}

JOINED = """FROM fact_claims JOIN dim_date USING (date_key) JOIN dim_policies USING (policy_id)"""

SQL["kpi_summary"] = on_star(
    "",
    f"""
SELECT COUNT(*) AS total_claims, {big('SUM(claim_amount)')} AS total_claimed, {big('SUM(approved_amount)')} AS approved_value,
  {mean('claim_amount', 2)} AS avg_claim, {exact(APPROVED, 'COUNT(*)')} AS approval_rate_pct,
  {exact('SUM(approved_amount)', 'SUM(claim_amount)')} AS payout_ratio_pct FROM fact_claims""",
)
SQL["insurer_kpis"] = on_star(
    f"""
k AS (
  SELECT insurer, COUNT(*) AS n, SUM(claim_amount) AS gross, COUNT(claim_amount) AS gn, SUM(approved_amount) AS paid,
    {APPROVED} AS ok, {REJECTED} AS no, SUM(is_emergency) AS em, SUM(is_readmission) AS re, SUM(settlement_days) AS sd, COUNT(settlement_days) AS sn,
    SUM(length_of_stay) AS ls, (SELECT COUNT(*) FROM fact_claims) AS whole
  {JOINED} GROUP BY insurer)
""",
    f"""
SELECT insurer, n AS total_claims, {big('gross')} AS total_claimed, CAST(gross AS DOUBLE) / 1e7 AS total_claimed_crore,
  {big('paid')} AS approved_value, {exact('gross', 'gn', 2, 1)} AS avg_claim, {exact('ok', 'n')} AS approval_rate_pct,
  {exact('no', 'n')} AS rejection_rate_pct, {exact('paid', 'gross')} AS payout_ratio_pct, {exact('em', 'n')} AS emergency_rate_pct,
  {exact('re', 'n')} AS readmission_rate_pct, {exact('sd', 'sn', 1, 1)} AS avg_settlement_days,
  {exact('ls', 'n', 1, 1)} AS avg_length_of_stay, {exact('n', 'whole')} AS share_of_claims_pct,
  CASE WHEN {exact('ok', 'n')} >= 60 THEN 'GOOD' WHEN {exact('ok', 'n')} >= 50 THEN 'FAIR' ELSE 'POOR' END AS status
FROM k""",
)
SQL["plan_shares"] = on_star(
    f"p AS (SELECT insurer, plan_type, COUNT(*) AS claim_count, SUM(claim_amount) AS c {JOINED} GROUP BY insurer, plan_type)",
    f"""
SELECT insurer, plan_type, claim_count, {big('c')} AS claimed,
  {exact('c', '(SUM(c) OVER (PARTITION BY insurer))')} AS pct_within_insurer, {exact('c', '(SUM(c) OVER ())')} AS pct_of_total
FROM p""",
)
SQL["yearly_growth"] = on_star(
    f"""
y AS (SELECT year, COUNT(*) AS n, SUM(claim_amount) AS c {JOINED} GROUP BY year),
z AS (SELECT *, LAG(n) OVER (ORDER BY year) AS n0, LAG(c) OVER (ORDER BY year) AS c0 FROM y)
""",
    f"""
SELECT year, n AS claim_count, {big('c')} AS claimed, {exact('(n - n0)', 'n0')} AS yoy_claims_pct,
  {exact('(c - c0)', 'c0')} AS yoy_amount_pct,
  CASE WHEN {exact('(n - n0)', 'n0')} > 0 THEN '▲' WHEN {exact('(n - n0)', 'n0')} < 0 THEN '▼'
       WHEN n0 IS NOT NULL THEN '▬' END AS arrow FROM z""",
)
SQL["monthly_time_measures"] = on_star(
    f"t AS (SELECT insurer, year, month, COUNT(*) AS n, SUM(claim_amount) AS c {JOINED} GROUP BY insurer, year, month)",
    f"""
SELECT insurer, year, month, n AS claim_count, {big('c')} AS claimed,
  {big('SUM(n) OVER (PARTITION BY insurer, year ORDER BY month)')} AS ytd_claims,
  {big('SUM(c) OVER (PARTITION BY insurer ORDER BY year, month)')} AS running_claimed,
  {exact('(SUM(c) OVER w)', '(COUNT(c) OVER w)', 0, 1)} AS moving_avg_claimed
FROM t WINDOW w AS (PARTITION BY insurer ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
SQL["rank_of_states"] = on_star(
    "t AS (SELECT p.state, SUM(claim_amount) AS c FROM fact_claims JOIN dim_patients p USING (patient_id) GROUP BY p.state)",
    f"SELECT state, {big('c')} AS total_claimed, {integer('RANK() OVER (ORDER BY c DESC)')} AS rank FROM t",
)
SQL["monthly_trend"] = on_star(
    f"""
t AS (SELECT year, month, year * 12 + month AS i, COUNT(*) AS n, SUM(claim_amount) AS c {JOINED} GROUP BY year, month),
line AS (SELECT regr_slope(c, i) AS s, regr_intercept(c, i) AS b, max(i) AS last FROM t),
points AS (
  SELECT year, month, i, n, {big('c')} AS c FROM t UNION ALL
  SELECT CAST((last + k - 1) // 12 AS INT), CAST((last + k - 1) % 12 + 1 AS INT), last + k, NULL, NULL
  FROM line, (SELECT unnest([1, 2, 3]) AS k))
""",
    """
SELECT year, month, n AS claim_count, c AS claimed, round(b + s * i) AS trend, c IS NULL AS is_forecast FROM points, line""",
)
SQL["decomposition"] = on_star(
    "",
    f"""
SELECT insurer, treatment_type, diagnosis_name, COUNT(*) AS claim_count, {big('SUM(claim_amount)')} AS claimed,
  {big('SUM(approved_amount)')} AS approved,
  {integer('3 - GROUPING(insurer) - GROUPING(treatment_type) - GROUPING(diagnosis_name)')} AS level
{JOINED} GROUP BY ROLLUP (insurer, treatment_type, diagnosis_name)""",
)
SQL["claim_size_histogram"] = on_star(
    "b AS (SELECT least(claim_amount // 1000000, 11) AS bin, claim_amount FROM fact_claims)",
    f"""
SELECT {big('bin')} AS bin, {big('bin * 1000000')} AS from_amount,
  {big('CASE WHEN bin < 11 THEN (bin + 1) * 1000000 END')} AS below_amount, COUNT(*) AS claim_count,
  {big('SUM(claim_amount)')} AS claimed FROM b GROUP BY bin""",
)
SQL["rejection_shares"] = on_star(
    f"""
r AS (SELECT insurer, rejection_reason, COUNT(*) AS n, SUM(claim_amount) AS c {JOINED}
  WHERE status = 'Rejected' GROUP BY insurer, rejection_reason)
""",
    f"""
SELECT insurer, rejection_reason, n AS total_rejections, {big('c')} AS total_value_rejected,
  {exact('n', '(SUM(n) OVER (PARTITION BY insurer))')} AS pct_of_rejections FROM r""",
)
SQL["hospital_matrix"] = on_star(
    "",
    f"""
SELECT provider_id, hospital_name, tier, COUNT(*) AS total_claims, {APPROVED} AS approved, {REJECTED} AS rejected,
  COUNT(*) FILTER (WHERE status = 'Pending') AS pending, COUNT(*) FILTER (WHERE status = 'Partially Approved') AS partially_approved,
  COUNT(*) FILTER (WHERE status = 'Under Review') AS under_review, {exact(APPROVED, 'COUNT(*)')} AS approval_rate_pct
FROM fact_claims JOIN dim_providers USING (provider_id) GROUP BY provider_id, hospital_name, tier""",
)


def _influence(attribute: str) -> str:
    return f"""SELECT '{attribute}' AS attribute, CAST({attribute} AS VARCHAR) AS value, COUNT(*) AS n, {REJECTED} AS r
  FROM wide GROUP BY {attribute}"""


SQL["rejection_influencers"] = on_star(
    f"""
wide AS (SELECT insurer, treatment_type, diagnosis_name, h.tier AS hospital_tier, is_emergency, is_readmission, status
  FROM fact_claims JOIN dim_policies USING (policy_id) JOIN dim_providers h USING (provider_id)),
v AS ({' UNION ALL '.join(_influence(a) for a in ('insurer', 'treatment_type', 'diagnosis_name', 'hospital_tier', 'is_emergency', 'is_readmission'))}),
w AS (SELECT COUNT(*) AS wn, {REJECTED} AS wr FROM wide)
""",
    f"""
SELECT attribute, value, n AS claims, r AS rejections, {exact('r', 'n')} AS rejection_rate_pct,
  round((r / n) / (wr / wn), 3) AS lift, {exact('n', 'wn')} AS support_pct FROM v, w""",
)
SQL["treatment_trend"] = on_star(
    "",
    f"""
SELECT year, month, COUNT(*) FILTER (WHERE treatment_type = 'IPD') AS ipd, COUNT(*) FILTER (WHERE treatment_type = 'OPD') AS opd,
  COUNT(*) FILTER (WHERE treatment_type = 'Day Care') AS day_care,
  COUNT(*) FILTER (WHERE treatment_type = 'Emergency') AS emergency {JOINED} GROUP BY year, month""",
)
SQL["risk_distribution"] = on_star(
    RISK_TABLES,
    f"""
SELECT risk_category, COUNT(*) AS patients, {big('SUM(claimed)')} AS total_claimed,
  {exact('COUNT(*)', '(SUM(COUNT(*)) OVER ())')} AS pct_of_patients FROM banded GROUP BY risk_category""",
)
SQL["anomaly_scatter"] = on_star(
    ZSCORES, "SELECT claim_id, patient_id, diagnosis_name, claim_amount, z_score FROM zscores"
)
CLAIMANTS = f"""
SELECT patient_id, COUNT(*) AS flagged_claims, {big('SUM(claim_amount)')} AS flagged_amount,
  MAX(claims_in_90_days) AS most_in_90_days, COUNT(*) FILTER (WHERE fraud_risk_level = 'HIGH RISK') AS high_risk_claims,
  age, city, chronic_condition
FROM frequent JOIN dim_patients USING (patient_id) GROUP BY patient_id, age, city, chronic_condition"""
SQL["high_frequency_claimants"] = on_star(FREQUENT, CLAIMANTS)
SQL["high_frequency_null_keys"] = on_star(FREQUENT_HOLES, CLAIMANTS)
SQL["risk_heatmap"] = on_star(
    RISK_TABLES,
    f"""
SELECT CASE WHEN age >= 75 THEN '75+' WHEN age >= 60 THEN '60-74' WHEN age >= 45 THEN '45-59' WHEN age >= 30 THEN '30-44'
    WHEN age >= 18 THEN '18-29' ELSE '0-17' END AS age_band, chronic_condition, COUNT(*) AS patients,
  {mean('risk_score', 1)} AS avg_risk_score FROM banded GROUP BY 1, 2""",
)
SQL["emergency_funnel"] = on_star(
    "",
    f"""
SELECT h.tier AS hospital_tier, COUNT(*) AS all_claims, {big('SUM(is_emergency)')} AS emergency,
  COUNT(*) FILTER (WHERE is_emergency = 1 AND status = 'Approved') AS approved_emergency,
  {exact('SUM(is_emergency)', 'COUNT(*)')} AS emergency_pct,
  {exact("COUNT(*) FILTER (WHERE is_emergency = 1 AND status = 'Approved')", 'SUM(is_emergency)')} AS approved_emergency_pct
FROM fact_claims JOIN dim_providers h USING (provider_id) GROUP BY h.tier""",
)
SQL["patient_profile"] = on_star(
    RISK_TABLES.rstrip() + ",\n" + ENDS.strip(),
    f"SELECT {RISK_COLUMNS}, ends.* EXCLUDE (patient_id, total_claims) FROM banded JOIN ends USING (patient_id)",
)

# Slicers over the whole model: one region's claims of two years.
SQL["sliced_measures"] = on_star(
    "",
    f"""
SELECT insurer, year, COUNT(*) AS total_claims, {exact(APPROVED, 'COUNT(*)')} AS approval_rate_pct,
  {mean('settlement_days', 1)} AS avg_settlement_days
FROM fact_claims JOIN dim_date USING (date_key) JOIN dim_policies USING (policy_id) JOIN dim_patients p USING (patient_id)
WHERE year IN (1996, 1997) AND p.city = 'ASIA' GROUP BY insurer, year""",
)

# --- load checks ---------------------------------------------------------------
SQL["table_counts"] = on_star(
    "",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {t}"
        for t in ("dim_date", "dim_patients", "dim_providers", "dim_policies", "fact_claims")
    ),
)
SQL["calendar"] = on_star("", "SELECT * FROM dim_date")


def _keys(table: str, *key: str) -> str:
    listed = ", ".join(key)
    missing = " OR ".join(f"{k} IS NULL" for k in key)
    return f"""SELECT '{table}' AS "table", {big('coalesce(SUM(n), 0)')} AS rows,
  COUNT(*) FILTER (WHERE NOT ({missing})) AS distinct_keys, {big(f'coalesce(SUM(n) FILTER (WHERE {missing}), 0)')} AS null_key_rows,
  COUNT(*) FILTER (WHERE n > 1 AND NOT ({missing})) AS repeated_keys
  FROM (SELECT {listed}, COUNT(*) AS n FROM {table} GROUP BY {listed})"""


SQL["key_check"] = on_star(
    "",
    " UNION ALL ".join(
        [
            _keys("dim_date", "date_key"),
            _keys("dim_patients", "patient_id"),
            _keys("dim_providers", "provider_id"),
            _keys("dim_policies", "policy_id"),
            _keys("fact_claims", "claim_id"),
            _keys("lineitem", "l_orderkey", "l_linenumber"),
        ]
    ),
)
SQL["repeated_line_keys"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""
SQL["repeated_part_suppliers"] = """
SELECT l_partkey, l_suppkey, COUNT(*) AS rows FROM lineitem GROUP BY l_partkey, l_suppkey HAVING COUNT(*) > 1"""
SQL["reference_check"] = on_star(
    "",
    " UNION ALL ".join(
        f"""SELECT '{key}' AS reference, COUNT(DISTINCT f.{key}) AS orphan_keys, COUNT(f.{key}) AS orphan_claims
  FROM fact_claims f WHERE f.{key} NOT IN (SELECT {key} FROM {dim})"""
        for key, dim in (
            ("patient_id", "dim_patients"),
            ("provider_id", "dim_providers"),
            ("policy_id", "dim_policies"),
            ("date_key", "dim_date"),
        )
    ),
)
_RULES = {
    "claim_id missing": "claim_id IS NULL",
    "patient_id missing": "patient_id IS NULL",
    "provider_id missing": "provider_id IS NULL",
    "policy_id missing": "policy_id IS NULL",
    "date_key missing": "date_key IS NULL",
    "claim_id longer than 15": "length(claim_id) > 15",
    "patient_id longer than 10": "length(patient_id) > 10",
    "provider_id longer than 10": "length(provider_id) > 10",
    "policy_id longer than 10": "length(policy_id) > 10",
    "diagnosis_code longer than 10": "length(diagnosis_code) > 10",
    "diagnosis_name longer than 50": "length(diagnosis_name) > 50",
    "treatment_type longer than 20": "length(treatment_type) > 20",
    "status longer than 25": "length(status) > 25",
    "rejection_reason longer than 50": "length(rejection_reason) > 50",
    "status unknown": "status IS NULL OR status NOT IN ('Approved', 'Rejected', 'Pending', 'Partially Approved', 'Under Review')",
    "reason without rejection": "rejection_reason IS NOT NULL AND status <> 'Rejected'",
    "rejection without reason": "rejection_reason IS NULL AND status = 'Rejected'",
    "open claim settled": "settlement_days IS NOT NULL AND status IN ('Pending', 'Under Review')",
    "closed claim unsettled": "settlement_days IS NULL AND status NOT IN ('Pending', 'Under Review')",
    "treatment unknown": "treatment_type IS NULL OR treatment_type NOT IN ('IPD', 'OPD', 'Day Care', 'Emergency')",
    "reason unknown": "rejection_reason NOT IN ('Incomplete Documents', 'Pre-existing Condition', 'Waiting Period Not Over',"
    " 'Policy Lapsed', 'Claim Exceeds Coverage', 'Non-Covered Treatment', 'Fraud Suspected')",
    "claimed amount negative": "claim_amount < 0",
    "approved amount negative": "approved_amount < 0",
    "settlement days negative": "settlement_days < 0",
    "approved above claimed": "approved_amount > claim_amount",
    "unpaid status with payment": "status IN ('Rejected', 'Pending', 'Under Review') AND approved_amount <> 0",
    "emergency flag not 0 or 1": "is_emergency IS NULL OR is_emergency NOT IN (0, 1)",
    "readmission flag not 0 or 1": "is_readmission IS NULL OR is_readmission NOT IN (0, 1)",
}
SQL["value_check"] = on_star(
    "",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, COUNT(*) FILTER (WHERE {bad}) AS violations FROM fact_claims"
        for rule, bad in _RULES.items()
    ),
)

# --- streams -------------------------------------------------------------------
SQL["streamed_claims"] = on_star(
    "", "SELECT f.*, year AS claim_year FROM fact_claims f JOIN dim_date USING (date_key)"
)
# A week is closed when its end is not after the newest event less the lateness.
SQL["streamed_alerts"] = """
WITH closed AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events),
days AS (SELECT user_id, CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1, 2),
weeks AS (SELECT user_id, d + CAST(k AS INT) AS before_day, n FROM days, (SELECT unnest(generate_series(1, 7)) AS k))
SELECT user_id, before_day - 7 AS from_day, before_day, CAST(SUM(n) AS BIGINT) AS claims
FROM weeks, closed WHERE before_day <= mark GROUP BY user_id, before_day HAVING SUM(n) >= 20"""


# The load of the star from CSV, its rows, and rows that do not parse.
SHORT_ID = "'C' || substring(md5(claim_id), 1, 14)"
SQL["loaded_claims"] = on_star("", f"SELECT DISTINCT f.* REPLACE ({SHORT_ID} AS claim_id), year AS claim_year FROM fact_claims f JOIN dim_date USING (date_key)")
SQL["reloaded_claims"] = SQL["loaded_claims"]
SQL["loaded_counts"] = on_star(
    "",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM (SELECT DISTINCT * FROM {t})"
        for t in ("dim_date", "dim_patients", "dim_providers", "dim_policies", "fact_claims")
    ),
)
SQL["rejected_rows"] = on_star(
    "", "SELECT patient_id, CASE WHEN age % 10 <> 7 THEN age END AS age, age % 10 = 7 AS rejected FROM dim_patients"
)
SQL["refused_claims"] = on_star(
    "",
    f"""SELECT {SHORT_ID} AS claim_id, 'unknown provider_id' AS reasons FROM fact_claims
WHERE CAST(substring(provider_id, 2) AS BIGINT) % 3 = 0""",
)
# Two batches, earlier and later days: windows as they stand after each, ending on a day with events, holding one of the batch's days.
SQL["watched_alerts"] = """
WITH days AS (
  SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS d, COUNT(*) AS n
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
cut AS (SELECT (min(d) + max(d)) // 2 AS mid FROM days),
parts AS (SELECT user_id, d, n, CASE WHEN d <= mid THEN 0 ELSE 1 END AS b FROM days, cut),
windows AS (
  SELECT k.b, e.user_id, e.d, SUM(p.n) AS claims, bool_or(p.b = k.b) AS touched
  FROM parts e JOIN (VALUES (0), (1)) AS k(b) ON e.b <= k.b
    JOIN parts p ON p.user_id = e.user_id AND p.b <= k.b AND e.d - p.d BETWEEN 0 AND 6
  GROUP BY k.b, e.user_id, e.d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY b, user_id ORDER BY claims DESC, d) AS place FROM windows WHERE touched)
SELECT user_id, DATE '1970-01-01' + (d - 6) AS from_day, DATE '1970-01-01' + (d + 1) AS before_day, CAST(claims AS BIGINT) AS claims
FROM ranked WHERE place = 1 AND claims >= 20"""

SQL["summary_measures"] = on_star(
    "",
    f"""
SELECT insurer, p.state, quarter, COUNT(*) AS total_claims, {big('SUM(claim_amount)')} AS total_claimed,
  {exact(APPROVED, 'COUNT(*)')} AS approval_rate_pct, {mean('settlement_days', 1)} AS avg_settlement_days
{JOINED} JOIN dim_patients p USING (patient_id) WHERE year IN (1996, 1997, 1998) GROUP BY insurer, p.state, quarter""",
)
SQL["patients_by_bitmap"] = on_star(
    "", f"SELECT year, insurer, COUNT(DISTINCT patient_id) AS patients {JOINED} GROUP BY year, insurer"
)
SQL["patients_by_sketch"] = on_star(
    "", f"SELECT insurer, COUNT(DISTINCT patient_id) AS unique_patients, TRUE AS within_error {JOINED} GROUP BY insurer"
)
SQL["clustered_patient_claims"] = on_star(
    "",
    f"""
SELECT f.*, full_date, hospital_name, insurer, plan_type,
  {big('SUM(claim_amount) OVER (ORDER BY full_date, claim_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS running_total_claims,
  COUNT(*) OVER (ORDER BY full_date) AS cumulative_claim_count
FROM fact_claims f JOIN dim_date USING (date_key) JOIN dim_providers USING (provider_id) JOIN dim_policies USING (policy_id)
WHERE patient_id = 'P7'""",
)
