"""The claims model of ``claimspan.sources.star`` written as SQL common tables."""

from claimspan.schema import REJECTION_REASONS, TREATMENTS
from claimspan.sources.star import ACCREDITATIONS, BLOOD_GROUPS, CONDITION_OF_SEGMENT, GENDERS


def _listed(values: tuple[str, ...], index: str) -> str:
    # DuckDB lists count from 1.
    inner = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{inner}], CAST({index} % {len(values)} AS INT) + 1)"


_CONDITIONS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CONDITION_OF_SEGMENT.items())

STAR_SQL = f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1 FROM orders),
all_days AS (SELECT CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date FROM span),
dim_date AS (
  SELECT CAST(date_diff('day', DATE '1970-01-01', full_date) AS INT) AS date_key, full_date,
    CAST(day(full_date) AS INT) AS day, CAST(month(full_date) AS INT) AS month,
    monthname(full_date) AS month_name, CAST(quarter(full_date) AS INT) AS quarter,
    CAST(year(full_date) AS INT) AS year, dayname(full_date) AS day_of_week,
    CAST(CASE WHEN dayofweek(full_date) IN (0, 6) THEN 1 ELSE 0 END AS INT) AS is_weekend
  FROM all_days),
dim_patients AS (
  SELECT 'P' || c_custkey AS patient_id, CAST(c_custkey % 90 + 1 AS INT) AS age,
    {_listed(GENDERS, "c_custkey")} AS gender, r_name AS city, n_name AS state,
    CASE c_mktsegment {_CONDITIONS} END AS chronic_condition,
    {_listed(BLOOD_GROUPS, "c_custkey")} AS blood_group,
    DATE '1995-01-01' + CAST(c_custkey % 730 AS INT) AS registration_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dim_providers AS (
  SELECT 'H' || s_suppkey AS provider_id, s_name AS hospital_name,
    'Speciality ' || (s_suppkey % 8) AS speciality, r_name AS city, n_name AS state,
    'Tier ' || (s_suppkey % 3 + 1) AS tier, CAST(s_suppkey % 500 + 50 AS INT) AS bed_capacity,
    {_listed(ACCREDITATIONS, "s_suppkey")} AS accreditation
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dim_policies AS (
  SELECT 'POL' || p_partkey AS policy_id, p_brand AS insurer, p_type AS plan_type,
    CAST(floor(p_retailprice) AS INT) AS annual_premium, CAST(p_size AS BIGINT) * 100000 AS coverage_limit,
    p_size * 500 AS deductible, p_size % 4 * 5 AS copay_pct, p_size % 3 * 30 AS waiting_period_days,
    CAST((p_size % 20 + 80) / 100 AS DECIMAL(4,2)) AS claim_settlement_ratio
  FROM part),
lines AS (
  SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents, CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS off,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Approved'
         WHEN l_returnflag = 'N' THEN 'Partially Approved'
         WHEN l_returnflag = 'R' THEN 'Rejected'
         WHEN l_linestatus = 'O' THEN 'Pending' ELSE 'Under Review' END AS st
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fact_claims AS (
  SELECT 'C-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || cents AS claim_id,
    'P' || o_custkey AS patient_id, 'H' || l_suppkey AS provider_id, 'POL' || l_partkey AS policy_id,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) AS date_key,
    'D' || substring(o_orderpriority, 1, 1) AS diagnosis_code, substring(o_orderpriority, 3) AS diagnosis_name,
    {_listed(TREATMENTS, "l_linenumber")} AS treatment_type, cents AS claim_amount,
    cents * CASE st WHEN 'Approved' THEN 100 - off WHEN 'Partially Approved' THEN 50 - off ELSE 0 END // 100 AS approved_amount,
    st AS status,
    CASE WHEN st = 'Rejected' THEN {_listed(REJECTION_REASONS, "l_linenumber")} END AS rejection_reason,
    CASE WHEN st NOT IN ('Pending', 'Under Review') THEN
      CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 90 + 1 AS INT) END AS settlement_days,
    CAST(floor(l_quantity) AS INT) AS length_of_stay,
    CAST(l_quantity > 40 AS INT) AS is_emergency, CAST(l_linenumber = 7 AS INT) AS is_readmission
  FROM lines)
"""
