"""A claims model on TPC-H-like tables, to try the reports on generated data.

One order line is one claim. Customers stand in for patients, suppliers for
hospitals and parts for policies; fields the tables lack (age, tier, signup)
are derived from keys. A day's key is its distance from 1970-01-01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspan.model import ClaimsModel
from claimspan.schema import REJECTION_REASONS, TREATMENTS
from claimspan.sources.calendar import calendar_between

# Fixed values of the stand-in data.
CONDITION_OF_SEGMENT = {
    "BUILDING": "None",
    "AUTOMOBILE": "Diabetes",
    "MACHINERY": "Diabetes+Hypertension",
    "HOUSEHOLD": "Asthma",
    "FURNITURE": "Hypertension",
}
ACCREDITATIONS = ("NABH", "NABL", "JCI", "ISO", "None")
GENDERS = ("Male", "Female", "Other")
BLOOD_GROUPS = ("A+", "A-", "B+", "B-", "O+", "O-", "AB+", "AB-")


# Column types of the tables used, so that no file is opened just to learn them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} % {len(values)} + 1 as int))"


_CONDITION = " ".join(f"when '{k}' then '{v}'" for k, v in CONDITION_OF_SEGMENT.items())

_PATIENTS = [
    "concat('P', c_custkey) as patient_id",
    "cast(c_custkey % 90 + 1 as int) as age",
    f"{_pick(GENDERS, 'c_custkey')} as gender",
    "city",
    "state",
    f"case c_mktsegment {_CONDITION} end as chronic_condition",
    f"{_pick(BLOOD_GROUPS, 'c_custkey')} as blood_group",
    "date_add(date '1995-01-01', cast(c_custkey % 730 as int)) as registration_date",
]
_PROVIDERS = [
    "concat('H', s_suppkey) as provider_id",
    "s_name as hospital_name",
    "concat('Speciality ', s_suppkey % 8) as speciality",
    "city",
    "state",
    "concat('Tier ', s_suppkey % 3 + 1) as tier",
    "cast(s_suppkey % 500 + 50 as int) as bed_capacity",
    f"{_pick(ACCREDITATIONS, 's_suppkey')} as accreditation",
]
_POLICIES = [
    "concat('POL', p_partkey) as policy_id",
    "p_brand as insurer",
    "p_type as plan_type",
    "cast(floor(p_retailprice) as int) as annual_premium",
    "cast(p_size as bigint) * 100000 as coverage_limit",
    "p_size * 500 as deductible",
    "p_size % 4 * 5 as copay_pct",
    "p_size % 3 * 30 as waiting_period_days",
    "cast((p_size % 20 + 80) / 100 as decimal(4,2)) as claim_settlement_ratio",
]
# Amounts in cents and discounts in percent, as whole numbers.
_LINES = [
    "*",
    "cast(floor(l_extendedprice * 100 + 0.5) as bigint) as cents",
    "cast(floor(l_discount * 100 + 0.5) as bigint) as off",
    "unix_date(cast(o_orderdate as date)) as day_no",
    "case when l_returnflag = 'N' and l_linestatus = 'O' then 'Approved'"
    " when l_returnflag = 'N' then 'Partially Approved' when l_returnflag = 'R' then 'Rejected'"
    " when l_linestatus = 'O' then 'Pending' else 'Under Review' end as outcome",
]
_CLAIMS = [
    "concat_ws('-', 'C', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents) as claim_id",
    "concat('P', o_custkey) as patient_id",
    "concat('H', l_suppkey) as provider_id",
    "concat('POL', l_partkey) as policy_id",
    "day_no as date_key",
    "concat('D', substring(o_orderpriority, 1, 1)) as diagnosis_code",
    "substring(o_orderpriority, 3) as diagnosis_name",
    f"{_pick(TREATMENTS, 'l_linenumber')} as treatment_type",
    "cents as claim_amount",
    "cents * case outcome when 'Approved' then 100 - off when 'Partially Approved' then 50 - off"
    " else 0 end div 100 as approved_amount",
    "outcome as status",
    f"case when outcome = 'Rejected' then {_pick(REJECTION_REASONS, 'l_linenumber')} end"
    " as rejection_reason",
    "case when outcome not in ('Pending', 'Under Review')"
    " then abs(unix_date(cast(l_shipdate as date)) - day_no) % 90 + 1 end as settlement_days",
    "cast(floor(l_quantity) as int) as length_of_stay",
    "cast(l_quantity > 40 as int) as is_emergency",
    "cast(l_linenumber = 7 as int) as is_readmission",
]


def claims_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Claims from order lines, which may be a stream.

    Both tables grow with the data, so they are always merged on the order key;
    that also spreads small single-block files over all cores.
    """
    joined = lines.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    return joined.selectExpr(*_LINES).selectExpr(*_CLAIMS)


def distinct_claims(spark: SparkSession, folder: str) -> DataFrame:
    """The claims without repeated rows.

    A claim's id begins with its order, so equal claims are of one order: compared
    along with the order key they stand together since the join, and are not moved again.
    """
    lines, orders = (spark.read.schema(SCHEMAS[t]).parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "orders"))
    joined = lines.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    return joined.selectExpr(*_LINES).selectExpr("l_orderkey", *_CLAIMS).distinct().drop("l_orderkey")


def from_star(spark: SparkSession, folder: str) -> ClaimsModel:
    def read(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    orders = read("orders")
    # Named as the side to broadcast: held in memory it takes some MB, more than Spark
    # expects of a column of the other side, which it would broadcast instead.
    places = (
        read("nation")
        .join(read("region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr("n_nationkey", "n_name as state", "r_name as city")
        .hint("broadcast")
    )
    return ClaimsModel(
        claims=claims_of(read("lineitem"), orders),
        dates=calendar_between(orders, "o_orderdate"),
        patients=read("customer")
        .join(places, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(*_PATIENTS),
        providers=read("supplier")
        .join(places, F.expr("s_nationkey = n_nationkey"))
        .selectExpr(*_PROVIDERS),
        policies=read("part").selectExpr(*_POLICIES),
    )
