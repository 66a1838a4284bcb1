import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimspan.operators import quality
from claimspan.schema import TABLES
from claimspan.sources import load, tables
from claimspan.sources.calendar import date_dim
from claimspan.sources.scratch import shared_folder, written
from tests.conftest import rows

CSV = {
    "dim_date": "date_key,full_date,day,month,month_name,quarter,year,day_of_week,is_weekend\n"
    "1,2022-01-01,1,1,January,1,2022,Saturday,1\n2,2022-01-02,2,1,January,1,2022,Sunday,1\n"
    "366,2023-01-01,1,1,January,1,2023,Sunday,1\n",
    "dim_patients": "patient_id,age,gender,city,state,chronic_condition,blood_group,registration_date\n"
    "P00001,40,Male,Pune,Maharashtra,None,O+,2021-03-04\n",
    "dim_providers": "provider_id,hospital_name,speciality,city,state,tier,bed_capacity,accreditation\n"
    "H0001,City Hospital,Urology,Pune,Maharashtra,Tier 1,300,None\n",
    "dim_policies": "policy_id,insurer,plan_type,annual_premium,coverage_limit,deductible,copay_pct,"
    "waiting_period_days,claim_settlement_ratio\n"
    "POL0001,Alpha,Individual,18040,750000,2000,15,45,0.83\n",
    "fact_claims": "claim_id,patient_id,provider_id,policy_id,date_key,diagnosis_code,diagnosis_name,"
    "treatment_type,claim_amount,approved_amount,status,rejection_reason,settlement_days,length_of_stay,"
    "is_emergency,is_readmission\n"
    "CLM000001,P00001,H0001,POL0001,1,D001,Asthma,IPD,5000,4500,Approved,,12,3,0,0\n"
    "CLM000002,P00001,H0001,POL0001,366,D001,Asthma,OPD,6000,0,Pending,,,0,1,0\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in CSV.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return tmp_path


def test_text_none_is_a_value_and_empty_is_null(spark, folder):
    (p,) = rows(tables.read_table(spark, str(folder), "dim_patients"))
    assert p["chronic_condition"] == "None" and p["registration_date"] == dt.date(2021, 3, 4)
    assert rows(tables.read_table(spark, str(folder), "dim_providers"))[0]["accreditation"] == "None"
    claims = rows(tables.read_table(spark, str(folder), "fact_claims"))
    assert claims[1]["settlement_days"] is None and claims[0]["rejection_reason"] is None


def test_ratio_keeps_its_decimals(spark, folder):
    (p,) = rows(tables.read_table(spark, str(folder), "dim_policies"))
    assert p["claim_settlement_ratio"] == Decimal("0.83")


def test_types_are_declared(spark, folder):
    for name in CSV:
        assert tables.read_table(spark, str(folder), name).schema == TABLES[name]


def test_bad_row_or_missing_file_raises(spark, folder):
    with (folder / "dim_date.csv").open("a") as f:
        f.write("x,2022-01-03,3,1,January,1,2022,Monday,0\n")
    with pytest.raises(Exception):
        tables.read_table(spark, str(folder), "dim_date").collect()
    (folder / "dim_patients.csv").unlink()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(folder), "dim_patients").collect()


def test_renamed_header_raises(spark, folder):
    text = CSV["dim_patients"].replace("patient_id,age", "age,patient_id", 1)
    (folder / "dim_patients.csv").write_text(text)
    with pytest.raises(Exception):
        tables.read_table(spark, str(folder), "dim_patients").collect()


def test_rejects_are_set_aside(spark, folder):
    with (folder / "dim_date.csv").open("a") as f:
        f.write("x,2022-01-03,3,1,January,1,2022,Monday,0\n")
    good, bad = tables.read_with_rejects(spark, str(folder), "dim_date")
    assert good.count() == 3 and good.schema == TABLES["dim_date"]
    assert rows(bad) == [dict(table="dim_date", raw_row="x,2022-01-03,3,1,January,1,2022,Monday,0")]


def test_conform_repairs_types(spark):
    loose = spark.createDataFrame([("1.0", "x")], "a string, b string").select(
        F.col("a").cast("double").alias("date_key"), F.lit("2022-01-01").alias("full_date"),
        *[F.lit("7").alias(c) for c in ("day", "month", "month_name", "quarter", "year", "day_of_week")],
        F.col("b").alias("is_weekend"))
    got = tables.conform(loose, "dim_date")
    assert [f.dataType for f in got.schema] == [f.dataType for f in TABLES["dim_date"]]
    (r,) = rows(got)
    assert r["date_key"] == 1 and r["full_date"] == dt.date(2022, 1, 1) and r["is_weekend"] is None


def test_load_publishes_checked_tables(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    counts = {r["table"]: r["rows"] for r in rows(load.load_all(spark, str(folder), target))}
    assert counts == dict(dim_date=3, dim_patients=1, dim_providers=1, dim_policies=1, fact_claims=2)
    m = tables.read_model(spark, target)
    assert {r["claim_year"] for r in rows(m.claims)} == {2022, 2023}
    again = {r["table"]: r["rows"] for r in rows(load.load_all(spark, str(folder), target))}
    assert again == counts  # a refresh replaces


def test_failed_load_keeps_what_was_published(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    load.load_all(spark, str(folder), target)
    bad = CSV["fact_claims"] + (
        "CLM000002,P09999,H0001,POL0001,1,D001,Asthma,IPD,10,11,Approved,,12,3,0,0\n"
    )
    (folder / "fact_claims.csv").write_text(bad)
    with pytest.raises(load.QualityError) as error:
        load.load_all(spark, str(folder), target)
    for part in ("repeated key", "patient_id: 1", "approved above claimed"):
        assert part in str(error.value)
    assert tables.read_model(spark, target).claims.count() == 2


@pytest.mark.parametrize("failing", range(5))
def test_a_failing_write_leaves_the_old_model_whole(spark, folder, tmp_path, monkeypatch, failing):
    target = str(tmp_path / "out")
    load.load_all(spark, str(folder), target)
    before = {t: sorted(map(tuple, df.collect()), key=repr) for t, df in tables.read_model(spark, target).tables().items()}
    done = []

    def write(df, path, partition_by=()):
        if len(done) == failing:
            raise OSError("no space left")
        done.append(path)
        tables.write_table(df, path, partition_by)

    monkeypatch.setattr(load, "write_table", write)
    (folder / "dim_patients.csv").write_text(CSV["dim_patients"].replace("P00001", "P00002"))
    (folder / "fact_claims.csv").write_text(CSV["fact_claims"].replace("P00001", "P00002"))
    with pytest.raises(OSError, match="no space"):
        load.load_all(spark, str(folder), target)
    after = {t: sorted(map(tuple, df.collect()), key=repr) for t, df in tables.read_model(spark, target).tables().items()}
    assert after == before
    assert len(list((tmp_path / "out").glob("version=*"))) == 1  # nothing is left of the failed one
    assert len(list((tmp_path / "out" / "years").glob("load=*"))) == 1


def test_a_load_writes_the_years_that_changed(spark, folder, tmp_path, monkeypatch):
    target, written_years = str(tmp_path / "out"), []

    def write(df, path, partition_by=()):
        tables.write_table(df, path, partition_by)
        if partition_by:
            written_years.append(sorted(p.name for p in Path(path).glob("claim_year=*")))

    monkeypatch.setattr(load, "write_table", write)
    reload = lambda text: ((folder / "fact_claims.csv").write_text(text), load.load_all(spark, str(folder), target))
    held = lambda: sorted((r["claim_id"], r["claim_amount"], r["claim_year"]) for r in rows(tables.read_model(spark, target).claims))
    reload(CSV["fact_claims"])
    head, first, second = CSV["fact_claims"].splitlines()
    reload("\n".join([head, second, first]) + "\n")  # another order is no change
    assert written_years == [["claim_year=2022", "claim_year=2023"]]
    reload("\n".join([head, first, second.replace("6000", "6001")]) + "\n")
    assert written_years[1:] == [["claim_year=2023"]]
    assert held() == [("CLM000001", 5000, 2022), ("CLM000002", 6001, 2023)]
    third = first.replace("CLM000001", "CLM000003")
    reload("\n".join([head, first, third, third.replace("CLM000003", "CLM000004")]) + "\n")  # a year grows, another one goes
    assert written_years[2:] == [["claim_year=2022"]]
    assert [h[0] for h in held()] == ["CLM000001", "CLM000003", "CLM000004"]
    reload(head + "\n")
    assert held() == []
    reload(CSV["fact_claims"])
    assert len(held()) == 2
    assert len(list(Path(target, "years").glob("load=*"))) <= 3  # what no version names is gone
    assert len(list(Path(target).glob("version=*"))) == 2


def test_old_versions_go_and_tables_are_registered(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    spark.sql("CREATE DATABASE IF NOT EXISTS loaded")
    for _ in range(4):
        load.load_all(spark, str(folder), target, "loaded")
    assert len(list((tmp_path / "out").glob("version=*"))) == 2  # the published one and the one before
    assert spark.table("loaded.fact_claims").count() == 2
    stats = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED loaded.dim_patients").collect()}
    assert "1 rows" in stats["Statistics"]


def test_calendar(spark):
    d = date_dim(spark, "2022-01-01", "2024-12-31")
    assert d.count() == 1096
    first, leap = d.where("date_key = 1").first(), d.where("full_date = date '2024-02-29'").first()
    assert (first["day_of_week"], first["is_weekend"], first["month_name"]) == ("Saturday", 1, "January")
    assert (leap["day"], leap["quarter"], leap["is_weekend"]) == (29, 1, 0)
    assert [f.dataType for f in d.schema] == [f.dataType for f in TABLES["dim_date"]]


def test_saved_table_with_statistics(spark, star):
    tables.save_table(star.policies, "policies_saved")
    tables.refresh_statistics(spark, "policies_saved")
    text = "\n".join(str(r) for r in spark.sql("describe extended policies_saved").collect())
    assert "200 rows" in text
    tables.save_table(star.policies.limit(5), "policies_saved")
    assert spark.table("policies_saved").count() == 5


def test_bucketed_fact_needs_no_shuffle_per_patient(spark, star):
    tables.save_table(star.claims, "claims_bucketed", bucket_by="patient_id", buckets=4)
    per_patient = spark.table("claims_bucketed").groupBy("patient_id").agg(F.sum("claim_amount"))
    assert "Exchange" not in per_patient._jdf.queryExecution().toString().split("Physical Plan")[1]


def test_jdbc_sink_options():
    class Writer:
        def __init__(self):
            self.seen = {}

        def mode(self, m):
            self.seen["mode"] = m
            return self

        def option(self, k, v):
            self.seen[k] = v
            return self

        def jdbc(self, url, table, properties):
            self.seen.update(url=url, table=table, **properties)

    class Frame:
        write = Writer()

    tables.write_jdbc(Frame, "jdbc:x", "fact_claims", {"user": "me"})
    assert Frame.write.seen == dict(mode="overwrite", truncate=True, url="jdbc:x", table="fact_claims",
                                    user="me", batchsize="5000")


def test_scratch_is_in_the_session_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = written(spark.range(5).toDF("n"), "numbers")
    assert copy.count() == 5 and copy.inputFiles()[0].replace("file://", "").startswith(shared_folder(spark))


# --- quality ---------------------------------------------------------------------

def test_clean_model_has_no_findings(make_model):
    assert rows(quality.findings(make_model([{}, dict(day=3)])).where("violations > 0")) == []


def test_each_broken_rule_is_found(make_model):
    m = make_model([
        dict(claim_id="A"), dict(claim_id="A"), dict(claim_id=None),
        dict(patient_id="P1234567890"),
        dict(status="Lost"), dict(rejection_reason="x"),
        dict(status="Rejected", approved_amount=0),
        dict(status="Pending", approved_amount=0),
        dict(settlement_days=None), dict(approved_amount=5000), dict(is_emergency=2),
        dict(status="Rejected", rejection_reason="x", approved_amount=1),
    ])
    found = {(r["check"], r["rule"]): r["violations"] for r in rows(quality.findings(m).where(
        "violations > 0 and table = 'fact_claims'"))}
    assert found == {
        ("key", "repeated key"): 1, ("value", "claim_id missing"): 1,
        ("value", "status unknown"): 1, ("value", "reason without rejection"): 1,
        ("value", "rejection without reason"): 1, ("value", "open claim settled"): 1,
        ("value", "closed claim unsettled"): 1, ("value", "approved above claimed"): 1,
        ("value", "emergency flag not 0 or 1"): 1, ("value", "unpaid status with payment"): 1,
        ("value", "patient_id longer than 10"): 1, ("value", "reason unknown"): 2,
    }


def test_orphans(make_model):
    m = make_model([{}, dict(patient_id="P2"), dict(patient_id="P2"), dict(patient_id=None)])
    m = type(m)(m.claims, m.dates, m.patients.where("patient_id = 'P1'"), m.providers, m.policies)
    assert rows(quality.orphans(m, "patient_id")) == [dict(patient_id="P2", claims=2)]
    summary = {r["reference"]: (r["orphan_keys"], r["orphan_claims"]) for r in rows(quality.reference_summary(m))}
    assert summary == dict(patient_id=(1, 2), provider_id=(0, 0), policy_id=(0, 0), date_key=(0, 0))


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert sorted((r["k"], r["rows"]) for r in rows(quality.key_violations(df, "k")) if r["k"]) == [("a", 2)]
    assert quality.key_violations(df, "k").where("k is null").first()["rows"] == 1
