"""Clustered facts, repeated keys by hashes, and plans that follow collected statistics."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from claimspan.model import filter_model
from claimspan.operators.duplicates import repeated_keys, suspected_hashes
from claimspan.operators.quality import key_violations
from claimspan.plans import fraud
from claimspan.plans.datasets import patient_claims, patient_profile
from claimspan.schema import TABLES
from claimspan.sources.clustering import interleaved, write_clustered
from claimspan.sources.load import load_all
from claimspan.sources.scratch import shared_folder
from claimspan.sources.star import distinct_claims, from_star
from claimspan.sources.tables import read_catalog_model, read_model, with_claim_year
from tests.conftest import same
from tests.test_plans import plan

WIDER = "/root/testdata/sf0.01"


def _metric(df, name, node="FileScan"):
    """The sum of an SQL metric over the operators of a run whose text holds ``node``."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if node in p.toString().split("\n")[0] and p.metrics().contains(name):
            total += p.metrics().apply(name).value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


# -- clustering -----------------------------------------------------------


def test_bits_in_turn(spark):
    rng = random.Random(3)
    pairs = [(0, 0), (1023, 0), (0, 1023), (1023, 1023)] + [(rng.randrange(1024), rng.randrange(1024)) for _ in range(50)]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", interleaved(F.col("a"), F.col("b")).alias("z"))
    for r in got.collect():
        want = int("".join(x + y for x, y in zip(f"{r['a']:010b}", f"{r['b']:010b}")), 2)
        assert r["z"] == want


@pytest.fixture(scope="module")
def wide(spark):
    return from_star(spark, WIDER)


@pytest.fixture(scope="module")
def clustered(spark, wide, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered"))
    write_clustered(with_claim_year(wide.claims, wide.dates), wide.dates, path, partitions=256, page_rows=50)
    return spark.read.parquet(path)


def test_clustering_keeps_every_claim(wide, clustered):
    assert same(wide.claims.distinct(), clustered.select(wide.claims.columns).distinct())
    assert wide.claims.count() == clustered.count()


def test_one_patient_reads_a_small_share(clustered):
    one = clustered.where("patient_id = 'P7'").select("patient_id", "claim_amount")
    assert 0 < one.count() <= _metric(one, "numOutputRows") < clustered.count() / 8


def test_few_days_read_a_small_share(wide, clustered):
    first = wide.dates.where("year = 1996").agg(F.min("date_key")).first()[0]
    some = clustered.where(F.col("date_key").between(first + 20, first + 30) & (F.col("claim_year") == 1996))
    year = clustered.where("claim_year = 1996").count()
    assert 0 < _metric(some.select("claim_amount", "date_key"), "numOutputRows") < year / 2


def test_one_hot_patient_and_day_is_cut(spark, wide, tmp_path):
    hot = wide.claims.limit(1).withColumn("claim_id", F.explode(F.expr("transform(sequence(1, 4000), i -> concat('X', i))")))
    write_clustered(with_claim_year(hot.select(wide.claims.columns), wide.dates), wide.dates, str(tmp_path / "hot"), partitions=8)
    stored = spark.read.parquet(str(tmp_path / "hot"))
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) < 1200


def test_unknown_day_and_patient_are_kept(spark, make_model, tmp_path):
    m = make_model([{"day": 3}, {"day": 4, "patient_id": "P2"}])
    odd = m.claims.unionByName(m.claims.limit(1).withColumns(
        {"claim_id": F.lit("odd"), "patient_id": F.lit(None).cast("string"), "date_key": F.lit(99)}))
    write_clustered(with_claim_year(odd, m.dates, "left"), m.dates, str(tmp_path / "c"))
    same(spark.read.parquet(str(tmp_path / "c")).select(odd.columns), odd)
    empty = with_claim_year(odd.where("false"), m.dates)
    write_clustered(empty, m.dates, str(tmp_path / "none"))
    assert spark.read.schema(empty.schema).parquet(str(tmp_path / "none")).count() == 0


def _as_csv(m, source):
    for name, df in m.tables().items():
        df.select([f.name for f in TABLES[name]]).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{source}/{name}.csv")


def test_clustered_load(spark, make_model, tmp_path):
    m = make_model([{"day": d, "patient_id": f"P{d % 5}"} for d in range(0, 700, 7)])
    source, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _as_csv(m, source)
    load_all(spark, source, lake, clustered=True)
    got = read_model(spark, lake)
    same(got.claims.select(m.claims.columns), m.claims)
    same(patient_claims(got, "P3").drop("claim_year"), patient_claims(m, "P3"))
    same(patient_profile(got, "P3"), patient_profile(m, "P3"))
    # a second load of the same rows shares its years with the first, clustered or not
    before = set(got.claims.inputFiles())
    load_all(spark, source, lake)
    assert set(read_model(spark, lake).claims.inputFiles()) == before


def test_patient_slicer_reaches_the_files(clustered, wide):
    from dataclasses import replace

    m = filter_model(replace(wide, claims=clustered), patient_id="P7", year=1996)
    assert "patient_id" in plan(m.claims).split("PushedFilters: ")[1].split("]")[0]


# -- repeated keys --------------------------------------------------------


def test_repeated_keys_like_the_plain_way(spark):
    data = [("a", 1)] * 400 + [("b", i) for i in range(300)] + [(None, 1)] * 200 + [("c", None)] * 3 + [(None, None)]
    data += [("d", 5), ("d", 5), ("", 0), ("", 0), ("", 1)]
    df = spark.createDataFrame(data, "h string, k int").repartition(5)
    got = same(repeated_keys(df, "h", "k"), key_violations(df, "h", "k"))
    assert len(got) == 6
    same(repeated_keys(df, "h"), key_violations(df, "h"))
    none = df.where("false")
    assert repeated_keys(none, "h", "k").count() == 0


def test_shared_hashes_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(i,) for i in range(40)] + [(7,), (9,), (9,)], "id int")
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.pmod(F.col(c[0]), F.lit(3)).cast("long"))
    assert suspected_hashes(df, "id").count() == 3
    assert same(repeated_keys(df, "id"), key_violations(df, "id")) == [(7, 2), (9, 3)]


def test_repeated_keys_shuffle_fewer_bytes(spark):
    ids = spark.range(60_000).repartition(6).select(F.concat(F.lit("claim-"), F.sha2(F.col("id").cast("string"), 256)).alias("claim_id"))
    ids = ids.unionAll(ids.where("claim_id < 'claim-001'"))
    plain = _metric(key_violations(ids, "claim_id"), "shuffleBytesWritten", "Exchange")
    hashed = _metric(suspected_hashes(ids, "claim_id"), "shuffleBytesWritten", "Exchange")
    exact = repeated_keys(ids, "claim_id")
    hashed += _metric(exact, "shuffleBytesWritten", "Exchange")
    assert 0 < hashed < plain / 2
    same(exact, key_violations(ids, "claim_id"))
    assert "BroadcastHashJoin" in plan(exact)


# -- statistics -----------------------------------------------------------


def test_plans_follow_collected_statistics(spark, make_model, tmp_path):
    m = make_model(
        [{"day": i % 60, "patient_id": f"P{i % 900}"} for i in range(1800)],
        patients=[{"patient_id": f"P{i}", "age": i % 90} for i in range(900)],
    )
    source, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _as_csv(m, source)
    spark.sql("CREATE DATABASE IF NOT EXISTS layout")
    load_all(spark, source, lake, catalog="layout")
    got = read_catalog_model(spark, "layout")
    same(got.claims.select(m.claims.columns), m.claims)
    columns = spark.sql("DESCRIBE EXTENDED layout.dim_patients age").collect()
    assert any(r["info_name"] == "histogram" and r["info_value"] != "NULL" for r in columns)

    def few(model):
        return model.patients.where("age = 7").select("patient_id", "state")

    def size(model):
        return int(few(model)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())

    def join_of(model):
        return plan(model.claims.join(few(model), "patient_id").select("claim_id", "state"))

    # The patients of one age are few, which the files alone do not tell.
    by_files = read_model(spark, lake)
    assert size(got) < size(by_files) / 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str((size(got) + size(by_files)) // 2))
    try:
        assert "BroadcastHashJoin" in join_of(got)
        assert "SortMergeJoin" in join_of(by_files)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE layout CASCADE")


def test_distinct_claims_move_the_lines_once(spark, tmp_path):
    for name in ("orders", "lineitem"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        (df.unionAll(df.limit(500)) if name == "lineitem" else df).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = distinct_claims(spark, str(tmp_path))
    assert plan(got).count("Exchange hashpartitioning") == 2  # the two sides of the join
    same(got, from_star(spark, "/root/testdata/sf0.001").claims.distinct())


def test_every_frequent_claim_meets_a_dimension_once(spark, wide):
    every = fraud.fraud_frequency_90d(wide, limit=None)
    assert plan(every).count("FileScan parquet [c_custkey") == plan(every).count("FileScan parquet [s_suppkey") == 1
    cut = fraud.fraud_frequency_90d(wide, limit=1_000_000)
    assert every.columns == cut.columns
    assert same(every, cut)


@pytest.mark.parametrize("first_year", [True, False])
def test_a_reload_delivers_the_wrong_year_alone(spark, tmp_path, first_year):
    """Also where no claim is of the calendar's first year."""
    small = Path("/root/testdata/sf0.001")
    for table in ("customer", "supplier", "part", "nation", "region", "orders"):
        (tmp_path / f"{table}.parquet").symlink_to(small / f"{table}.parquet")
    orders, lines = (spark.read.parquet(str(small / f"{t}.parquet")) for t in ("orders", "lineitem"))
    begin = orders.agg(F.min(F.year("o_orderdate"))).first()[0]
    late = orders.where(F.year("o_orderdate") > begin).select(F.col("o_orderkey").alias("l_orderkey"))
    (lines if first_year else lines.join(late, "l_orderkey", "left_semi").select(lines.columns)).write.parquet(str(tmp_path / "lineitem.parquet"))
    shared = Path(shared_folder(spark))
    before = set(shared.glob("*/wrong"))
    got = registry.queries()["reloaded_claims"](spark, str(tmp_path))
    expected = distinct_claims(spark, str(tmp_path))
    columns = [c for c in expected.columns if c != "claim_id"]
    assert same(got.select(columns), expected.select(columns))
    (source,) = {p.parent for p in set(shared.glob("*/wrong")) - before}
    count = {p: spark.read.schema(TABLES["fact_claims"]).option("header", True).csv(f"{source}/{p}/fact_claims.csv").count() for p in ("wrong", "right", "rest")}
    of_year = expected.where(F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.col("date_key"))) == begin).count()
    assert count == {"wrong": of_year, "right": of_year, "rest": expected.count() - of_year}
    assert (of_year > 0) == first_year
