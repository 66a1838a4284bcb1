"""Groups too large for one task: the spread way must give the plain way's rows.

A third of all rows belong to one key. Bounds are set low so that the spread
way is taken on small data.
"""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimspan.operators import ordered, ranking, timeline
from claimspan.operators.groups import hot_keys
from claimspan.plans import cohort, finance, fraud, provider
from tests.conftest import same


@pytest.fixture(scope="module")
def claims(spark):
    df = spark.range(1500).select(
        F.when(F.col("id") % 3 == 0, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 40 + 1)).alias("patient_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.pmod(F.xxhash64("id"), F.lit(300))).cast("int")).alias("day"),
        F.concat(F.lit("C"), F.col("id")).alias("claim_id"),
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)).alias("amount"),
    )
    return df.persist()


@pytest.fixture(scope="module")
def one_day(claims):
    """The hot patient's claims all fall on one day."""
    return claims.withColumn(
        "day", F.when(F.col("patient_id") == "P0", F.lit("2022-05-05").cast("date")).otherwise(F.col("day"))
    )


@pytest.fixture(scope="module")
def gaps(claims):
    """NULL amounts: some anywhere, the hot patient's first ones (more than a slice), all of one patient."""
    unknown = (
        (F.pmod(F.xxhash64("claim_id"), F.lit(3)) == 0)
        | ((F.col("patient_id") == "P0") & (F.col("day") < "2022-04-15"))
        | (F.col("patient_id") == "P7")
    )
    return claims.withColumn("amount", F.when(~unknown, F.col("amount")))


def test_hot_keys(claims):
    assert [r[0] for r in hot_keys(claims, "patient_id", 200).collect()] == ["P0"]
    assert hot_keys(claims, ["patient_id", "day"], 200) is None
    assert hot_keys(claims, "patient_id", 10_000) is None


@pytest.mark.parametrize("table", ["claims", "one_day", "gaps"])
def test_trailing_count(request, table):
    df = request.getfixturevalue(table)
    w = Window.partitionBy("patient_id").orderBy(F.unix_date("day").cast("long")).rangeBetween(-90, 0)
    plain = df.withColumn("n", F.count("*").over(w))
    assert len(same(plain, timeline.trailing_count(df, "patient_id", "day", 90, "n"))) == 1500


@pytest.mark.parametrize("table", ["claims", "one_day", "gaps"])
def test_running_totals(request, table):
    df = request.getfixturevalue(table)
    args = (df, "patient_id", "day", "claim_id", "amount")
    same(timeline.running_totals(*args), timeline.running_totals(*args, max_group_rows=200, slices=7))


@pytest.mark.parametrize("table", ["claims", "one_day", "gaps"])
@pytest.mark.parametrize("block", [2, 5, 4096])
def test_next_two(request, table, block):
    df = request.getfixturevalue(table)
    args = (df, "patient_id", "day", "claim_id", "amount")
    plain = timeline.next_two(*args)
    same(plain, timeline.next_two(*args, max_group_rows=200, slices=5, block=block))


def test_sequence_numbers(claims):
    w = Window.partitionBy("patient_id").orderBy("day", "claim_id")
    plain = claims.withColumn("seq", F.row_number().over(w).cast("long"))
    order = [F.col("day"), F.col("claim_id")]
    same(plain, ordered.running_sums(claims, ["patient_id"], order, {"seq": F.lit(1)}, 200, 6))


@pytest.mark.parametrize("table", ["claims", "gaps"])
@pytest.mark.parametrize("slices", [1, 2, 9])
def test_sliced_sums(request, table, slices):
    claims = request.getfixturevalue(table)
    order = [F.col("day").desc(), F.col("claim_id")]
    w = Window.partitionBy("patient_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = claims.withColumns({"s": F.sum("amount").over(w), "n": F.count("*").over(w)})
    spread = ordered.sliced_running_sums(
        claims, ["patient_id"], order, {"s": F.col("amount"), "n": F.lit(1)}, slices
    )
    same(plain, spread)


def test_sliced_sums_without_keys(claims):
    order = [F.col("amount"), F.col("claim_id")]
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same(claims.withColumn("s", F.sum("amount").over(w)),
         ordered.sliced_running_sums(claims, [], order, {"s": F.col("amount")}, 6))


@pytest.mark.parametrize("max_rows, slices", [(10_000, None), (50, 6)])
@pytest.mark.parametrize("accuracy", [1000, 20])
def test_percentiles(claims, max_rows, slices, accuracy):
    names = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    plain = claims.groupBy("patient_id").agg(
        *[F.round(F.percentile("amount", F.lit(p)), 6).alias(n) for n, p in names.items()]
    )
    ours = ordered.exact_percentiles(claims, ["patient_id"], "amount", names, max_rows, slices, accuracy)
    same(plain, ours.select("patient_id", *[F.round(n, 6).alias(n) for n in names]))


def test_percentiles_outside_their_bracket_are_still_exact(spark, monkeypatch):
    """Brackets in the wrong place lead to the count over all values."""
    def wrong(rows, keys, value, ends, accuracy):
        zeros = F.array(*[F.lit(0).cast("long")] * len(ends)).alias("_ends")
        return rows.groupBy(*keys).agg(F.count("*").alias("_total")).select(*keys, "_total", zeros)

    monkeypatch.setattr(ordered, "_brackets", wrong)
    df = spark.range(1, 102).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    (r,) = ordered.exact_percentiles(df, ["k"], "v", {"a": 0.5, "b": 0.905}).collect()
    assert (r["a"], r["b"]) == (51.0, 91.5)


def test_brackets_are_close(spark):
    df = spark.range(0, 100_000, 1, 9).select((F.col("id") % 7 % 2).alias("k"), F.col("id").alias("v"))
    ends = [0.1, 0.5, 0.9]
    for r in ordered._brackets(df, ["k"], "v", ends, 200).collect():
        assert r["_total"] == df.where(F.col("k") == r["k"]).count()
        assert all(abs(got - 100_000 * p) < 100_000 * 3 / 200 for got, p in zip(r["_ends"], ends))


def test_percentiles_of_doubles(spark):
    df = spark.range(1001).select(F.lit("a").alias("k"), (F.col("id") / 8).alias("v"))
    (r,) = ordered.exact_percentiles(df, ["k"], "v", {"m": 0.5, "h": 0.95}).collect()
    assert (r["m"], r["h"]) == (62.5, 118.75)


def test_percentiles_of_missing_keys_and_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", None), ("a", 5)], "k string, v long")
    got = ordered.exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect()
    assert sorted([(r["k"], r["m"]) for r in got], key=repr) == [("a", 5.0), (None, 2.0)]


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("tiles", [4, 7])
def test_global_ranks(claims, dense, tiles):
    args = (claims, "amount", "claim_id", "r", "t", tiles, dense)
    same(ranking.ranked_with_tiles(*args), ranking.ranked_with_tiles(*args, max_rows=10, slices=5))


def test_fewer_rows_than_tiles(claims):
    few = claims.limit(3).persist()
    args = (few, "amount", "claim_id", "r", "t", 4, True)
    same(ranking.ranked_with_tiles(*args), ranking.ranked_with_tiles(*args, max_rows=1, slices=2))


def test_percent_rank(claims):
    counts = claims.groupBy("patient_id", F.col("amount").alias("v")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("patient_id").orderBy("amount")
    plain = claims.select("patient_id", F.col("amount").alias("v"), F.percent_rank().over(w).alias("percent_rank"))
    for bound in (10_000, 20):
        same(plain.distinct(), ranking.percent_rank_by_value(counts, "patient_id", "v", "n", bound))


def test_reports_agree_either_way(star):
    same(fraud.claim_escalation(star), fraud.claim_escalation(star, max_group_rows=30, slices=4))
    same(cohort.patient_running_total(star, None),
         cohort.patient_running_total(star, None, max_group_rows=30, slices=4))
    same(finance.diagnosis_cost_benchmark(star),
         finance.diagnosis_cost_benchmark(star, max_group_rows=100, slices=4))
    same(provider.hospital_approval_rank(star, limit=None),
         provider.hospital_approval_rank(star, limit=None, max_rows=3, slices=3))
