"""Entry points: the flagship report, every query, and its SQL counterpart."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

if str(Path(__file__).resolve().parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.dataset_sql import SQL as DATASET_SQL
from checks.report_sql import SQL as REPORT_SQL
from claimspan.functions import summary
from claimspan.functions.measures import measure, totals
from claimspan.model import ClaimsModel, filter_model
from claimspan.operators import quality
from claimspan.operators.duplicates import repeated_keys
from claimspan.plans import cohort, datasets, finance, fraud, provider, ranking, risk
from claimspan.schema import PRIMARY_KEYS, TABLES
from claimspan.sources import star
from claimspan.sources.clustering import write_clustered
from claimspan.sources.load import load_all
from claimspan.sources.scratch import released, shared_folder, shuffles_freed, written
from claimspan.sources.star import from_star
from claimspan.sources.tables import read_model, read_with_rejects, verify_counts, with_claim_year
from claimspan.sources.versions import files_of
from claimspan.streaming import daily_counts, ingest
from claimspan.streaming.alerts import frequency_alerts

try:  # these folders may be absent; everything else works without them
    import corpus_pipeline
    from claimspan.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("claimspan.llm", "claimspan.llm.common", "corpus_pipeline"):
        raise
    corpus_pipeline = llm = None

_Report = Callable[[ClaimsModel], DataFrame]


def _with_holes(m: ClaimsModel) -> ClaimsModel:
    """The model with claims that lack their hospital or their patient."""
    return replace(
        m,
        claims=m.claims.withColumns(
            {
                "provider_id": F.expr("if(claim_amount % 3 = 0, null, provider_id)"),
                "patient_id": F.expr("if(claim_amount % 7 = 0, null, patient_id)"),
            }
        ),
    )


def _reports() -> dict[str, _Report]:
    return {
        "loss_ratio_by_insurer_quarter": finance.loss_ratio_by_insurer_quarter,
        "patient_risk_score": risk.patient_risk_score,
        "patient_risk_score_all": lambda m: risk.patient_risk_score(m, limit=None),
        "rejection_root_cause": finance.rejection_root_cause,
        "rejection_root_cause_all": lambda m: finance.rejection_root_cause(m, limit=None),
        "state_access_cost": finance.state_access_cost,
        "diagnosis_cost_benchmark": finance.diagnosis_cost_benchmark,
        "insurer_scorecard": finance.insurer_scorecard,
        "monthly_trend_cube": finance.monthly_trend_cube,
        "fraud_frequency_90d": fraud.fraud_frequency_90d,
        "fraud_frequency_90d_all": lambda m: fraud.fraud_frequency_90d(m, limit=None),
        # Claims without a hospital count, claims without a patient do not.
        "fraud_frequency_null_keys": lambda m: fraud.fraud_frequency_90d(_with_holes(m), limit=None),
        "high_frequency_null_keys": lambda m: datasets.high_frequency_claimants(_with_holes(m)),
        "cohort_retention": cohort.cohort_retention,
        "amount_zscore_outliers": fraud.amount_zscore_outliers,
        "amount_zscore_outliers_all": lambda m: fraud.amount_zscore_outliers(m, limit=None),
        # The usual bound of 2 leaves no claim of the given tables either.
        "amount_zscore_outliers_wide": lambda m: fraud.amount_zscore_outliers(m, 1.5, 1.7, limit=None),
        "hospital_insurer_performance": provider.hospital_insurer_performance,
        "hospital_insurer_performance_all": lambda m: provider.hospital_insurer_performance(m, limit=None),
        "claim_escalation": fraud.claim_escalation,
        "claim_escalation_all": lambda m: fraud.claim_escalation(m, limit=None),
        # Amounts in the given tables are uniform: none reaches 2.5 times its mean.
        "claims_above_provider_avg": lambda m: fraud.claims_above_provider_avg(m, factor=1.5),
        "claims_above_provider_avg_all": lambda m: fraud.claims_above_provider_avg(m, 1.5, limit=None),
        "patient_running_total": lambda m: cohort.patient_running_total(m, patients=None),
        "chosen_running_total": lambda m: cohort.patient_running_total(m, patients=["P1", "P5", "P7"]),
        "hospital_approval_rank": provider.hospital_approval_rank,
        "hospital_approval_rank_all": lambda m: provider.hospital_approval_rank(m, limit=None),
        "hospital_approval_plain_rank": lambda m: provider.hospital_approval_rank(
            m, limit=None, dense=False
        ),
        "insurer_moving_average": finance.insurer_moving_average,
        "insurer_yoy_growth": finance.insurer_yoy_growth,
        "insurer_next_year": lambda m: finance.insurer_yoy_growth(m, lead=True),
        "top_patients_by_state": ranking.top_patients_by_state,
        "settlement_percentile": ranking.settlement_percentile,
        "first_last_claim": cohort.first_last_claim,
        "first_last_claim_all": lambda m: cohort.first_last_claim(m, limit=None),
    }


def _datasets() -> dict[str, _Report]:
    reports = _reports()
    found = {name: build for name, build in datasets.DATASETS.items() if name not in reports}
    found.pop("geography")  # the state report itself
    found["rank_of_states"] = lambda m: datasets.rank_by(m, "state", "total_claimed")
    found["sliced_measures"] = lambda m: measure(
        filter_model(m, year=[1996, 1997], city="ASIA"),
        ["total_claims", "approval_rate_pct", "avg_settlement_days"],
        ["insurer", "year"],
    )
    return found


def _checks() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def keys(spark: SparkSession, folder: str) -> DataFrame:
        tables = from_star(spark, folder).tables()
        keyed = {t: (df, [PRIMARY_KEYS[t]]) for t, df in tables.items()}
        lines = spark.read.parquet(f"{folder}/lineitem.parquet")
        return quality.key_summary({**keyed, "lineitem": (lines, ["l_orderkey", "l_linenumber"])})

    def repeated(spark: SparkSession, folder: str) -> DataFrame:
        lines = spark.read.parquet(f"{folder}/lineitem.parquet")
        return quality.key_violations(lines, "l_orderkey", "l_linenumber")

    def suspected(spark: SparkSession, folder: str) -> DataFrame:
        """Parts and suppliers that share more than one order line, found on hashes."""
        return repeated_keys(spark.read.parquet(f"{folder}/lineitem.parquet"), "l_partkey", "l_suppkey")

    return {
        "repeated_part_suppliers": suspected,
        "table_counts": _on_star(lambda m: verify_counts(m.tables())),
        "calendar": _on_star(lambda m: m.dates),
        "key_check": keys,
        "repeated_line_keys": repeated,
        "reference_check": _on_star(quality.reference_summary),
        "value_check": _on_star(lambda m: quality.value_violations(m.claims, "fact_claims")),
    }


def _streams() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def files(spark: SparkSession, folder: str, name: str) -> DataFrame:
        return (
            spark.readStream.schema(star.SCHEMAS[name])
            .option("pathGlobFilter", f"{name}.parquet")
            .parquet(folder)
        )

    def claims(spark: SparkSession, folder: str) -> DataFrame:
        """Ingest the order lines as claims, twice: the second run adds nothing."""
        m, run = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        orders = spark.read.schema(star.SCHEMAS["orders"]).parquet(f"{folder}/orders.parquet")
        for attempt in ("first", "again"):
            stream = star.claims_of(files(spark, folder, "lineitem"), orders)
            ingest.ingest(stream, m.dates, f"{run}/claims", f"{run}/{attempt}").awaitTermination()
        return spark.read.parquet(f"{run}/claims")

    def alerts(spark: SparkSession, folder: str) -> DataFrame:
        """Users with 20 events within 7 days, for every week that has closed."""
        run = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        events = files(spark, folder, "events").selectExpr(
            "user_id", "cast(convert_timezone('UTC', current_timezone(), ts) as timestamp) as event_time"
        )
        found = frequency_alerts(events, "user_id", days=7, threshold=20, lateness="1 day")
        query = (
            found.writeStream.format("parquet")
            .option("path", f"{run}/alerts")
            .option("checkpointLocation", f"{run}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return spark.read.schema(found.schema).parquet(f"{run}/alerts")

    def refused(spark: SparkSession, folder: str) -> DataFrame:
        """Ingest the order lines as claims where a third of the hospitals is unknown: the claims set aside, and why."""
        m, run = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        orders = spark.read.schema(star.SCHEMAS["orders"]).parquet(f"{folder}/orders.parquet")
        known = replace(m, providers=m.providers.where("cast(substring(provider_id, 2) as bigint) % 3 <> 0"))
        stream = star.claims_of(files(spark, folder, "lineitem"), orders).withColumn("claim_id", _short_id())
        ingest.ingest(stream, m.dates, f"{run}/claims", f"{run}/state", f"{run}/rejects", known).awaitTermination()
        rejects = spark.read.parquet(f"{run}/rejects")
        return rejects.select("claim_id", F.array_join("_reasons", "; ").alias("reasons"))

    def watched(spark: SparkSession, folder: str) -> DataFrame:
        """Users whose fullest week reaches 20 events, found on daily counts in two batches: earlier and later days."""
        run = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        day = "floor(unix_seconds(event_time) / 86400)"
        events = files(spark, folder, "events").selectExpr(
            "user_id", "cast(convert_timezone('UTC', current_timezone(), ts) as timestamp) as event_time"
        )
        ends = (
            spark.read.schema(star.SCHEMAS["events"]).parquet(f"{folder}/events.parquet")
            .selectExpr("unix_date(cast(ts as date)) as d").selectExpr("(min(d) + max(d)) div 2 as mid").first()
        )
        for part in (f"{day} <= {ends['mid']}", f"{day} > {ends['mid']}"):
            state = f"{run}/{uuid.uuid4().hex}"
            daily_counts.watch(events.where(part), run, state, "user_id", days=7, threshold=20).awaitTermination()
        return spark.read.parquet(f"{run}/alerts").drop("query", "batch")

    return {"streamed_claims": claims, "streamed_alerts": alerts, "refused_claims": refused, "watched_alerts": watched}


def _short_id() -> Column:
    """A claim id within the length that the fact allows."""
    return F.concat(F.lit("C"), F.substring(F.md5("claim_id"), 1, 14))


def _loads() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def to_csv(df: DataFrame, path: str, *split_by: str) -> None:
        # The files are read a few times at most: the fast level of gzip.
        fast = df.write.option("header", True).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        with shuffles_freed(df.sparkSession):
            fast.partitionBy(*split_by).csv(path)

    def as_csv(spark: SparkSession, folder: str) -> tuple[ClaimsModel, str]:
        m, source = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        claims = star.distinct_claims(spark, folder).withColumn("claim_id", _short_id())
        for name, df in replace(m, claims=claims).tables().items():
            to_csv(df, f"{source}/{name}.csv")
        return m, source

    def counts(spark: SparkSession, folder: str) -> DataFrame:
        """The tables as CSV, loaded, checked and published."""
        _, source = as_csv(spark, folder)
        return load_all(spark, source, f"{source}/lake")

    def claims(spark: SparkSession, folder: str) -> DataFrame:
        """The claims of that load, with the types and the missing values they had."""
        _, source = as_csv(spark, folder)
        load_all(spark, source, f"{source}/lake")
        return read_model(spark, f"{source}/lake").claims

    def reloaded(spark: SparkSession, folder: str) -> DataFrame:
        """A load whose claims of one year are wrong, and a second one with the right ones, which writes that year alone.

        The claims come as two deliveries, that year and the rest; the wrong one is replaced by the right one.
        """
        m, source = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        first = m.dates.agg(F.min("year")).first()[0]
        days = m.dates.where(F.col("year") == first).agg(F.min("date_key"), F.max("date_key")).first()
        of_year = F.coalesce(F.col("date_key").between(*days), F.lit(False))
        claims = star.distinct_claims(spark, folder).withColumn("claim_id", _short_id())
        to_csv(claims.withColumn("part", F.when(of_year, "right").otherwise("rest")), f"{source}/claims", "part")
        fs, _ = files_of(spark, source)
        for part in ("right", "rest"):
            (_, made), (_, delivered) = files_of(spark, f"{source}/claims/part={part}"), files_of(spark, f"{source}/{part}/fact_claims.csv")
            fs.mkdirs(delivered.getParent() if fs.exists(made) else delivered)  # without claims, an empty folder
            if fs.exists(made):
                fs.rename(made, delivered)
        for name, df in m.tables().items():
            if name != "fact_claims":
                to_csv(df, f"{source}/rest/{name}.csv")
        right = spark.read.schema(TABLES["fact_claims"]).option("header", True).csv(f"{source}/right/fact_claims.csv")
        to_csv(right.withColumn("claim_amount", F.col("claim_amount") + 1), f"{source}/wrong/fact_claims.csv")
        for delivery in ("wrong", "right"):
            load_all(spark, f"{source}/{{rest,{delivery}}}", f"{source}/lake")
        return read_model(spark, f"{source}/lake").claims

    def clustered(spark: SparkSession, folder: str) -> DataFrame:
        """The claims of a patient, read from the whole fact stored by patient and day."""
        m, path = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        write_clustered(with_claim_year(m.claims, m.dates), m.dates, path)
        stored = replace(m, claims=spark.read.parquet(path))
        return datasets.patient_claims(stored, "P7").drop("claim_year")

    def rejected(spark: SparkSession, folder: str) -> DataFrame:
        """Patients from CSV where every age that ends in 7 is no number: those rows are set aside with their text."""
        m, source = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        broken = m.patients.withColumn("age", F.expr("if(age % 10 = 7, concat(age, ' years'), cast(age as string))"))
        broken.write.option("header", True).csv(f"{source}/dim_patients.csv")
        good, bad = read_with_rejects(spark, source, "dim_patients")
        return good.select("patient_id", "age", F.lit(False).alias("rejected")).unionByName(
            bad.select(F.split("raw_row", ",")[0].alias("patient_id"), F.lit(None).cast("int").alias("age"), F.lit(True).alias("rejected"))
        )

    def summarised(spark: SparkSession, folder: str) -> ClaimsModel:
        """The model with a stored summary in two parts, earlier and later years, made in one pass."""
        m, path = from_star(spark, folder), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        middle = m.dates.selectExpr("(min(date_key) + max(date_key)) div 2").first()[0]
        load = F.when(F.col("date_key") <= middle, "earlier").when(F.col("date_key") > middle, "later")
        claims = m.claims.withColumn("load", load).where("load is not null")
        with released(spark) as store:
            summary.add_parts(summary.summarise(replace(m, claims=claims), [*summary.SUMMARY_KEYS, "load"], store), path)
        return replace(m, summary=summary.read_summary(spark, path))

    def from_summary(spark: SparkSession, folder: str) -> DataFrame:
        """Measures and a slicer answered from the stored summary."""
        m = filter_model(summarised(spark, folder), year=[1996, 1997, 1998])
        return measure(m, ["total_claims", "total_claimed", "approval_rate_pct", "avg_settlement_days"], ["insurer", "state", "quarter"])

    def bits(spark: SparkSession, folder: str) -> DataFrame:
        """Distinct patients per year and insurer, rolled up from exact bitmaps per month."""
        number = F.substring("patient_id", 2, 20).cast("bigint")
        monthly = written(summary.patient_bitmaps(from_star(spark, folder), ["year", "month", "insurer"], number), "bitmaps")
        return summary.exact_patients(monthly, ["year", "insurer"])

    def sketches(spark: SparkSession, folder: str) -> DataFrame:
        """Per insurer: the exact number of patients, and whether that of the merged sketches is within four standard errors."""
        m = summarised(spark, folder)
        near = summary.approximate_patients(m.summary, ["insurer"])
        exact = totals(m, ["insurer"], ["claim_count"], count_patients=True).select("insurer", "unique_patients")
        off = F.abs(F.col("patients") - F.col("unique_patients")) <= 4 * summary.PATIENT_ERROR * F.col("unique_patients") + 1
        return exact.join(near, "insurer").select("insurer", "unique_patients", off.alias("within_error"))

    return {"clustered_patient_claims": clustered, "summary_measures": from_summary, "patients_by_bitmap": bits, "patients_by_sketch": sketches, "loaded_counts": counts, "loaded_claims": claims, "reloaded_claims": reloaded, "rejected_rows": rejected}


def _on_star(report: _Report) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: report(from_star(spark, folder))


def entry(spark: SparkSession) -> DataFrame:
    """The insurer scorecard on the smallest tables."""
    return finance.insurer_scorecard(from_star(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on_model = {**_reports(), **_datasets()}
    found = {**{name: _on_star(build) for name, build in on_model.items()}, **_checks(), **_streams(), **_loads()}
    if llm:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    return {**REPORT_SQL, **DATASET_SQL, **(llm.oracle_sql() if llm else {})}
