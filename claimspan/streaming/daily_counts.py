"""Claim-frequency alerts on a maintained table of daily counts.

Each batch is combined to one row per key and UTC day and added to a stored table;
nothing else is kept, however long the span and however many windows overlap. A
batch then looks back for its own keys alone, in the months that its days and their
spans touch, and raises one alert for each key that reaches the threshold in a
window holding one of the batch's days. No window waits for a watermark, so the
last days of a stream are covered and late claims count on arrival.

The table is split by month and by the batch that wrote it: a batch that runs again
after a failure replaces its own rows, so it counts once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimspan.sources.scratch import released
from claimspan.sources.versions import files_of, remove


def utc_day(instant: Column) -> Column:
    """Days since 1970-01-01, cut at UTC midnight whatever the session's time zone is."""
    return F.floor(F.unix_seconds(instant) / 86400).cast("int")


def _month(day: Column) -> Column:
    return F.date_format(F.date_from_unix_date(day), "yyyy-MM")


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def daily_counts(spark: SparkSession, counts: str, key: str) -> DataFrame:
    """(key, day, n): the maintained table, added up over its batches."""
    return spark.read.parquet(counts).groupBy(key, "day").agg(F.sum("n").alias("n"))


def add_batch(batch: DataFrame, counts: str, load: str, key: str, time: str) -> DataFrame:
    """Add a batch's (key, day, n) to the table at ``counts`` and return them.

    Rows without a key or a time count for nobody.
    """
    daily = (
        batch.where(F.col(key).isNotNull() & F.col(time).isNotNull())
        .groupBy(key, utc_day(F.col(time)).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = daily.withColumn("month", _month(F.col("day"))).withColumn("load", F.lit(load))
    # One range of keys per file, so that a key's rows are skipped or found by the statistics of files and pages.
    _overwrite(rows.repartition("month").sortWithinPartitions("month", key, "day"), counts, "month", "load")
    return daily


def alerts_of(spark: SparkSession, touched: DataFrame, counts: str, key: str, days: int, threshold: int) -> DataFrame:
    """For each key of ``touched`` (key, day): its fullest window of ``days`` days that holds one of these days.

    (key, from_day, before_day, claims) of keys with at least ``threshold``
    claims there; of equally full windows the earliest. Windows end on days
    with claims.
    """
    first, last = touched.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return spark.createDataFrame([], f"{key} {touched.schema[key].dataType.simpleString()}, from_day date, before_day date, claims long")
    months = [
        r[0]
        for r in spark.range(first - days + 1, last + days).select(_month(F.col("id").cast("int"))).distinct().collect()
    ]  # as many as the batch's days span
    held = (
        spark.read.parquet(counts)
        .where(F.col("month").isin(months) & F.col("day").between(first - days + 1, last + days - 1))
        .join(touched.select(key).distinct(), key, "left_semi")
        .groupBy(key, "day")
        .agg(F.sum("n").alias("n"))
    )
    marked = held.join(touched.select(key, "day", F.lit(1).alias("new")), [key, "day"], "left")
    window = Window.partitionBy(key).orderBy("day").rangeBetween(1 - days, 0)
    full = marked.select(key, "day", F.sum("n").over(window).alias("claims"), F.max("new").over(window).alias("new"))
    best = F.max(F.struct("claims", (-F.col("day")).alias("before"))).alias("best")
    end = -F.col("best.before")
    return (
        full.where((F.col("new") == 1) & (F.col("claims") >= threshold))
        .groupBy(key)
        .agg(best)
        .select(
            key,
            F.date_from_unix_date(end - (days - 1)).alias("from_day"),
            F.date_from_unix_date(end + 1).alias("before_day"),
            F.col("best.claims").alias("claims"),
        )
    )


def compact(spark: SparkSession, counts: str, key: str) -> None:
    """Merge the batches of each month but the newest month into one run. Not to be called while a batch runs."""
    fs, where = files_of(spark, counts)
    months = sorted(s.getPath().getName() for s in fs.listStatus(where) if s.getPath().getName().startswith("month="))
    for month in months[:-1]:
        loads = [s.getPath().getName() for s in fs.listStatus(files_of(spark, f"{counts}/{month}")[1])]
        if len(loads) < 2:
            continue
        with released(spark) as store:
            merged = store(
                spark.read.option("basePath", counts).parquet(f"{counts}/{month}").groupBy(key, "day", "month").agg(F.sum("n").alias("n")),
                "merged",
            )
            target = f"{counts}/.merging-{month}"
            merged.drop("month").sortWithinPartitions(key, "day").write.mode("overwrite").parquet(target)
        # Readers see the month either in parts or merged: the folder is renamed once the parts are gone.
        remove(spark, f"{counts}/{month}")
        fs.mkdirs(files_of(spark, f"{counts}/{month}")[1])
        fs.rename(files_of(spark, target)[1], files_of(spark, f"{counts}/{month}/load=merged")[1])


def watch(
    claims: DataFrame,
    target: str,
    checkpoint: str,
    key: str = "patient_id",
    time: str = "event_time",
    days: int = 90,
    threshold: int = 3,
) -> StreamingQuery:
    """Count what has arrived, raise alerts, and stop; a restart goes on from ``checkpoint``.

    ``target`` holds the maintained table under ``counts`` and the alerts under
    ``alerts``, split by query and batch: at most one row per key and batch.
    """
    counts, alerts = f"{target}/counts", f"{target}/alerts"

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        with released(spark) as store:
            daily = store(add_batch(store(batch.select(key, time), "arrived"), counts, f"{query}-{number}", key, time), "daily")
            found = alerts_of(spark, daily, counts, key, days, threshold)
            found.write.mode("overwrite").parquet(f"{alerts}/query={query}/batch={number}")

    return (
        claims.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
