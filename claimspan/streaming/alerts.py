"""Claim-frequency alerts on a stream.

Windows slide by whole UTC days, so a count covers the days of a window and not,
as in the batch report, the 90 days before each single claim.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _utc_day(instant: str) -> Column:
    # Windows are cut at UTC midnight whatever the session's time zone is.
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(instant)) / 86400).cast("int"))


def frequency_alerts(
    claims: DataFrame,
    key: str = "patient_id",
    time: str = "event_time",
    days: int = 90,
    threshold: int = 3,
    lateness: str = "7 days",
) -> DataFrame:
    """Keys with at least ``threshold`` claims within ``days`` days.

    Claims are first counted per key and day; these counts are then copied into
    the ``days`` windows that hold them, which the state keeps until the
    watermark closes them. ``daily_counts`` keeps one row per key and day
    instead, and covers the last days of a stream.
    """
    daily = (
        claims.withWatermark(time, lateness)
        .groupBy(F.window(time, "1 day"), key)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sliding = daily.groupBy(
        F.window(F.window_time("window"), f"{days} days", "1 day").alias("span"), key
    ).agg(F.sum("n").alias("claims"))
    return sliding.where(F.col("claims") >= threshold).select(
        key,
        _utc_day("span.start").alias("from_day"),
        _utc_day("span.end").alias("before_day"),
        "claims",
    )
