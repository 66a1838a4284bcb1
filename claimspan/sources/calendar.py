"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_columns(days: DataFrame) -> DataFrame:
    """Describe each ``full_date`` of a (date_key, full_date) table."""
    return days.selectExpr(
        "cast(date_key as int) as date_key",
        "full_date",
        "day(full_date) as day",
        "month(full_date) as month",
        "date_format(full_date, 'MMMM') as month_name",
        "quarter(full_date) as quarter",
        "year(full_date) as year",
        "date_format(full_date, 'EEEE') as day_of_week",
        "cast(dayofweek(full_date) in (1, 7) as int) as is_weekend",
    )


def date_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``; ``date_key`` counts from 1."""
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("full_date"))
    return calendar_columns(days.withColumn("date_key", F.date_diff("full_date", first) + 1))


def calendar_between(dates: DataFrame, column: str) -> DataFrame:
    """The calendar from the earliest to the latest day found in ``column``;
    ``date_key`` counts the days since 1970-01-01."""
    span = dates.agg(
        F.min(F.col(column).cast("date")).alias("first"),
        F.max(F.col(column).cast("date")).alias("last"),
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return calendar_columns(days.withColumn("date_key", F.unix_date("full_date")))
