"""Per-patient claim sequences: trailing counts, running totals, rising runs.

Trailing counts are taken over one row per patient and day. The others take the
usual way (one window per patient) for ordinary patients, and a way that spreads
a patient over many tasks for those with more than ``max_group_rows`` claims.
Both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspan.operators.groups import MAX_GROUP_ROWS, hot_keys, null_safe_join, split
from claimspan.operators.ordered import sliced_running_sums
from claimspan.sources.scratch import written

_BLOCK = 4096


def _day(column: str):
    return F.unix_date(F.col(column)).cast("long")


def trailing_days(claims: DataFrame, key: str, date: str, days: int, name: str) -> DataFrame:
    """(key, date, number of rows of the key in the ``days`` days up to and including the date), one row per day.

    The count depends on the day alone. Rows are combined to one per day before
    the shuffle, so a key has no more rows than the calendar has days, however
    many claims it has.
    """
    daily = claims.groupBy(key, date).agg(F.count(F.lit(1)).alias(name))
    w = Window.partitionBy(key).orderBy(_day(date)).rangeBetween(-days, 0)
    return daily.select(key, date, F.sum(name).over(w).alias(name))


def trailing_count(claims: DataFrame, key: str, date: str, days: int, name: str) -> DataFrame:
    """Add the number of rows of the same key in the ``days`` days up to and
    including the row's day (all rows of that day count)."""
    counted = trailing_days(claims, key, date, days, name)
    return null_safe_join(claims, counted, [key, date])


def running_totals(
    claims: DataFrame,
    key: str,
    date: str,
    tie_break: str,
    amount: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add ``running_total`` (row by row, ties by ``tie_break``) and
    ``cumulative_count`` (all rows of the same day share one value)."""
    by_row = Window.partitionBy(key).orderBy(date, tie_break).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # RANGE over the same two keys would split the day; over the date it does not.
    by_day = Window.partitionBy(key).orderBy(date).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    plain = {
        "running_total": F.sum(amount).over(by_row),
        "cumulative_count": F.count(F.lit(1)).over(by_day),
    }
    heavy = hot_keys(claims, key, max_group_rows)
    if heavy is None:
        return claims.withColumns(plain)

    usual, rows = split(claims, heavy, key)
    usual = usual.withColumns(plain)
    totals = sliced_running_sums(
        rows, [key], [F.col(date), F.col(tie_break)], {"running_total": F.col(amount)}, slices
    )
    daily = rows.groupBy(key, date).agg(F.count(F.lit(1)).alias("_n"))
    counted = written(
        daily.select(key, date, F.sum("_n").over(by_day).alias("cumulative_count")), "daily-counts"
    )
    return usual.unionByName(null_safe_join(totals, counted, [key, date]).select(*usual.columns))


def next_two(
    claims: DataFrame,
    key: str,
    date: str,
    tie_break: str,
    value: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
    block: int = _BLOCK,
) -> DataFrame:
    """(key, current, second, third): each row's value with those of the next
    two rows of its key in date order; NULL past the end."""
    rows = claims.select(key, date, tie_break, value)

    def led(df: DataFrame, w) -> DataFrame:
        return df.withColumns(
            {"second": F.lead(value, 1).over(w), "third": F.lead(value, 2).over(w)}
        )

    out = [key, F.col(value).alias("current"), "second", "third"]
    in_order = Window.partitionBy(key).orderBy(date, tie_break)
    heavy = hot_keys(rows, key, max_group_rows)
    if heavy is None:
        return led(rows, in_order).select(*out)

    usual, many = split(rows, heavy, key)
    usual = led(usual, in_order).select(*out)
    # Number the rows, cut the numbers into blocks, and lend each block the
    # first two rows of the next.
    numbered = sliced_running_sums(
        many,
        [key],
        [F.col(date), F.col(tie_break)],
        {"_seq": F.lit(1)},
        slices,
    )
    own = F.call_function("div", F.col("_seq") - 1, F.lit(block))
    lent = ((F.col("_seq") - 1) % block < 2) & (own > 0)
    blocks = numbered.withColumn("_own", own).withColumn(
        "_block", F.explode(F.when(lent, F.array("_own", F.col("_own") - 1)).otherwise(F.array("_own")))
    )
    in_block = Window.partitionBy(key, "_block").orderBy("_seq")
    large = led(blocks, in_block).where(F.col("_block") == F.col("_own")).select(*out)
    return usual.unionByName(large)
