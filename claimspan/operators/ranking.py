"""Ranks over large groups and over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspan.operators.groups import null_safe_join, rows_within
from claimspan.operators.ordered import running_sums, sliced_running_sums
from claimspan.sources.scratch import written

# A global window is one task; this many small rows are fine there.
MAX_GLOBAL_ROWS = 200_000


def percent_rank_by_value(
    counts: DataFrame, key: str, value: str, n: str, max_group_rows: int = MAX_GLOBAL_ROWS
) -> DataFrame:
    """The percent rank of each value within its key, from a stored table of
    (key, value, number of rows).

    Equal values share a rank, so one row per distinct value is enough: the
    rank is (rows with a lower value) / (rows - 1), or 0 for a single row.
    """
    sizes = counts.groupBy(key).agg(F.sum(n).alias("_total"))
    upto = running_sums(counts, [key], [F.col(value)], {"_upto": F.col(n)}, max_group_rows)
    below = F.col("_upto") - F.col(n)
    rank = F.when(F.col("_total") > 1, below / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    return null_safe_join(upto, sizes, [key]).select(key, value, rank.alias("percent_rank"))


def ranked_with_tiles(
    df: DataFrame,
    by: str,
    tie_break: str,
    rank_name: str,
    tile_name: str,
    tiles: int = 4,
    dense: bool = True,
    max_rows: int = MAX_GLOBAL_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Rank the whole table by ``by`` descending, and cut it into ``tiles``
    equal parts (ties in ``by`` are placed by ``tie_break``)."""
    order: list[Column] = [F.col(by).desc_nulls_first(), F.col(tie_break).asc()]
    if rows_within(df, max_rows):
        ranked = Window.orderBy(F.col(by).desc_nulls_first())
        rank = F.dense_rank() if dense else F.rank()
        return df.withColumns(
            {rank_name: rank.over(ranked), tile_name: F.ntile(tiles).over(Window.orderBy(*order))}
        )

    # Larger tables: number the rows slice by slice, and rank the distinct
    # values the same way.
    rows = sliced_running_sums(df, [], order, {"_seq": F.lit(1)}, slices)
    values = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    placed = sliced_running_sums(
        values,
        [],
        [F.col(by).desc_nulls_first()],
        {"_dense": F.lit(1), "_upto": F.col("_n")},
        slices,
    )
    rank = F.col("_dense") if dense else F.col("_upto") - F.col("_n") + 1
    ranks = written(placed.select(by, rank.cast("int").alias(rank_name)), "value-ranks")
    total = df.agg(F.count(F.lit(1))).scalar()
    small, extra = F.floor(total / tiles), total % tiles
    cut = extra * (small + 1)
    tile = F.when(
        F.col("_seq") <= cut, F.floor((F.col("_seq") - 1) / (small + 1)) + 1
    ).otherwise(extra + F.floor((F.col("_seq") - 1 - cut) / small) + 1)
    return (
        null_safe_join(rows, ranks, [by])
        .withColumn(tile_name, tile.cast("int"))
        .select(*df.columns, rank_name, tile_name)
    )
