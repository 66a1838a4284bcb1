"""Find groups too large for one task, and joins that treat NULL keys as equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.sources.scratch import written

# A window over this many rows of one key is a comfortable single task.
MAX_GROUP_ROWS = 200_000


def hot_keys(df: DataFrame, keys: str | list[str], max_rows: int) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows as a stored table, or None.

    Counting combines on the map side, so the heavy keys themselves are cheap
    to find. There can be no more than total rows / ``max_rows`` of them.
    """
    keys = [keys] if isinstance(keys, str) else keys
    heavy = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > max_rows)
        .select(*keys)
    )
    stored = written(heavy, "hot-keys")
    return None if stored.isEmpty() else stored


def split(df: DataFrame, heavy: DataFrame, keys: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of the ordinary keys, and rows of the heavy ones."""
    keys = [keys] if isinstance(keys, str) else keys
    return tuple(null_safe_join(df, heavy, keys, how) for how in ("left_anti", "left_semi"))


def rows_within(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows. Meant for stored tables, whose
    rows are counted from the file footers."""
    return df.count() <= bound


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; keeps the left key columns."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    renamed_keys = [f"_r_{k}" for k in keys]
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    condition = match[0]
    for more in match[1:]:
        condition = condition & more
    return left.join(renamed, condition, how).drop(*renamed_keys)
