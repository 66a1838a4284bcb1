"""Running totals over long groups, without one task holding a group.

Rows get a seeded random position in [0, 1). A group is cut at even positions
into slices of about ``SLICE_ROWS`` rows; a window runs inside each slice and
the totals of the slices before it are added. Only the small table of slice
totals is summed group by group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspan.llm.common import Scratch

SLICE_ROWS = 4096


def hashable(df: DataFrame) -> list[Column]:
    """Columns that can be hashed and ordered: all but maps, variants and what holds them."""

    def fits(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(fits(f.dataType) for f in kind)
        if isinstance(kind, T.ArrayType):
            return fits(kind.elementType)
        return isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)

    return [F.col(f"`{f.name}`") for f in df.schema if fits(f.dataType)]


def position(seed: int, *columns: Column) -> Column:
    """A pseudo-random double in [0, 1) that depends on the seed and the columns alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits.cast("double") / F.lit(float(2**53))


def slice_of(at: Column, rows: Column) -> Column:
    """The slice of a position in [0, 1) in a group of so many rows."""
    n = F.greatest(F.ceil(rows / F.lit(SLICE_ROWS)).cast("long"), F.lit(1))
    return F.least(F.floor(at * n).cast("long"), n - 1)


def source_key(source: str) -> Column:
    """A source as a key that is never null and keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))


def running(
    df: DataFrame, scratch: Scratch, group: list[str], piece: str, order: list[Column], totals: dict[str, Column]
) -> DataFrame:
    """``df`` with, for each name of ``totals``, the sum over the rows of the group before this one.

    Rows stand in the order of ``piece`` and then of ``order``, which must fix
    the order whatever the partitions are. Group columns must not be null.
    """
    sums = df.groupBy(*group, piece).agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    earlier = (Window.partitionBy(*group) if group else Window).orderBy(piece).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = scratch.table(
        sums.select(
            *[F.col(g).alias(f"_at_{g}") for g in [*group, piece]],
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals],
        ),
        f"slices-{piece}",
        keep=True,
    )
    inside = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_in_{n}") for n, c in totals.items()]
    )
    return local.join(before, [F.col(g) == F.col(f"_at_{g}") for g in [*group, piece]]).select(
        *[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in totals]
    )
