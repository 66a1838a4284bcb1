"""Running sums over ordered groups of any size.

Spark runs each window partition in one task. That is right for ordinary
groups. A group that outgrows a task is cut into contiguous slices by a range
partitioning on (keys, order): Spark samples the rows, so slices are even
however the keys are spread. Sums run inside each slice, and each slice adds
the total of the slices before it in its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspan.operators.groups import (
    MAX_GROUP_ROWS,
    hot_keys,
    null_safe_join,
    rows_within,
    split,
)
from claimspan.sources.scratch import written

_SLICE = "_slice"


def _in_slices(df: DataFrame, keys: list[str], order: list[Column], slices: int | None) -> DataFrame:
    columns = [*[F.col(k) for k in keys], *order]
    ranged = (
        df.repartitionByRange(slices, *columns) if slices else df.repartitionByRange(*columns)
    )
    # Stored once, so that every later step sees the same slices.
    return written(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")


def sliced_running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    sums: dict[str, Column],
    slices: int | None = None,
) -> DataFrame:
    """``running_sums`` for groups that do not fit one task."""
    rows = _in_slices(df, keys, order, slices)
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = rows.withColumns({name: F.sum(value).over(inside) for name, value in sums.items()})

    # One row per (group, slice): a group has at most as many as there are slices.
    totals = rows.groupBy(*keys, _SLICE).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        _SLICE,
        F.lag(F.lit(True)).over(Window.partitionBy(*keys).orderBy(_SLICE)).alias("_continues"),
        *[F.sum(n).over(earlier).alias(f"_before_{n}") for n in sums],
    ).where("_continues").drop("_continues")
    # Slices are contiguous in the sort order, so only one group can continue
    # into each: offsets has fewer rows than there are slices, small enough to
    # broadcast however large the data.
    joined = null_safe_join(local, F.broadcast(offsets), [*keys, _SLICE], "left")
    return joined.withColumns(
        # A sum is NULL as long as it has met only NULLs, in this slice or in those before.
        {n: F.coalesce(F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0)), F.col(f"_before_{n}")) for n in sums}
    ).select(*df.columns, *sums)


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    sums: dict[str, Column],
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add, per group of ``keys`` and in ``order``, the sum of each expression
    over the rows up to and including the current one.

    ``df`` is a stored table and ``order`` is total within a group. Groups above ``max_group_rows``
    take the sliced way, all others one window.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    plain = {name: F.sum(value).over(w) for name, value in sums.items()}

    if rows_within(df, max_group_rows):
        return df.withColumns(plain)
    if not keys:
        return sliced_running_sums(df, keys, order, sums, slices)
    heavy = hot_keys(df, keys, max_group_rows)
    if heavy is None:
        return df.withColumns(plain)
    usual, large = split(df, heavy, keys)
    return usual.withColumns(plain).unionByName(
        sliced_running_sums(large, keys, order, sums, slices)
    )


#: Size of a percentile sketch; its ranks are off by less than a third of ``SKETCH_MARGIN``.
SKETCH_SIZE = 2048
SKETCH_MARGIN = 0.006


def percentile_sketch(value: str) -> Column:
    """A mergeable sketch of a whole-number column, to be taken in the same aggregate as other columns."""
    return F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(SKETCH_SIZE))


def sketched_brackets(stats: DataFrame, keys: list[str], sketch: str, fractions: dict[str, float]) -> DataFrame:
    """For ``exact_percentiles``: (keys, _total, _ends) from the sketches in ``stats``; groups without a value are left out."""
    ranks = [min(max(p + d, 0.0), 1.0) for p in sorted(fractions.values()) for d in (-SKETCH_MARGIN, SKETCH_MARGIN)]
    n = F.kll_sketch_get_n_bigint(sketch)
    found = F.when(n > 0, F.kll_sketch_get_quantile_bigint(sketch, F.array(*[F.lit(r) for r in ranks])))
    return stats.select(*keys, n.alias("_total"), found.alias("_ends")).where(F.col("_total") > 0)


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    fractions: dict[str, float],
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
    accuracy: int = 1000,
    brackets: DataFrame | None = None,
) -> DataFrame:
    """Interpolated percentiles per group, one column per name in ``fractions``.

    Sketches bracket each percentile first (``brackets``, if the caller has
    taken them in an aggregate of its own). A second pass counts every value
    inside the brackets and merely the number of rows between them, so almost
    nothing is shuffled and no task holds a group. A group with a rank that falls
    outside its bracket is noticed and counted over all its values instead. NULL
    values are left out.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    if brackets is None:
        margin = 5 / accuracy
        ends = [min(max(p + d, 0.0), 1.0) for p in sorted(fractions.values()) for d in (-margin, margin)]
        brackets = written(_brackets(rows, keys, value, ends, accuracy), "brackets")
    known = null_safe_join(rows, brackets, keys)
    inside = None
    for i in range(0, 2 * len(fractions), 2):
        one = F.col(value).between(F.col("_ends")[i], F.col("_ends")[i + 1])
        inside = one if inside is None else inside | one
    # Rows between brackets stand right after the bracket end below them.
    passed = [F.when(F.col("_ends")[i] < F.col(value), F.col("_ends")[i]) for i in range(2 * len(fractions))]
    below = F.greatest(*passed)  # NULL below the first bracket
    cells = known.select(
        *keys,
        "_total",
        F.when(inside, F.col(value)).otherwise(below).alias("_value"),
        (~inside).cast("int").alias("_gap"),
    )
    found = written(
        _at_ranks(cells, keys, fractions, max_group_rows, slices), "percentile-ranks"
    )
    missed = None
    for name in fractions:
        gap = (F.col(f"_lo_{name}._gap") == 1) | (F.col(f"_hi_{name}._gap") == 1)
        missed = gap if missed is None else missed | gap
    if not found.where(missed).isEmpty():
        again = null_safe_join(known, found.where(missed).select(*keys), keys, "left_semi")
        everything = again.select(
            *keys, "_total", F.col(value).alias("_value"), F.lit(0).alias("_gap")
        )
        found = found.where(~missed).unionByName(_at_ranks(everything, keys, fractions, max_group_rows, slices))

    def between(name: str, p: float) -> Column:
        place = (F.col("_total") - 1) * F.lit(p)
        lo, hi = F.col(f"_lo_{name}._value"), F.col(f"_hi_{name}._value")
        return lo + (hi - lo) * (place - F.floor(place))

    return found.select(*keys, *[between(n, p).alias(n) for n, p in fractions.items()])


# Tasks that share out the merging of one group's sketches.
_MERGERS = 64


def _brackets(
    rows: DataFrame, keys: list[str], value: str, ends: list[float], accuracy: int
) -> DataFrame:
    """Per group, the row count and a close estimate of the given percentiles.

    Every task that reads rows sends one sketch per group. They are merged in
    ``_MERGERS`` parts and then the parts' quantiles are pooled by weight, so
    that no single task merges the sketches of the whole cluster.
    """
    kind = rows.schema[value].dataType
    grid = F.expr(f"array({', '.join(f'{(i + 0.5) / accuracy}D' for i in range(accuracy))})")
    parts = (
        rows.withColumn("_part", F.spark_partition_id() % _MERGERS)
        .groupBy(*keys, "_part")
        .agg(
            F.percentile_approx(value, grid, F.lit(accuracy)).alias("_grid"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    pooled = parts.select(*keys, "_n", F.explode("_grid").alias("_v")).groupBy(*keys).agg(
        # At most accuracy * _MERGERS points per group.
        F.percentile("_v", F.array(*[F.lit(e) for e in ends]), F.col("_n")).alias("_at"),
        F.call_function("div", F.sum("_n"), F.lit(accuracy)).alias("_total"),
    )
    whole = isinstance(kind, T.IntegralType)
    rounded = [
        ((F.ceil if i % 2 else F.floor)(F.col("_at")[i]) if whole else F.col("_at")[i]).cast(kind)
        for i in range(len(ends))
    ]
    return pooled.select(*keys, "_total", F.array(*rounded).alias("_ends"))


def _at_ranks(
    cells: DataFrame,
    keys: list[str],
    fractions: dict[str, float],
    max_group_rows: int,
    slices: int | None,
) -> DataFrame:
    """Per group, the cells at the two ranks around each percentile."""
    counts = written(
        cells.groupBy(*keys, "_total", "_value", "_gap").agg(F.count(F.lit(1)).alias("_n")),
        "value-counts",
    )
    order = [F.col("_value").asc_nulls_first(), F.col("_gap")]
    upto = running_sums(counts, keys, order, {"_upto": F.col("_n")}, max_group_rows, slices)
    found = []
    for name, p in fractions.items():
        place = (F.col("_total") - 1) * F.lit(p)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            # The cell at a rank is the first with more rows up to it.
            cell = F.when(F.col("_upto") > rank, F.struct("_value", "_gap"))
            found.append(F.min(cell).alias(f"_{side}_{name}"))
    return upto.groupBy(*keys, "_total").agg(*found)
