"""Sharding by proportional stratified interleaving, from DataFrame functions only.

Rows are put in a seeded random order within their source, and each gets the
fraction of its source that stands before it. Sorting all rows by that fraction
mixes the sources evenly; cutting the sorted rows at equal counts gives shards
that each hold every source in its share, and whose sizes differ by one row at
most. No source and no shard is ever gathered in one task (see ``slices``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, aliased, restored
from claimspan.llm.slices import hashable, position, running, slice_of, source_key

SEED = 20_240_611


def interleave(docs: DataFrame, shards: int = 8, source: str = "source", seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0, no gaps).

    The shards differ by one row at most, and each holds a source's share of
    the rows to within one row for every source.

    * A null source is a source of its own. Nulls elsewhere and empty or very
      long texts are carried along; they have no part in the order but for the
      hash of the row.
    * Repeated rows all stay; equal rows stand side by side in their source, so
      their slots are exchangeable and the result is the same in every run.
    * Fewer rows than shards leave shards empty; an empty table gives no rows.
    * Columns already named ``shard`` or ``slot`` are replaced; all others keep
      their values, whatever their names. Rows that differ only in columns that
      cannot be hashed (maps) count as equal: their slots may differ between runs.
    """
    scratch = Scratch(docs.sparkSession, "interleave")
    rows, names, _ = aliased(docs)
    kept = [new for old, new in names.items() if old.lower() not in ("shard", "slot")]
    every = hashable(rows.select(*kept))
    base = rows.select(
        *kept,
        source_key(names[source]).alias("_src"),
        position(seed, *every).alias("_at"),
        F.xxhash64(F.lit(seed + 1), *every).alias("_tie"),
    )
    sizes = scratch.table(base.groupBy("_src").agg(F.count("*").alias("_rows")), "sources", keep=True)
    total = sizes.agg(F.sum("_rows")).first()[0] or 0
    ranked = running(
        base.join(sizes, "_src").withColumn("_piece", slice_of(F.col("_at"), F.col("_rows"))),
        scratch, ["_src"], "_piece", [F.col("_at"), F.col("_tie")], {"_rank": F.lit(1)},
    )
    share = (F.col("_rank") + F.lit(0.5)) / F.col("_rows")
    placed = running(
        ranked.withColumn("_share", share).withColumn("_cut", slice_of(F.col("_share"), F.lit(total))),
        scratch, [], "_cut", [F.col("_share"), F.col("_src"), F.col("_rank")], {"_place": F.lit(1)},
    )
    shard = F.expr(f"_place * {shards}L div {max(total, 1)}L")
    first = F.expr(f"(_shard * {total}L + {shards - 1}L) div {shards}L")
    placed = placed.withColumn("_shard", shard)
    placed = placed.withColumn("shard", F.col("_shard").cast("int")).withColumn("slot", F.col("_place") - first)
    return restored(placed, names, ["shard", "slot"])


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, its rows in slot order within each file."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
