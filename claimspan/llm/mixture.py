"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source stand in a seeded random order, as often as the mix needs
them, and this stream is cut into blocks of about ``BLOCK_WORDS`` words; the last
one ends where the source's target is nearest. A tree halves the output shards
again and again; at each node the blocks are divided by a multivariate-hypergeometric
draw from the exact quotas of the sources. So each shard knows how many blocks it
draws from each source. The blocks of a source are permuted, and a shard draws
the next ones of them, which no other shard draws. A document is taken as often
as its copies stand in drawn blocks, and a shard's rows are shuffled inside it.
Only one row per source passes through the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, aliased, restored
from claimspan.llm.slices import hashable, position, running, slice_of, source_key

SEED = 20_240_617
BLOCK_WORDS = 65_536
MAX_REPEATS = 3
#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A mix names its sources, which the driver holds, one row each; beyond this many ``plan`` raises an error before it takes any.
MAX_SOURCES = 100_000


def word_count(text: str = "text") -> Column:
    """Words between white space (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Words to take from each source: shares by weight of the sum, none above ``most`` times its size.

    What a source can't take is shared anew, by weight, among the others.
    """
    size, weight = np.array(sizes, float), np.array(weights, float)
    out, open_ = np.zeros(len(size)), size > 0
    left = size.sum()
    while open_.any():
        share = np.where(open_, left * weight / weight[open_].sum(), 0)
        over = open_ & (share > most * size)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = most * size[over]
        left -= out[over].sum()
        open_ &= ~over
    return out.tolist()


def split_quotas(blocks: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks each shard (row) takes of each source (column).

    Sums of columns are ``blocks``; sums of rows differ by one at most.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(blocks)), np.int64)
    todo = [(0, shards, np.array(blocks, np.int64))]
    while todo:
        a, b, quota = todo.pop()
        if b - a == 1:
            out[a] = quota
            continue
        middle, total = (a + b) // 2, int(quota.sum())
        # of the node's blocks, dealt out as evenly as can be, those of its left shards
        each, more = divmod(total, b - a)
        left = each * (middle - a) + min(more, middle - a)
        drawn = _draw(rng, quota, left)
        todo += [(a, middle, drawn), (middle, b, quota - drawn)]
    return out


#: ``numpy`` draws from fewer blocks than this at a time.
_DRAWN = 10**9


def _draw(rng: np.random.Generator, quota: np.ndarray, n: int) -> np.ndarray:
    """A multivariate-hypergeometric draw, one source after another."""
    out, rest = np.zeros_like(quota), int(quota.sum())
    for i, q in enumerate(quota.tolist()):
        rest -= q
        if n and q:
            out[i] = _hypergeometric(rng, q, rest, n) if rest else n
        n -= int(out[i])
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` blocks drawn from ``good`` and ``bad`` ones are good; very many blocks are drawn as bundles."""
    bundle = -(-(good + bad) // (_DRAWN - 1))
    if bundle == 1:
        return int(rng.hypergeometric(good, bad, n))
    drawn = bundle * int(rng.hypergeometric(good // bundle, bad // bundle, min(n // bundle, (good // bundle) + (bad // bundle))))
    # what the bundles leave over is shared by expectation, within what there is
    drawn += round((n - n // bundle * bundle) * good / (good + bad))
    return min(max(drawn, n - bad, 0), good, n)


def _permutation(rng: np.random.Generator, blocks: int) -> tuple[int, int]:
    """A permutation of the blocks as (stride, shift): block b stands at (b * stride + shift) mod blocks."""
    if blocks < 2:
        return 1, 0
    stride = int(rng.integers(1, min(blocks, 2**20)))
    while np.gcd(stride, blocks) != 1:
        stride = stride % (min(blocks, 2**20) - 1) + 1
    return stride, int(rng.integers(blocks))


def plan(
    docs: DataFrame,
    shards: int = 8,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
    source: str = "source",
    seed: int = SEED,
    texts: bool = True,
) -> DataFrame:
    """Each document's part in the mix: ``docs`` with ``size`` (words), ``source_size``, ``target``,
    ``taken`` and ``copies``, an array of (copy, block, shard), empty for a document that is left out.

    A source that needs r times its words takes every document floor(r) times
    and, of its random order, the first ones once more until its target is
    nearest; one document is then added or taken back if that brings the sum
    nearer still. No document is cut, and none is taken more than ``most`` times.

    * Null is a source of its own, last in order. A null or empty text has size
      0; a source without words takes 0 words. Its documents are taken 0 times.
    * Equal rows may be taken unequally often; which of them is then open, but
      the rows of the result are the same in every run.
    * An empty table gives no rows. Columns named as results are replaced; all
      others keep their values. Without ``texts`` the text is left out.
    * More than 100,000 sources raise an error.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixture")
    mine = ["size", "source_size", "target", "taken", "copies"]
    kept = [c for c in docs.columns if c.lower() not in mine and (texts or c != text)]
    own, name, _ = aliased(docs)
    every = hashable(own.select(*[name[c] for c in docs.columns if c.lower() not in mine]))
    # Words are counted once: what follows reads the stored sizes and positions.
    base = scratch.table(
        own.select(
            *[name[c] for c in kept],
            word_count(name[text]).alias("size"),
            source_key(name[source]).alias("_src"),
            position(seed, *every).alias("_at"),
            F.xxhash64(F.lit(seed + 1), *every).alias("_tie"),
        ),
        "sized",
        keep=True,
    )
    found = base.groupBy("_src").agg(F.count("*").alias("_rows"), F.sum("size").alias("source_size"))
    rows = found.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them before mixing")
    rows.sort(key=lambda r: (r["_src"] == "", r["_src"]))  # "" is the null source
    sizes = [r["source_size"] for r in rows]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], most)
    known = []
    for r, aim in zip(rows, aims, strict=True):
        n = r["source_size"]
        full = min(int(aim // n), most) if n else 0
        need = max(0.0, aim - full * n) if full < most else 0.0
        known.append([r["_src"], r["_rows"], n, aim, full, need])
    quotas = [-(-round(aim) // block_words) for aim in aims]
    cuts = np.cumsum(split_quotas(quotas, shards, seed), axis=0).T.tolist()
    kind = (
        "_src string, _rows long, source_size long, target double, _full long, _need double, _blocks long,"
        " _cuts array<long>, _stride long, _shift long"
    )
    rng = np.random.default_rng(seed + 3)
    turns = [_permutation(rng, q) for q in quotas]
    sources = scratch.table(
        spark.createDataFrame([(*k, q, c, *t) for k, q, c, t in zip(known, quotas, cuts, turns, strict=True)], kind),
        "sources",
        keep=True,
    )
    dealt = running(
        base.join(sources, "_src").withColumn("_piece", slice_of(F.col("_at"), F.col("_rows"))),
        scratch, ["_src"], "_piece", [F.col("_at"), F.col("_tie")], {"_before": F.col("size")},
    )
    again = (F.col("size") > 0) & (F.col("_before") + F.col("size") / 2 <= F.col("_need"))
    dealt = dealt.withColumn("_again", again)
    moved = _nearest(dealt, scratch)
    # of equal rows, which share _tie, only the one at the given place is moved
    here = (F.col("_moved_before") == F.col("_before")) & (F.col("_moved_tie") == F.col("_tie"))
    extra = F.col("_again") != (F.coalesce(here, F.lit(False)) & (F.col("size") > 0))
    mixed = dealt.join(moved, F.col("_src") == F.col("_moved_src"), "left").withColumn(
        "_times", F.when(F.col("size") > 0, F.col("_full") + extra.cast("long")).otherwise(F.lit(0).cast("long"))
    )

    def copy(i: Column) -> Column:
        at = F.floor((i * F.col("source_size") + F.col("_before")) / F.lit(block_words)).cast("long")
        block = F.least(at, F.col("_blocks") - 1)
        # the place of the block among the permuted ones, and the shard whose draw it falls into
        drawn = F.pmod(block * F.col("_stride") + F.col("_shift"), F.col("_blocks"))
        shard = F.size(F.filter("_cuts", lambda cut: cut <= drawn))
        return F.struct(i.cast("int").alias("copy"), block.alias("block"), shard.alias("shard"))

    numbers = F.when(F.col("_times") > 0, F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    copies = F.filter(F.transform(numbers, copy), lambda c: c["shard"] < shards)
    found = mixed.withColumn("copies", copies).withColumn("taken", F.col("size") * F.size("copies"))
    return restored(found, {c: name[c] for c in kept}, ["size", "source_size", "target", "taken", "copies"])


def _nearest(dealt: DataFrame, scratch: Scratch) -> DataFrame:
    """For each source the document to add to or take from the last, partial round, if any helps."""
    taken = F.coalesce(F.sum(F.when(F.col("_again"), F.col("size"))), F.lit(0))
    gaps = scratch.table(
        dealt.groupBy("_src").agg((F.max("_need") - taken).alias("_gap")).where("_gap <> 0"), "gaps", keep=True
    ).withColumnRenamed("_src", "_gap_src")
    off = F.abs(F.col("size") - F.abs("_gap"))
    helps = (
        (F.col("size") > 0) & (off < F.abs("_gap")) & F.when(F.col("_gap") > 0, ~F.col("_again")).otherwise(F.col("_again"))
    )
    best = F.min(F.when(helps & (F.col("_need") > 0), F.struct(off.alias("off"), "_at", "_tie", "_before"))).alias("best")
    found = dealt.join(gaps, F.col("_src") == F.col("_gap_src")).groupBy("_src").agg(best).where("best is not null")
    return scratch.table(
        found.selectExpr("_src as _moved_src", "best._tie as _moved_tie", "best._before as _moved_before"),
        "moved",
        keep=True,
    )


def mix(docs: DataFrame, seed: int = SEED, text: str = "text", source: str = "source", **how: object) -> DataFrame:
    """The mixed documents: the rows of ``docs`` once per copy, with ``copy``, ``block``, ``shard`` and
    ``place``, the seeded random key by which a shard's rows are shuffled. Takes what ``plan`` takes.
    """
    rows, name, _ = aliased(docs)
    planned = plan(rows, text=name[text], source=name[source], seed=seed, **how)
    mixed = planned.withColumn("_copy", F.explode("copies")).select("*", "_copy.copy", "_copy.block", "_copy.shard")
    mixed = mixed.withColumn("place", position(seed + 2, *hashable(rows), F.col("copy")))
    return restored(mixed, name, ["copy", "block", "shard", "place"])


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", **how: object) -> DataFrame:
    """The rows of ``mix`` with the columns of ``docs`` alone."""
    rows, name, back = aliased(docs)
    return back(mix(rows, text=name[text], source=name[source], **how))
