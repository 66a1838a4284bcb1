"""Near-duplicate documents by MinHash with tensored banding; every link is verified.

A document is the set of its word shingles. ``GROUPS`` small collections of
``PER_GROUP`` minimum hashes each are computed; every pair of collections forms
the key of one table, so 13 x 2 hash functions serve 78 tables of 4 hashes
each, for which plain banding would compute 312. Two documents are candidates
if two of their collections agree. At a similarity of s a collection agrees
with probability p = s^2, so a pair is missed with (1-p)^13 + 13 p (1-p)^12:
0.0004 at 0.75, under 0.00003 at 0.8. That is the only approximation.

Equal sets are merged first. In each bucket the members are compared with one
of them, the pivot, and linked ones form components; only then are members of
*different* components of a bucket compared with each other, all of them. So a
large group of copies costs about one comparison a member and no link between
components is left out. Pairs that cannot be similar enough are not compared:
by the sizes of the sets, by how many shingles of a set no other open document
has, and by the bits that differ in bitmaps of the sets. All three bound what is
shared from above, so no link is lost. A comparison reads the whole texts of both documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, aliased, arrow, batch_of, chunks, map_arrow, utf8
from claimspan.llm.graph import components
from claimspan.llm.words import NOT_SPACE, mix, shingles, words

SHINGLE = 5
PERCENT = 75
GROUPS = 13
PER_GROUP = 2
#: Members of one pivot that are compared in one run; a larger star is split into several.
STAR_ROWS = 128
#: 64-bit words of the bitmap of a document that stands in for its set where pairs are ruled out.
MAP_WORDS = 16

_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, GROUPS * PER_GROUP, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)


def _sets(batch: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(batch.column("text"))
    return shingles(words(data, offsets, NOT_SPACE), shingle)


def _group_values(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The value of each collection (column) for each non-empty set (row)."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.zeros((len(starts), GROUPS), np.uint64)
    if len(starts):
        for k, factor in enumerate(_FACTORS):
            x = hashes * factor
            x ^= x >> np.uint64(32)
            least = np.minimum.reduceat(x * np.uint64(0x9FB21C651E98DF25), starts)
            out[:, k // PER_GROUP] = mix(out[:, k // PER_GROUP] + least)
    return out


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, n_shingles long, digest binary, groups array<long>"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            bounds, hashes = _sets(batch, shingle)
            sizes = np.diff(bounds)
            marks = [
                hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            ]
            values = _group_values(bounds, hashes)
            ends = np.concatenate([[0], np.cumsum((sizes > 0) * GROUPS)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1).view(np.int64)))
            yield batch_of(schema, batch.column("id"), sizes.astype(np.int64), marks, lists.cast(schema.field(3).type))

    return map_arrow(docs, run, ddl)


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    ``a`` is a pivot with one or many ``b``. A pivot's texts stand before those
    of its members in a sorted partition, so a task holds one set at a time.
    """
    pairs = scratch.table(pairs, "pairs")
    large = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(STAR_ROWS)).cast("int").alias("parts")).where("parts > 1")
    large = scratch.table(large, "stars")
    split = pairs.join(large, "a", "left").select("a", "b", F.coalesce("parts", F.lit(1)).alias("parts"))
    members = split.select(
        "a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("id"), F.lit(1).alias("role")
    )
    pivots = (
        pairs.select("a").distinct().join(large, "a", "left")
        .select("a", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        .select("a", "part", F.col("a").alias("id"), F.lit(0).alias("role"))
    )
    dealt = (
        members.union(pivots).join(texts, "id").repartition("a", "part").sortWithinPartitions("a", "part", "role")
        .select("a", "id", "role", "text")
    )
    kind = pairs.schema["a"].dataType.simpleString()
    ddl = f"a {kind}, b {kind}"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, held = None, []
        for batch in chunks(batches, "text"):
            bounds, hashes = _sets(batch, shingle)
            a, b, role = (batch.column(c).to_pylist() for c in ("a", "id", "role"))
            linked = []
            for i in range(len(a)):
                own = hashes[bounds[i] : bounds[i + 1]]
                if role[i] == 0:
                    held = [*held, own.copy()] if a[i] == pivot else [own.copy()]
                    pivot = a[i]
                elif a[i] == pivot and any(_similar(own, other, percent) for other in held):
                    linked.append((a[i], b[i]))
            yield batch_of(schema, [x for x, _ in linked], [y for _, y in linked])

    return scratch.table(map_arrow(dealt, run, ddl), "links")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    both = int((x[at] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``, ``kept``) for each row of ``docs``.

    Two documents are linked if their sets share at least ``percent`` % of
    their union. ``component_id`` is the smallest id that can be reached over
    links; ``kept`` marks the rows that bear it.

    * A null text, or one without words, has no shingles and is linked with
      nothing: it is its own component. A text of fewer words than a shingle
      has its whole sequence as its only shingle.
    * Repeated rows share a component and are kept or not together; rows with
      one id and different texts are judged each by its own text.
    * A null id is linked with nothing and kept; its ``component_id`` is null.
    * Very long texts are read whole. An empty table gives no rows. Other
      columns of ``docs`` have no part, whatever their names.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    with Scratch(spark, "neardup") as scratch:
        signed = scratch.table(_signatures(named, shingle), "signatures")
        full = signed.where("digest is not null and id is not null")
        copies = scratch.table(
            full.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "copies"
        )
        reps = full.join(copies.selectExpr("digest", "rep as id"), ["digest", "id"]).select("id", "n_shingles", "groups")
        labels = _link(reps, named, shingle, percent, scratch)
        owner = (
            copies.join(labels, F.col("rep") == F.col("node"), "left")
            .where("rows > 1 or node is not null")
            .selectExpr("digest as of_digest", "coalesce(component, rep) as owner")
        )
        grouped = full.join(owner, F.col("digest") == F.col("of_digest"), "left").select(
            "id", "n_shingles", F.coalesce("owner", "id").alias("component_id")
        )
        alone = signed.where("digest is null or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
        return scratch.table(
            grouped.union(alone).select(
                F.col("id").alias(doc_id),
                "n_shingles",
                "component_id",
                F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
            ),
            "result",
            keep=True,
        )


def _link(reps: DataFrame, named: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """(node, component) of the documents that are linked with a different text."""
    keys = F.array(
        *[
            F.struct(
                F.xxhash64(F.lit(i * GROUPS + j), F.col("groups")[i], F.col("groups")[j]).alias("key"),
                F.lit(i).alias("i"),
                F.lit(j).alias("j"),
            )
            for i, j in combinations(range(GROUPS), 2)
        ]
    )
    rows = reps.select("id", F.col("n_shingles").cast("int").alias("n"), F.inline(keys))
    # Counts and pivots are combined before the shuffle, so a frequent key costs no task more than a rare one;
    # rows then meet the keys that several of them have in a join, which splits a frequent one.
    pivot = F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("pivot")
    shared = scratch.table(
        rows.groupBy("key").agg(F.count("*").alias("rows"), pivot).where("rows > 1")
        .selectExpr("key as shared_key", "pivot.id as pivot", "pivot.n as pivot_n"),
        "shared",
    )
    members = scratch.table(
        rows.join(shared, F.col("key") == F.col("shared_key")).select("key", "i", "j", "id", "n", "pivot", "pivot_n"), "members"
    )
    fits = "id <> pivot and 100L * least(n, pivot_n) >= {p}L * greatest(n, pivot_n)".format(p=percent)
    star = scratch.table(
        members.where(fits).groupBy("id", "pivot").agg(F.count("*").alias("tables")), "star"
    )
    texts = scratch.table(named.join(members.select("id").distinct(), "id", "left_semi"), "texts")

    # Each member with the pivot it shares most tables with.
    first = star.groupBy("id").agg(F.max(F.struct("tables", "pivot")).alias("best")).selectExpr("best.pivot a", "id b")
    done = scratch.table(first, "first")
    links = _verified(done, texts, shingle, percent, scratch)
    labels = components(links, scratch)

    # Members of buckets that still hold several components, with how many of their shingles another one has.
    open_ = _open(members, labels, scratch)
    own = scratch.table(_own(texts.join(open_.select("id").distinct(), "id", "left_semi"), shingle), "own")
    open_ = open_.join(own, "id", "left").selectExpr("key", "i", "j", "id", "n", "n - coalesce(own, 0L) as s")
    # Even the best partner has no more than these in common.
    open_ = scratch.table(open_.where(f"100L * s >= {percent}L * n"), "hopeful")

    # The other pivots, where they stand in another component.
    near = open_.select("id", "n", "s").distinct()
    more = (
        _apart(star.selectExpr("pivot a", "id b"), labels).join(done, ["a", "b"], "left_anti")
        .join(near.selectExpr("id as a", "n as a_n", "s as a_s"), "a")
        .join(near.selectExpr("id as b", "n as b_n", "s as b_s"), "b")
        .where(_enough("a_n", "a_s", "b_n", "b_s", percent)).select("a", "b")
    )
    more = scratch.table(more, "more")
    if not more.isEmpty():
        done = scratch.table(done.union(more), "done")
        links = scratch.table(links.union(_verified(more, texts, shingle, percent, scratch)), "links")
        labels = components(links, scratch)

    # Whatever still stands in different components of one bucket, each pair from the first bucket it shares.
    open_ = _open(open_.select("key", "i", "j", "id", "n", "s"), labels, scratch)
    # (the collections before the later one of this table, but for the first: none of them may agree)
    tagged = F.array(*[F.xxhash64(F.lit(k), F.col("groups")[k]) for k in range(GROUPS)]).alias("tagged")
    values = reps.join(open_.select("id").distinct(), "id", "left_semi").select("id", tagged)
    before = F.array_except(F.slice("tagged", F.lit(1), F.col("j")), F.array(F.col("tagged")[F.col("i")]))
    maps = scratch.table(_bitmaps(texts.join(open_.select("id").distinct(), "id", "left_semi"), shingle), "bitmaps")
    open_ = open_.join(values.join(maps, "id"), "id").withColumn("before", before).drop("tagged", "i", "j")
    open_ = scratch.table(open_, "crossing-members")
    other = open_.select("key", F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in open_.columns if c not in ("key", "id")])
    # each bit that one has and the other has not is a shingle at least that they do not share
    differ = " + ".join(f"bit_count(m{k} & ~b_m{k})" for k in range(MAP_WORDS))
    crossing = (
        open_.join(other, "key")
        .where("component <> b_component and id < b")
        .where(_enough("n", "s", "b_n", "b_s", percent))
        .where(f"{100 + percent}L * (n - ({differ})) >= {percent}L * (n + b_n)")
        .where("not arrays_overlap(before, b_before)")
        .selectExpr("id as a", "b")
        .distinct()
        .join(done, ["a", "b"], "left_anti")
        .join(done.selectExpr("b as a", "a as b"), ["a", "b"], "left_anti")
    )
    crossing = scratch.table(crossing, "crossing")
    if not crossing.isEmpty():
        links = scratch.table(links.union(_verified(crossing, texts, shingle, percent, scratch)), "links")
        labels = components(links, scratch)
    return labels


def _enough(n: str, s: str, other_n: str, other_s: str, percent: int) -> str:
    """Whether two sets can be similar enough, by their sizes and by how much of each is shared with any other."""
    return (
        f"{100 + percent}L * least({s}, {other_s}) >= {percent}L * ({n} + {other_n})"
        f" and 100L * least({n}, {other_n}) >= {percent}L * greatest({n}, {other_n})"
    )


def _open(members: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of buckets with more than one component, and their components."""
    placed = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    ends = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return scratch.table(placed.join(ends.where("low < high").select("key"), "key"), "open")


def _own(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, own): how many shingles of a document no other document of ``texts`` has, where there are any."""
    kind = texts.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, h long"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            bounds, hashes = _sets(batch, shingle)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            yield batch_of(schema, batch.column("id").take(pa.array(owner)), hashes.view(np.int64))

    rows = map_arrow(texts, run, ddl)
    alone = rows.groupBy("h").agg(F.count("*").alias("rows"), F.min("id").alias("id")).where("rows = 1")
    return alone.groupBy("id").agg(F.count("*").alias("own"))


def _bitmaps(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, m0, m1 ...): for each document the bits at which its shingles fall in ``64 * MAP_WORDS``."""
    kind = texts.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, " + ", ".join(f"m{k} long" for k in range(MAP_WORDS))
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            bounds, hashes = _sets(batch, shingle)
            out = np.zeros((batch.num_rows, MAP_WORDS * 64), np.uint8)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            out[owner, (hashes % np.uint64(64 * MAP_WORDS)).astype(np.int64)] = 1
            words_ = np.packbits(out, axis=1, bitorder="little").view(np.int64)
            yield batch_of(schema, batch.column("id"), *[np.ascontiguousarray(words_[:, k]) for k in range(MAP_WORDS)])

    return map_arrow(texts, run, ddl)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    left = labels.selectExpr("node a", "component a_component")
    right = labels.selectExpr("node b", "component b_component")
    return (
        pairs.join(left, "a", "left").join(right, "b", "left")
        .where("coalesce(a_component, a) <> coalesce(b_component, b)").select("a", "b")
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", **how: object) -> DataFrame:
    """The rows of ``docs`` without the near duplicates: the smallest id of each component stays."""
    text = how.pop("text", "text")
    rows, names, back = aliased(docs)
    found = near_duplicates(rows, names[doc_id], names[text], **how)
    gone = found.where("not kept").select(F.col(names[doc_id]).alias("gone")).distinct()
    # stored, so that Spark knows its size and broadcasts it only if that is small
    gone = Scratch(docs.sparkSession, "duplicates").table(gone, "ids", keep=True)
    return back(rows.join(gone, F.col(names[doc_id]) == F.col("gone"), "left_anti"))
