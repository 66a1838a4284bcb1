"""Hard negatives by exact inner products from Strassen multiplication.

Vectors are quantised to whole numbers and put into candidate blocks. Anchors are
taken in bounded chunks, broadcast one at a time, and meet every block where it
lies, so no candidate is shuffled for a search. Scores of an anchor tile and a
candidate tile are one matrix product of 64-bit whole numbers, by Strassen's
recursion with zero padding: seven products of halves in place of eight. Sums and
products wrap, which is exact in the ring of 64-bit numbers, so every score that
fits is right whatever the sums in between are.

The first pass multiplies anchors with candidates of their own label only and
keeps each anchor's best rows in a bounded heap; the heaps of all tasks are merged.
These positives fix windows of scores. The second pass meets all candidates, and
keeps for each anchor and positive a bounded heap of the best rows of other labels
inside the window; these too are merged. Heaps are sorted arrays of one length, so
merging is a sort along an axis for all anchors at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspan.llm.bit_sliced import SCALE, quantised
from claimspan.llm.common import Scratch, arrow, batch_of, map_arrow

#: Rows of a candidate block, about.
BLOCK_ROWS = 8_192
#: Bytes of an anchor chunk: its vectors and its heaps.
CHUNK_BYTES = 48 << 20
TILE = 256
#: A product with a side of at most this many rows or columns is not split further.
LEAF = 16
_NONE = -(2**63 - 1)


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The products of stacks of 64-bit matrices, modulo 2**64, by recursive halving."""
    rows, inner, columns = *a.shape[-2:], b.shape[-1]
    if min(rows, inner, columns) <= LEAF:
        return a @ b
    a, b = _even(a), _even(b)
    h, i, j = a.shape[-2] // 2, a.shape[-1] // 2, b.shape[-1] // 2
    a11, a12, a21, a22 = a[..., :h, :i], a[..., :h, i:], a[..., h:, :i], a[..., h:, i:]
    b11, b12, b21, b22 = b[..., :i, :j], b[..., :i, j:], b[..., i:, :j], b[..., i:, j:]
    left = np.stack([a11 + a22, a21 + a22, a11, a22, a11 + a12, a21 - a11, a12 - a22])
    right = np.stack([b11 + b22, b11, b12 - b22, b21 - b11, b22, b11 + b12, b21 + b22])
    p = strassen(left, right)
    out = np.empty((*a.shape[:-2], 2 * h, 2 * j), np.int64)
    out[..., :h, :j] = p[0] + p[3] - p[4] + p[6]
    out[..., :h, j:] = p[2] + p[4]
    out[..., h:, :j] = p[1] + p[3]
    out[..., h:, j:] = p[0] - p[1] + p[2] + p[5]
    return out[..., :rows, :columns]


def _even(x: np.ndarray) -> np.ndarray:
    """``x`` with a row and a column of zeros where their number is odd."""
    odd = [(0, 0)] * (x.ndim - 2) + [(0, x.shape[-2] % 2), (0, x.shape[-1] % 2)]
    return np.pad(x, odd) if any(n for _, n in odd) else x


def merged(score: np.ndarray, who: np.ndarray, new_score: np.ndarray, new_who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two heaps along the last axis as one of the first one's length: higher scores first, then smaller ids."""
    k = score.shape[-1]
    score, who = np.concatenate([score, new_score], -1), np.concatenate([who, new_who], -1)
    order = np.lexsort((who, -score), axis=-1)[..., :k]
    return np.take_along_axis(score, order, -1), np.take_along_axis(who, order, -1)


@dataclass
class Anchors:
    """The anchors of a chunk with vectors of one length, sorted by label."""

    at: np.ndarray  # number in the chunk
    own: np.ndarray  # block and
    row: np.ndarray  # row where the anchor itself stands
    label: np.ndarray
    values: np.ndarray

    def of(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, side="right")))


class Block:
    """A candidate block as its table row holds it, sorted by label and then id."""

    def __init__(self, own: int, dims: int, rows: int, ids: bytes, labels: bytes, values: bytes):
        self.own, self.dims, self.rows = own, dims, rows
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.values = np.frombuffer(values, np.int64).reshape(rows, dims)


def _tiles(rows: slice, columns: slice) -> Iterator[tuple[slice, slice]]:
    """Tiles of anchors and candidates."""
    for r in range(rows.start, rows.stop, TILE):
        for c in range(columns.start, columns.stop, 4 * TILE):
            yield slice(r, min(r + TILE, rows.stop)), slice(c, min(c + 4 * TILE, columns.stop))


def _positives(anchors: Anchors, block: Block, score: np.ndarray, who: np.ndarray) -> None:
    """Enter the block's rows of the anchors' labels, but the anchors themselves, into the heaps."""
    k = score.shape[1]
    labels, first = np.unique(block.labels, return_index=True)
    for label, start, stop in zip(labels.tolist(), first.tolist(), [*first[1:].tolist(), block.rows], strict=True):
        for up, across in _tiles(anchors.of(label), slice(start, stop)):
            scores = strassen(anchors.values[up], block.values[across].T)
            row = anchors.row[up]
            here = np.flatnonzero((anchors.own[up] == block.own) & (row >= across.start) & (row < across.stop))
            scores[here, row[here] - across.start] = _NONE
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # ids ascend within a label
            at = anchors.at[up]
            score[at], who[at] = merged(score[at], who[at], np.take_along_axis(scores, best, 1), block.ids[across][best])


def _negatives(anchors: Anchors, block: Block, low: np.ndarray, high: np.ndarray, score: np.ndarray, who: np.ndarray) -> None:
    """Enter the block's rows of other labels that lie in the anchors' windows into the heaps."""
    k = score.shape[2]
    by_id = np.argsort(block.ids, kind="stable")
    ids, labels, values = block.ids[by_id], block.labels[by_id], block.values[by_id]
    for up, across in _tiles(slice(0, len(anchors.at)), slice(0, block.rows)):
        at = anchors.at[up]
        scores = strassen(anchors.values[up], values[across].T)
        fits = (scores >= low[at].min(axis=1)[:, None]) & (scores <= high[at].max(axis=1)[:, None])
        fits &= anchors.label[up, None] != labels[across]
        width = int(fits.sum(axis=1).max(initial=0))
        if not width:
            continue
        scores = np.where(fits, scores, _NONE)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :width]
        ranked = np.take_along_axis(scores, order, 1)
        names = ids[across][order]
        for w in range(low.shape[1]):
            place = (ranked > high[at, w, None]).sum(axis=1)[:, None] + np.arange(k)
            take = np.minimum(place, width - 1)
            found = np.take_along_axis(ranked, take, 1)
            found = np.where((place < width) & (found >= low[at, w, None]), found, _NONE)
            score[at, w], who[at, w] = merged(score[at, w], who[at, w], found, np.take_along_axis(names, take, 1))


_BLOCK = "dims int, rows int, ids binary, labels binary, values binary, asked binary"


def blocks(rows: DataFrame, parts: int) -> DataFrame:
    """(id, label, v, is_anchor, block) as one row per block and vector length."""
    schema = arrow(_BLOCK)

    def build(dims: int, held: list[tuple]) -> pa.RecordBatch:
        ids, labels, values, asked = zip(*held, strict=True)
        numbers = np.array(values, np.int64).reshape(len(held), dims)
        packed = [np.array(ids, np.int64), np.array(labels, np.int64), numbers, np.flatnonzero(np.array(asked, bool)).astype(np.int64)]
        return batch_of(schema, [dims], [len(held)], *[[p.tobytes()] for p in packed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for block, *row in zip(*[batch.column(c).to_pylist() for c in ("block", "id", "label", "v", "is_anchor")], strict=True):
                if held and ((block, len(row[2])) != now or len(held) == 4 * BLOCK_ROWS):
                    yield build(now[1], held)
                    held = []
                now = (block, len(row[2]))
                held.append(row)
        if held:
            yield build(now[1], held)

    dealt = rows.repartition(parts, "block").sortWithinPartitions("block", F.size("v"), "label", "id")
    return map_arrow(dealt, run, _BLOCK)


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
) -> DataFrame:
    """Hard negatives for each row where ``anchor`` holds.

    Components are quantised to floor(scale * x); a score is the integer inner
    product with the anchor; higher scores come first, equal ones by the smaller
    id. An anchor's positives are its first ``positives`` other rows of its label;
    each has the first ``negatives`` rows of another label whose score is between
    ``low`` and ``high`` percent of the positive's. Fewer where there are not as many.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank), ranks from 1.

    * Rows with a null id, label or vector, or a null or non-finite component, take
      no part. Vectors meet those of their length only; empty ones score 0.
    * A positive with a score below 0 has an empty window and so no negatives.
    * Repeated rows are rows of their own, as anchors, positives and negatives.
    * An empty table gives no rows; other columns have no part.
    * Labels that are not whole numbers are told apart by a 64-bit hash.
    * An error is raised before the search if 100 times a score might leave 64 bits.
    """
    spark = vectors.sparkSession
    code = F.col(f"`{label}`")
    known = vectors.select(code).schema[0].dataType
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"),
        (code.cast("long") if isinstance(known, T.IntegralType) else F.when(code.isNotNull(), F.xxhash64(code))).alias("label"),
        quantised(vector, scale).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).where("id is not null and label is not null and v is not null")
    longest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    n, most, dims = rows.agg(F.count("*"), F.max(longest), F.max(F.size("v"))).first()
    if n and 100 * (dims or 0) * (most or 0) ** 2 >= 2**63:
        raise ValueError(f"scores of {dims} components of up to {most} (quantised) may leave 64 bits; use a smaller scale")
    parts = max(1, -(-n // BLOCK_ROWS))
    with Scratch(spark, "negatives") as scratch:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        made = scratch.table(blocks(dealt, parts).withColumn("own", F.monotonically_increasing_id()), "blocks")
        asked = scratch.table(_anchors(made), "anchors")
        size, whole = asked.agg(F.count("*"), F.sum("dims")).first()
        each = 32 + 16 * positives * (negatives + 1)
        chunks = max(1, -(-(8 * (whole or 0) + each * size) // CHUNK_BYTES))
        out = []
        for chunk in range(chunks):
            mine_ = asked.where(F.pmod(F.xxhash64("own", "row"), F.lit(chunks)) == chunk)
            out.append(scratch.table(_chunk(scratch, made, mine_, positives, negatives, low, high), f"result-{chunk}", keep=True))
        found = out[0]
        for more in out[1:]:
            found = found.unionAll(more)
        return found


def _anchors(made: DataFrame) -> DataFrame:
    """(own, row, id, label, dims, v): the anchors of all blocks."""
    ddl = "own long, row int, id long, label long, dims int, v binary"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, *block in _columns(batch, "asked", "own", "dims", "rows", "ids", "labels", "values"):
                b = Block(*block)
                at = np.frombuffer(asked, np.int64)
                if len(at):
                    vectors = [b.values[r].tobytes() for r in at.tolist()]
                    yield batch_of(schema, [b.own] * len(at), at, b.ids[at], b.labels[at], [b.dims] * len(at), vectors)

    return map_arrow(made, run, ddl)


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    for r in range(batch.num_rows):
        yield tuple(batch.column(c)[r].as_py() for c in names)


def _chunk(scratch: Scratch, made: DataFrame, asked: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result for one chunk of anchors, which the driver hands to all tasks."""
    spark = scratch.spark
    table = asked.toPandas().sort_values(["dims", "label", "own", "row"], ignore_index=True)
    size, ids = len(table), table["id"].to_numpy(np.int64)
    groups = {}
    for dims, group in table.groupby("dims"):
        values = np.frombuffer(b"".join(group["v"]), np.int64).reshape(len(group), dims)
        groups[dims] = Anchors(group.index.to_numpy(), *[group[c].to_numpy(np.int64) for c in ("own", "row", "label")], values)
    held = spark.sparkContext.broadcast(groups)
    block = ("own", "dims", "rows", "ids", "labels", "values")
    heap = "at int, window int, score long, who long"
    schema = arrow(heap)

    def heaps(k: int, windows: int, enter) -> object:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = np.full((size, windows, k), _NONE, np.int64)
            who = np.zeros((size, windows, k), np.int64)
            for batch in batches:
                for b in map(lambda row: Block(*row), _columns(batch, *block)):
                    if b.dims in held.value:
                        enter(held.value[b.dims], b, score, who)
            at, window, place = np.nonzero(score != _NONE)
            for s in range(0, len(at), 100_000):
                e = slice(s, s + 100_000)
                yield batch_of(schema, at[e], window[e], score[at, window, place][e], who[at, window, place][e])

        return run

    def first(entered: DataFrame, k: int) -> DataFrame:
        best = Window.partitionBy("at", "window").orderBy(F.desc("score"), "who")
        return entered.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    entries = made.select(*block)
    own = map_arrow(entries, heaps(positives, 1, lambda a, b, score, who: _positives(a, b, score[:, 0], who[:, 0])), heap)
    found = scratch.table(first(own, positives), "positives")
    best = found.toPandas()
    scores = np.full((size, positives), _NONE, np.int64)
    scores[best["at"], best["rank"] - 1] = best["score"]
    there = scores != _NONE
    # low * positive <= 100 * score <= high * positive, in whole numbers
    least = np.where(there, -((-low * np.where(there, scores, 0)) // 100), 1)
    most = np.where(there, high * np.where(there, scores, 0) // 100, 0)
    bounds = spark.sparkContext.broadcast((least, most))
    other = map_arrow(entries, heaps(negatives, positives, lambda a, b, score, who: _negatives(a, b, *bounds.value, score, who)), heap)
    names = spark.createDataFrame(list(enumerate(ids.tolist())), "at int, anchor_id long")
    mined = first(other, negatives)
    of = found.select(F.col("at").alias("_at"), (F.col("rank") - 1).alias("_window"), F.col("who").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        mined.join(of, (F.col("at") == F.col("_at")) & (F.col("window") == F.col("_window")))
        .join(names, "at")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("who").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
            (F.col("window") + 1).alias("positive_rank"),
        )
    )
