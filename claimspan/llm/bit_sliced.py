"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to whole numbers and put into blocks. A block holds, for
each dimension, one bitmap over its rows for each bit of the value (less the
block's least value of that dimension). The score of a query is a sum of these
bitmaps, each at the weight of a value bit times a query bit (complemented for
a negative query value, with a constant added). Bitmaps of equal weight are
added three at a time, sum and carry, until the score itself is bit-sliced. The
top rows are then selected from the most significant slice downward; rows still
equal at the boundary have the same score, and the smaller ids are taken.

Every block of queries meets every block of the index, and at most k rows of
each meeting go on. The result is exact for any input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, arrow, batch_of, map_arrow

SCALE = 256
#: Rows of an index block, about; a block never has more than four times as many.
BLOCK_ROWS = 8_192


def quantised(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, or null if the vector is null or a component null or not finite."""
    col = F.col(f"`{vector}`")
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(
        col.isNotNull() & ~F.coalesce(bad, F.lit(True)),
        F.transform(col, lambda x: F.floor(x.cast("double") * scale).cast("long")),
    )


def slice_up(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, dims) whole numbers as (least value of each dimension, bitmaps [dim, bit, word])."""
    low = values.min(axis=0) if len(values) else np.zeros(values.shape[1], np.int64)
    over = (values - low).astype(np.uint64)
    bits = max(1, int(over.max(initial=0)).bit_length())
    words = -(-len(values) // 64)
    out = np.zeros((values.shape[1], bits, words * 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits(((over >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
        out[:, bit, : packed.shape[0]] = packed.T
    return low, out.view(np.uint64)


def add_up(terms: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The bit-sliced sum of bitmaps (2-d arrays of rows of bitmaps) by weight, least significant first."""
    out = []
    weight = 0
    while terms and weight <= max(terms):
        parts = terms.pop(weight, [])
        stack = np.concatenate(parts) if parts else np.zeros((0, words), np.uint64)
        while len(stack) >= 2:
            third = len(stack) // 3
            if third:
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                x = a ^ b
                carry = (a & b) | (c & x)
                stack = np.concatenate([x ^ c, stack[3 * third :]])
            else:
                carry = stack[:1] & stack[1:]
                stack = stack[:1] ^ stack[1:]
            terms.setdefault(weight + 1, []).append(carry)
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        weight += 1
    return out


def scores(query: np.ndarray, low: np.ndarray, slices: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The bit-sliced scores of a block's rows, and the constant to be added to each."""
    bits, words = slices.shape[1], slices.shape[2]
    constant = int((query * low).sum())
    size = np.abs(query).astype(np.uint64)
    signed = np.where((query < 0)[:, None, None], ~slices, slices)
    constant -= int(size[query < 0].sum()) * ((1 << bits) - 1)
    terms: dict[int, list[np.ndarray]] = {}
    for i in range(int(size.max(initial=0)).bit_length()):
        rows = np.flatnonzero((size >> np.uint64(i)) & np.uint64(1))
        for j in range(bits):
            terms.setdefault(i + j, []).append(signed[rows, j])
    return add_up(terms, words), constant


def top(sliced: list[np.ndarray], rows: np.ndarray, k: int) -> list[int]:
    """The ``k`` rows with the largest sums among ``rows`` (a bitmap), of equal ones the first."""
    sure, equal = np.zeros_like(rows), rows
    for bits in reversed(sliced):
        high = equal & bits
        n = int(np.bitwise_count(sure | high).sum())
        if n > k:
            equal = high
        else:
            sure, equal = sure | high, equal & ~bits
            if n == k:
                return _rows(sure)
    found = _rows(sure)
    return found + _rows(equal)[: max(0, k - len(found))]


def _rows(bitmap: np.ndarray) -> list[int]:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")).tolist()


_INDEX = "block int, dims int, rows int, ids binary, low binary, slices binary, queries binary"


def index(vectors: DataFrame, blocks: int, id_: str, values: str, is_query: str) -> DataFrame:
    """The index blocks of (id, values, is_query): bitmaps, and the block's own queries as (row, id, values)."""
    schema = arrow(_INDEX)

    def build(block: tuple[int, int], ids: list[int], rows: list[list[int]], asks: list[bool]) -> pa.RecordBatch:
        numbers = np.array(rows, np.int64).reshape(len(rows), block[1])
        low, slices = slice_up(numbers)
        asked = np.flatnonzero(np.array(asks, bool))
        queries = np.column_stack([asked, np.array(ids, np.int64)[asked], numbers[asked]]) if len(asked) else np.zeros(0)
        parts = (np.array(ids, np.int64), low.astype(np.int64), slices, queries.astype(np.int64))
        return batch_of(schema, [block[0]], [block[1]], [len(ids)], *[[p.tobytes()] for p in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, rows, asks = None, [], [], []
        for batch in batches:
            for block, i, v, q in zip(*[batch.column(c).to_pylist() for c in ("block", "id", "v", "q")], strict=True):
                if now is not None and ((block, len(v)) != now or len(ids) == 4 * BLOCK_ROWS):
                    yield build(now, ids, rows, asks)
                    ids, rows, asks = [], [], []
                now = (block, len(v))
                ids.append(i)
                rows.append(v)
                asks.append(q)
        if now is not None:
            yield build(now, ids, rows, asks)

    block = F.pmod(F.xxhash64(id_), F.lit(blocks)).cast("int")
    dealt = vectors.select(block.alias("block"), F.col(id_).alias("id"), F.col(values).alias("v"), F.col(is_query).alias("q"))
    sorted_ = dealt.repartition("block").sortWithinPartitions("block", F.size("v"), "id")
    return map_arrow(sorted_, run, _INDEX)


def top_k(
    vectors: DataFrame, query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, ``vec_id``, score): the ``k`` best rows for each row where ``query`` holds.

    Components are quantised to floor(scale * x); the score is the integer
    inner product; candidates are all rows but the query's own, as many as
    there are up to ``k``; equal scores go to the smaller id.

    * Vectors that are null, or hold a null or a non-finite component, and rows
      with a null id take no part. Vectors meet those of their length only; an
      empty vector scores 0 with other empty ones.
    * Repeated rows are rows of their own, as queries and as candidates.
    * An empty table gives no rows. Other columns have no part.
    * An error is raised before the search if a score might leave 64 bits.
    """
    scratch = Scratch(vectors.sparkSession, "bitsliced")
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"),
        quantised(vector, scale).alias("v"),
        F.coalesce(query, F.lit(False)).alias("q"),
    ).where("id is not null and v is not null")
    longest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    n, most, dims = rows.agg(F.count("*"), F.max(longest), F.max(F.size("v"))).first()
    if n and 2 * (dims or 0) * (most or 0) ** 2 >= 2**63:
        raise ValueError(f"scores of {dims} components of up to {most} (quantised) may leave 64 bits; use a smaller scale")
    blocks = max(1, -(-n // BLOCK_ROWS))
    made = scratch.table(index(rows, blocks, "id", "v", "q").withColumn("own", F.monotonically_increasing_id()), "index", keep=True)
    asked = (
        made.where(F.octet_length("queries") > 0)
        .select(F.col("dims").alias("q_dims"), F.col("own").alias("q_own"), F.col("queries").alias("asked"))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    pairs = made.drop("queries").join(asked, (F.col("block") == F.col("q_block")) & (F.col("dims") == F.col("q_dims")))
    ddl = "q_own long, q_row int, query_id long, vec_id long, score long"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                yield meet(*[batch.column(c)[r].as_py() for c in ("own", "dims", "rows", "ids", "low", "slices", "q_own", "asked")])

    def meet(own: int, dims: int, n: int, ids: bytes, low: bytes, slices: bytes, q_own: int, asked: bytes) -> pa.RecordBatch:
        words = -(-n // 64)
        ids_, low_ = np.frombuffer(ids, np.int64), np.frombuffer(low, np.int64)
        bitmaps = np.frombuffer(slices, np.uint64)
        bitmaps = bitmaps.reshape(dims, -1, words) if dims else np.zeros((0, 1, words), np.uint64)
        every = np.zeros(words * 64, np.uint8)
        every[:n] = 1
        out: list[tuple[int, int, int, int, int]] = []
        for row, query_id, *values in np.frombuffer(asked, np.int64).reshape(-1, 2 + dims).tolist():
            here = every.copy()
            if own == q_own:
                here[row] = 0
            sliced, constant = scores(np.array(values, np.int64), low_, bitmaps)
            for at in top(sliced, np.packbits(here, bitorder="little").view(np.uint64), k):
                bits = [int(s[at // 64] >> np.uint64(at % 64)) & 1 for s in sliced]
                out.append((q_own, row, query_id, int(ids_[at]), constant + sum(b << w for w, b in enumerate(bits))))
        return batch_of(schema, *(list(c) for c in zip(*out, strict=True))) if out else batch_of(schema, [], [], [], [], [])

    found = map_arrow(pairs.select("own", "dims", "rows", "ids", "low", "slices", "q_own", "asked"), run, ddl)
    best = Window.partitionBy("q_own", "q_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(vec_id), "score")
