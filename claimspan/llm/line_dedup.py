"""Removal of lines that many documents share, with a sharded minimal perfect hash.

Lines are counted by a 128-bit hash of their key, one count for each document.
The hashes of the lines that enough documents hold are dealt to shards; for
each shard a task builds a minimal perfect hash (levels of bit vectors, in which
a hash that has a bit of its own stands and the others go on to the next level)
and, in its order, an array of fingerprints and one of counts. Documents then
probe these arrays with the hashes of their lines; lines are never joined.

The arrays take about 15 bytes a line. They are broadcast in groups of at most
``GROUP_BYTES``; if there are more, the documents pass once for each group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, aliased, arrow, batch_of, chunks, extended, map_arrow, restored, ship
from claimspan.llm.words import mix

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_LINES = 65_536
GROUP_BYTES = 64 << 20


def _key(line: bytes) -> bytes:
    """A line without white space (0x20, 0x09 to 0x0D) at its ends, A-Z lower-cased."""
    return line.strip().lower()  # both act on ASCII alone for bytes


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each key, as rows."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, keys)), np.uint64).reshape(-1, 2)


def _counts(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def line_counts(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, n): for the hash of each line key of at least ``min_chars`` code points, the documents with it."""
    ddl = "h1 long, h2 long, n long"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            keys: list[bytes] = []
            for t in batch.column("text").to_pylist():
                if t:
                    keys += {k for line in t.encode().split(b"\n") if _counts(k := _key(line), min_chars)}
            found, n = np.unique(_hashes(keys), axis=0, return_counts=True)
            yield batch_of(schema, *np.ascontiguousarray(found.T).view(np.int64), n)

    lines = map_arrow(docs.select(F.col(f"`{text}`").alias("text")), run, ddl)
    return lines.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def _spot(h: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = mix(np.array([level + 1], np.uint64))
    return (mix(h[:, 0] ^ mix(h[:, 1] + seed)) % np.uint64(size)).astype(np.int64)


def build_shard(h: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """A minimal perfect hash of the distinct rows of ``h``, with fingerprints and counts in its order."""
    sizes, bits, left = [], [], np.arange(len(h))
    while len(left):
        size = max(64, -(-len(left) * 3 // 2 // 64) * 64)
        at = _spot(h[left], len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        level = np.zeros(size, bool)
        level[at[alone]] = True
        sizes.append(size)
        bits.append(level)
        left = left[~alone]
    made = {"sizes": np.array(sizes, np.int64), "bits": np.packbits(np.concatenate(bits or [np.zeros(0, bool)]))}
    order = Shard({**made, "fingerprints": np.zeros(0), "counts": np.zeros(0)}).number(h)
    prints, counts = np.zeros(len(h), np.uint64), np.zeros(len(h), np.uint32)
    prints[order] = h[:, 1]
    counts[order] = np.minimum(n, 2**32 - 1)
    return {**made, "fingerprints": prints, "counts": counts}


class Shard:
    """The arrays of a shard, to be probed."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.sizes = arrays["sizes"]
        self.bits = np.unpackbits(arrays["bits"], count=int(self.sizes.sum())).astype(bool)
        self.before = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int32)])
        self.fingerprints, self.counts = arrays["fingerprints"], arrays["counts"]

    def number(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash: its own for one that was built in, any (or -1) for others."""
        out, left, base = np.full(len(h), -1), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + _spot(h[left], level, size)
            here = self.bits[at]
            out[left[here]] = self.before[at[here]]
            left, base = left[~here], base + size
        return out

    def documents(self, h: np.ndarray) -> np.ndarray:
        """The count of each hash, 0 for one that was not built in (told by its 64-bit fingerprint)."""
        at = self.number(h)
        known = at >= 0
        known[known] = self.fingerprints[at[known]] == h[known, 1]
        out = np.zeros(len(h), np.int64)
        out[known] = self.counts[at[known]]
        return out


_PARTS = "shard int, sizes binary, bits binary, fingerprints binary, counts binary"
_KINDS = {"sizes": np.int64, "bits": np.uint8, "fingerprints": np.uint64, "counts": np.uint32}


def index(counted: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The arrays of each shard of a table of ``line_counts``, and how many shards there are."""
    shards = max(1, -(-counted.count() // SHARD_LINES))
    ship(counted.sparkSession)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h1", "h2"])
        h = rows[["h1", "h2"]].to_numpy().astype(np.int64).view(np.uint64)
        made = build_shard(h, rows["n"].to_numpy())
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], **{k: [made[k].tobytes()] for k in _KINDS}})

    placed = counted.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int"))
    return scratch.table(placed.groupBy("shard").applyInPandas(build, _PARTS), "index"), shards


def without_common_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept``, the text without its common lines.

    A text is split at line feeds; a line's key is the line without white space
    at its ends, A-Z lower-cased. Lines whose key has at least ``min_chars``
    code points and stands in at least ``min_docs`` documents go, all of them,
    in every document. The rest is joined by line feeds, unchanged.

    * A null or empty text has one empty line, which stays if ``min_chars`` is
      at least 1; ``kept`` is then empty. Lines repeated in a document count once.
    * Repeated documents count as several. Long texts are read whole. An empty
      table gives no rows. Columns named as the results are replaced; others
      are carried along, nulls too.
    """
    spark = docs.sparkSession
    with Scratch(spark, "lines") as scratch:
        counted = scratch.table(line_counts(docs, text, min_chars).where(F.col("n") >= min_docs), "counted")
        made, shards = index(counted, scratch)
        weights = made.select("shard", sum(F.octet_length(k) for k in _KINDS).alias("bytes")).orderBy("shard").collect()
        groups: list[list[int]] = [[]]
        size = 0
        for row in weights:
            if groups[-1] and size + row["bytes"] > GROUP_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(row["shard"])
            size += row["bytes"]
        rows, names, _ = aliased(docs)
        now, stored = rows.withColumn("dropped", F.lit(None).cast("binary")), None
        for turn, group in enumerate(groups):
            rows = made.where(F.col("shard").isin(group)).collect() if group else []
            held = spark.sparkContext.broadcast(
                {r["shard"]: {k: np.frombuffer(r[k], kind) for k, kind in _KINDS.items()} for r in rows}
            )
            last = turn == len(groups) - 1
            setup = _probe(held, shards, names[text], min_docs, min_chars, last)
            if last:
                found = extended(now, "n_lines long, n_dropped long, kept string", names[text], setup)
                return restored(found, names, ["n_lines", "n_dropped", "kept"])
            now = extended(now, "more binary", names[text], setup).drop("dropped").withColumnRenamed("more", "dropped")
            now, stored = scratch.turn(now, f"pass-{turn}", stored)
        raise AssertionError("there is always a group")


def _probe(held: object, shards: int, text: str, min_docs: int, min_chars: int, last: bool):
    def setup():
        tables = {number: Shard(arrays) for number, arrays in held.value.items()}

        def run(batch: pa.RecordBatch) -> tuple[list, ...]:
            texts = [(t or "").encode().split(b"\n") for t in batch.column(text).to_pylist()]
            keys = [_key(line) for lines in texts for line in lines]
            able = np.array([_counts(k, min_chars) for k in keys], bool)
            h = _hashes(keys)
            common = np.zeros(len(keys), bool)
            owner = (h[:, 0].copy().view(np.int64) % shards)
            for number, table in tables.items():
                mine = np.flatnonzero((owner == number) & able)
                common[mine] = table.documents(h[mine]) >= min_docs
            had = batch.column("dropped").to_pylist()
            at, out = 0, []
            for lines, old in zip(texts, had, strict=True):
                gone = common[at : at + len(lines)]
                at += len(lines)
                if old is not None:
                    gone = gone | np.unpackbits(np.frombuffer(old, np.uint8), count=len(lines)).astype(bool)
                out.append(gone)
            if not last:
                return ([np.packbits(gone).tobytes() for gone in out],)
            kept = [
                b"\n".join(line for line, g in zip(lines, gone.tolist(), strict=True) if not g).decode()
                for lines, gone in zip(texts, out, strict=True)
            ]
            return [len(lines) for lines in texts], [int(gone.sum()) for gone in out], kept

        return run

    return setup
