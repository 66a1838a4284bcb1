"""Token ids as Parquet list columns that can be read selectively.

Documents are range-partitioned and sorted by id, tokenized in that order, and
written one row per document with a list of ids. Row groups and pages are kept
small and page indexes are written, so a reader that asks for some documents or
for the metadata columns alone touches only those pages. ``encoding`` picks how
ids are stored: ``dictionary`` (ids as indexes of a dictionary of their row
group, which suits skewed vocabularies) or ``delta`` (differences, bit-packed).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, arrow, chunks, map_arrow
from claimspan.llm.pretokens import byte_letters, open_tokenizer, splitter, starts_of
from claimspan.llm.words import distinct, hashes_of, mix

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
#: Pre-tokens that a worker keeps with their ids (a power of two), in sets of four; those of more ids are not kept.
HELD = 1 << 21
_WAYS = 4
_WIDE = 8
#: Bytes of text encoded at a time (a longer text alone).
_CHUNK = 512 << 10

_FILE = "part int, start_in_part long, n_tokens long, ids array<int>"


class _Held:
    """The ids of pre-tokens met lately, by two hashes of them (64 bits each), in arrays of a fixed size.

    The first hash picks a set of ``_WAYS`` places; where all are taken, one of them is given up.
    """

    def __init__(self, ids: int):
        sets = HELD // _WAYS
        self.keys = np.zeros((sets, _WAYS), np.uint64)
        self.checks = np.zeros((sets, _WAYS), np.uint64)  # odd where a place is taken
        self.n = np.zeros(HELD, np.uint8)
        self.ids = np.zeros((HELD, _WIDE), np.min_scalar_type(ids))

    def _sets(self, key: np.ndarray) -> np.ndarray:
        return (key & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The place of each pre-token, -1 where it is not held."""
        at = self._sets(key)
        same = (self.keys[at] == key[:, None]) & (self.checks[at] == (check | np.uint64(1))[:, None])
        return np.where(same.any(axis=1), at * _WAYS + same.argmax(axis=1), -1)

    def put(self, key: np.ndarray, check: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """Keep pre-tokens whose ``n`` ids each stand in ``ids`` on end."""
        first = np.cumsum(n) - n
        at = self._sets(key)
        free = self.checks[at] == 0
        way = np.where(free.any(axis=1), free.argmax(axis=1), (key >> np.uint64(62)).astype(np.int64) % _WAYS)
        place, of = np.unique(at * _WAYS + way, return_index=True)
        few = n[of] <= _WIDE
        place, of = place[few], of[few]
        self.keys.reshape(-1)[place] = key[of]
        self.checks.reshape(-1)[place] = check[of] | np.uint64(1)
        self.n[place] = n[of]
        wide = np.minimum(first[of][:, None] + np.arange(_WIDE), len(ids) - 1)  # behind its ids, whatever follows
        self.ids[place] = ids[wide]


def _stretches(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indexes of stretches of ``n`` each from ``start``, on end."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


class _Encoder:
    """Texts to the bytes of their ids (32-bit, little-endian); one for all tasks of a worker.

    The pre-tokens of a chunk are hashed with arrays (64 bits); only the
    distinct ones not met lately become strings, which the library's model splits.
    """

    def __init__(self, path: str, specials: bool = True):
        self.made, found = open_tokenizer(path)
        self.specials = found if specials else []
        self.made.encode_special_tokens = not specials
        self.model = self.made.model
        self.split = splitter(self.specials)
        self.held = _Held(max(self.made.get_vocab(with_added_tokens=True).values()))
        self.values = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 0x110000, dtype=np.uint64)

    def ids_of(self, pre: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each pre-token has, and the ids on end."""
        # 0xFF is no byte of UTF-8, and the one that stands for itself in the model's alphabet
        spelled = byte_letters()[np.frombuffer(b"\xff".join([p.encode() for p in pre]), np.uint8)]
        words = spelled.tobytes().decode("utf-32-le").split("\xff")
        split = self.model.tokenize
        coded = [[t.id for t in split(w)] for w in words]
        for i, p in enumerate(pre) if self.specials else ():
            if p in self.specials:
                coded[i] = self.made.encode(p, add_special_tokens=False).ids
        n = np.fromiter(map(len, coded), np.int64, len(coded))
        return n, np.fromiter(chain.from_iterable(coded), np.uint32, int(n.sum()))

    def _starts(self, texts: list[str], points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pre-tokens start; texts with an apostrophe or a special token go through the pattern."""
        start = starts_of(points, edges[:-1][edges[1:] > edges[:-1]])
        odd = [i for i, t in enumerate(texts) if "'" in t or any(s in t for s in self.specials)]
        if not odd:
            return start
        marks = np.zeros(len(points), bool)
        marks[start] = True
        for i in odd:
            n = np.array([len(p) for p in self.split(texts[i])])
            marks[edges[i] : edges[i + 1]] = False
            marks[edges[i] + np.cumsum(n) - n] = True
        return np.flatnonzero(marks)

    def __call__(self, texts: list[str]) -> list[bytes]:
        text = "".join(texts)
        if not text:
            return [b""] * len(texts)
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        start = self._starts(texts, points, edges)
        end = np.append(start[1:], len(points))
        hashes = hashes_of(self.values[points], start, end)
        at, which = distinct(hashes)
        key, a, b = hashes[at], start[at], end[at]
        stops = np.cumsum(b - a)
        check = hashes_of(mix(self.values[points[_stretches(a, b - a)]]), stops - (b - a), stops)

        place = self.held.find(key, check)
        new = np.flatnonzero(place < 0)
        # the ids of each distinct pre-token: a row of those held, or a stretch behind them
        n = self.held.n[place].astype(np.int64)
        rows = self.held.ids[place[place >= 0]].astype("<u4")
        first = (np.cumsum(place >= 0) - 1) * _WIDE
        ids = rows.reshape(-1)
        if len(new):
            many, fresh = self.ids_of([text[i:j] for i, j in zip(a[new].tolist(), b[new].tolist(), strict=True)])
            n[new], first[new] = many, len(ids) + np.cumsum(many) - many
            ids = np.concatenate([ids, fresh])
            self.held.put(key[new], check[new], many, fresh)
        many = n[which]
        flat = ids[_stretches(first[which], many)]
        cut = np.concatenate([[0], np.cumsum(many)])[np.searchsorted(start, edges)].tolist()
        return [flat[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]


@cache
def encoder(path: str, specials: bool = True) -> _Encoder:
    """The encoder of a tokenizer file, once per worker; without ``specials`` their strings in texts are plain text."""
    return _Encoder(path, specials)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int, encoding: str = "dictionary", doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of every document of ``docs``, ``end`` after each, in ascending order of ``doc_id``.

    Columns: the id, ``part`` (number of the file in the order of ids),
    ``start_in_part`` (ids before the document in its file), ``n_tokens``, ``ids``.
    """
    rows = docs.select(F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    key = F.col(f"`{doc_id}`")
    ordered = rows.repartitionByRange(key, F.xxhash64("_text")).sortWithinPartitions(key, F.xxhash64("_text"))
    kind = rows.schema[0].dataType.simpleString()
    ddl = f"`{doc_id}` {kind}, {_FILE}"
    schema = arrow(ddl)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "_text", _CHUNK):
            coded = [b + last for b in encode(batch.column("_text").to_pylist())]
            n = np.array([len(b) // 4 for b in coded], np.int64)
            ends = np.concatenate([[0], np.cumsum(n)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))
            columns = [batch.column(0), np.full(len(n), part, np.int32), at + ends[:-1], n, ids.cast(schema.field(4).type)]
            at += int(ends[-1])
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    settings = {
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.writer.version": "PARQUET_2_0",  # its delta encodings, where a column has no dictionary
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#ids.list.element": "true" if encoding == "dictionary" else "false",
        "compression": "zstd",
    }
    map_arrow(ordered, run, ddl).write.options(**{k: str(v) for k, v in settings.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of token files with ``start``, the ids of all documents before each.

    The starts of files are the running sum of their lengths, one row a file.
    """
    files = spark.read.parquet(path)
    lengths = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # stored, so that Spark knows how small it is and does not shuffle the files for it
    starts = Scratch(spark, "starts").table(starts, "starts", keep=True)
    return files.join(starts, F.col("part") == F.col("_part")).withColumn("start", F.col("start_in_part") + F.col("_start")).drop("_part", "_start")


def ids_crc32(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """``rows`` with ``ids_crc32``, the crc32 of the ids as little-endian unsigned 32-bit integers, without ``ids``."""
    from claimspan.llm.common import T, arrow as of

    base = [c for c in rows.columns if c not in (ids, "ids_crc32")]
    shape = T.StructType([*rows.select(*[f"`{c}`" for c in base]).schema, T.StructField("ids_crc32", T.LongType())])
    schema = of(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<i4").data.cast("B")
            ends = 4 * np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            marks = [crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [batch.column(c) for c in base]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks, pa.int64())], schema=schema)

    return map_arrow(rows, run, shape)


def stored_tokens(
    docs: DataFrame, tokenizer: str, end: int, encoding: str = "dictionary", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The token files of ``docs``, written to the shared folder and read back (see ``write_tokens``, ``read_tokens``).

    * A null or empty text has the end id alone.
    * Repeated ids stand side by side, ordered by a hash of their texts; null
      ids come first. An empty table gives no rows.
    * Texts are encoded whole. Other columns have no part.
    """
    path = Scratch(docs.sparkSession, "tokenfiles").path("ids", keep=True)
    write_tokens(docs, path, tokenizer, end, encoding, doc_id, text)
    return read_tokens(docs.sparkSession, path)
