"""Alignment of two tokenizers over the same bytes, by diagonal run skipping.

Each tokenizer gives the ascending byte offsets where its tokens end. Where both
run one to one, the offsets at ``i`` and ``i + shift`` agree for long stretches:
the stretch is jumped with exponential probing, which compares slices of both
arrays of a doubling length at the current index shift, and then halves the
length to find where they part. There, the irregular group is resolved locally by
advancing the side that is behind until the ends meet again, and the shift is
updated. The documents of a batch stand on end, as both end where a document does.

Links are all pairs of tokens whose byte ranges overlap. How often a pair of ids
is linked is counted over the corpus: pairs are added up in each task, and then
by a shuffle. Documents are tokenized and aligned once; their distinct pairs are
stored. The ``COMMON`` most frequent pairs, a bounded table, are then broadcast
and looked up in the task; the others are joined, one row per document and pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, arrow, batch_of, chunks, extended, map_arrow
from claimspan.llm.piece_bpe import piece_model
from claimspan.llm.pretokens import byte_letters
from claimspan.llm.token_files import encoder

#: Most frequent pairs that are broadcast (16 bytes each).
COMMON = 1 << 19
#: Distinct pairs a task holds before it passes their counts on.
HELD = 1 << 20


def align(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two ascending arrays of ends that agree in their last value.

    Returns the index behind each group's last token on the left and on the
    right, and the tokens of each link on the left and on the right. A group is
    what lies between two neighbouring ends that both have.
    """
    a, b = [*left.tolist(), -1], [*right.tolist(), -2]  # ends that differ: no stretch goes beyond
    n = len(left)
    i = j = 0
    run_at: list[int] = []  # one-to-one stretches: where on both sides, and how long
    run_to: list[int] = []
    run_length: list[int] = []
    link_a: list[int] = []
    link_b: list[int] = []
    odd_a: list[int] = []
    odd_b: list[int] = []
    add_a, add_b = link_a.append, link_b.append
    while i < n:
        if a[i] == b[j]:
            start, step = i, 2
            i += 1
            j += 1
            while a[i : i + step] == b[j : j + step]:
                i += step
                j += step
                step += step
            while step > 1:
                step >>= 1
                if a[i : i + step] == b[j : j + step]:
                    i += step
                    j += step
            run_at.append(start)
            run_to.append(j - i + start)
            run_length.append(i - start)
            if i == n:
                break
        # an irregular group: the side that is behind goes on, each step is one link
        x, y = a[i], b[j]
        while x != y:
            add_a(i)
            add_b(j)
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        add_a(i)
        add_b(j)
        i += 1
        j += 1
        odd_a.append(i)
        odd_b.append(j)
    at, to, length = (np.array(x, np.int64) for x in (run_at, run_to, run_length))
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    run_a, run_b = np.repeat(at, length) + inside, np.repeat(to, length) + inside
    group_a = np.concatenate([run_a + 1, np.array(odd_a, np.int64)])
    group_b = np.concatenate([run_b + 1, np.array(odd_b, np.int64)])
    order = np.argsort(group_a, kind="stable")
    pairs = np.concatenate([run_a, np.array(link_a, np.int64)]), np.concatenate([run_b, np.array(link_b, np.int64)])
    return group_a[order], group_b[order], *pairs


@cache
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 .. size - 1, one row of bytes each, and which of the bytes count."""
    width = len(str(max(size - 1, 0)))
    digits = np.frombuffer("".join(str(i).ljust(width) for i in range(size)).encode(), np.uint8).reshape(size, width)
    return digits, digits != 0x20


class Aligner:
    """Both tokenizers of a worker, and the alignment of batches of texts."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        self.a, self.b = encoder(byte_bpe, False), piece_model(piece_bpe)
        vocabulary = self.a.made.get_vocab(with_added_tokens=True)
        self.n_a, self.n_b = max(vocabulary.values()) + 1, self.b.size
        byte_of = _byte_level()
        added = self.a.made.get_added_tokens_decoder()
        self.len_a = np.zeros(self.n_a, np.int64)
        for token, i in vocabulary.items():
            self.len_a[i] = len(token.encode()) if i in added else len(token)  # one character a byte
        self.len_b = np.array([len(t) for t in self.b.surface])
        if self.a.made.normalizer is not None or not set(byte_of) <= set(vocabulary):
            raise ValueError(f"{byte_bpe}: a byte-level tokenizer that keeps every byte is needed")

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids A, bounds A, ids B, bounds B) of the texts; none where the bytes of either differ from blank and text."""
        a = [np.frombuffer(x, "<u4") for x in self.a([" " + t if t else "" for t in texts])]
        flat_a, at_a = _on_end(a)
        flat_b, at_b = self.b.encode(texts)
        flat_b = flat_b.astype(np.int64)
        # Neither tokenizer loses a byte, but that the second one gives U+2581 back as a blank, which is shorter.
        want = np.array([len(t.encode()) + 1 if t else 0 for t in texts], np.int64)
        same = np.ones(len(texts), bool)
        for flat, at, size in ((flat_a, at_a, self.len_a), (flat_b, at_b, self.len_b)):
            whole = np.concatenate([[0], np.cumsum(size[flat])])
            same &= whole[at[1:]] - whole[at[:-1]] == want
        return *_where(flat_a, at_a, same), *_where(flat_b, at_b, same)

    def __call__(self, texts: list[str]) -> dict[str, object]:
        a, at_a, b, at_b = self.tokens(texts)
        group_a, group_b, link_a, link_b = align(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        row_of_group = np.searchsorted(at_a, group_a - 1, side="right") - 1
        row_of_link = np.searchsorted(at_a, link_a, side="right") - 1
        rows = len(texts)
        n_links = np.bincount(row_of_link, minlength=rows)
        # the distinct pairs of each row, and how often it has them
        width = self.n_a * self.n_b
        keys, times = np.unique(row_of_link * width + a[link_a] * self.n_b + b[link_b], return_counts=True)
        row, pair = keys // width, keys % width
        return {
            "n_a": np.diff(at_a),
            "n_b": np.diff(at_b),
            "n_groups": np.bincount(row_of_group, minlength=rows),
            "n_links": n_links,
            "groups": self._spelled(a, b, group_a, group_b, row_of_group, rows),
            "bounds": np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]),
            "pairs": pair,
            "times": times,
        }

    def _spelled(
        self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, row: np.ndarray, rows: int
    ) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for the groups of each row."""
        if not len(group_a):
            return [b""] * rows
        size_a, size_b = np.diff(group_a, prepend=0), np.diff(group_b, prepend=0)
        start_a, start_b = group_a - size_a, group_b - size_b
        total = len(a) + len(b)
        ids, ends = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[np.arange(len(a)) + np.repeat(start_b, size_a)] = a
        ids[np.arange(len(b)) + np.repeat(group_a, size_b)] = b
        ends[group_a + start_b - 1] = ord("|")
        stops = group_a + group_b - 1
        ends[stops] = ord(";")
        digits, used = _decimals(max(self.n_a, self.n_b))
        shown = np.concatenate([digits[ids], ends[:, None]], axis=1)
        kept = np.concatenate([used[ids], np.ones((total, 1), bool)], axis=1)
        whole = shown[kept].tobytes()
        behind = np.cumsum(kept.sum(axis=1))
        last = np.append(np.flatnonzero(np.diff(row)), len(row) - 1)  # the last group of each row that has one
        out, before = [b""] * rows, 0
        for r, stop in zip(row[last].tolist(), behind[stops[last]].tolist(), strict=True):
            out[r] = whole[before : stop - 1]
            before = stop
        return out


def _byte_level() -> dict[str, int]:
    """The byte of each character that byte-level tokenizers write."""
    return {chr(c): b for b, c in enumerate(byte_letters().tolist())}


def _where(flat: np.ndarray, at: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches with those that are not kept made empty."""
    size = np.diff(at)
    if kept.all():
        return flat, at
    return flat[np.repeat(kept, size)], np.concatenate([[0], np.cumsum(np.where(kept, size, 0))])


def _on_end(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


@cache
def _aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    return Aligner(byte_bpe, piece_bpe)


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, `groups` string, pairs array<long>, times array<int>"


def aligned(docs: DataFrame, byte_bpe: str, piece_bpe: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the alignment of its tokens by two tokenizers, row by row.

    ``byte_bpe`` (a byte-level .json file of the tokenizers library) takes a blank
    and the text, ``piece_bpe`` (a SentencePiece BPE .model file) the text, before
    which it adds the blank itself; special tokens are plain text. Added:
    ``n_a``, ``n_b`` (tokens of each), ``n_groups``, ``n_links``, ``groups`` as
    ``a1,a2|b1;a3|b2,b3``, ``pairs`` (the distinct linked pairs of ids as
    ``a * vocabulary of B + b``, ascending) and ``times`` (links of each).

    * Null or empty texts, and those that either tokenizer's bytes do not give
      back (U+2581 in a text comes back as a blank), have no tokens: zeros,
      empty groups and lists.
    * Rows are on their own; an empty table gives none. Columns that bear an
      added name are replaced.
    """

    def setup():
        made = _aligner(byte_bpe, piece_bpe)

        def run(batch: pa.RecordBatch) -> tuple:
            found = made([t or "" for t in batch.column(text).to_pylist()])
            bounds = pa.array(found["bounds"], pa.int32())
            lists = [
                pa.ListArray.from_arrays(bounds, pa.array(found[c], kind)).cast(pa.list_(pa.field("element", kind)))
                for c, kind in (("pairs", pa.int64()), ("times", pa.int32()))
            ]
            spelled = pa.array([g.decode() for g in found["groups"]], pa.string())
            return *[found[c] for c in ("n_a", "n_b", "n_groups", "n_links")], spelled, *lists

        return run

    return extended(docs, _ALIGNED, text, setup)


def _by_elements(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` pairs at most (or one row), and the pairs and times in them."""
    for batch in batches:
        ends = np.cumsum(batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, *(part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pairs", "times"))
            start = stop


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): the links of each pair over all rows that ``aligned`` gave; added up in each task first."""
    ddl = "pair long, n long"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, new, n in _by_elements(batches):
            keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            # whole numbers below 2**53, as long as a task has no more links than that
            sums = np.bincount(at, np.concatenate([sums, n]), len(keys)).astype(np.int64)
            if len(keys) > HELD:
                yield batch_of(schema, keys, sums)
                keys, sums = keys[:0], sums[:0]
        yield batch_of(schema, keys, sums)

    return map_arrow(rows.select("pairs", "times"), run, ddl).groupBy("pair").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame) -> DataFrame:
    """At most ``COMMON`` of the most frequent pairs, cut between classes of frequency (eight to each doubling)."""
    grade = F.floor(8 * F.log2("n")).cast("int")
    room, cut = COMMON, None
    for r in sorted(counts.groupBy(grade.alias("grade")).count().collect(), key=lambda r: -r["grade"]):
        room -= r["count"]
        if room < 0:
            break
        cut = r["grade"]
    return counts.where(F.lit(False) if cut is None else grade >= cut)


def link_scores(docs: DataFrame, byte_bpe: str, piece_bpe: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but its text, with the sizes that ``aligned`` gives and what the corpus says about the links.

    ``n_best``: links whose pair is linked as often as any pair of their id of the
    second tokenizer, over the whole corpus (ties count). ``count_sum``: the sum,
    over the links, of how often their pair is linked in the corpus.
    ``groups_sha256``: of ``groups`` (empty without tokens). Rows without tokens
    have zeros. Nulls, empty texts and repeated rows as in ``aligned``; columns
    of ``docs`` that bear an added name are replaced.
    """
    from sentencepiece import SentencePieceProcessor

    spark = docs.sparkSession
    size_b = SentencePieceProcessor(model_file=piece_bpe).get_piece_size()
    added = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    names = {c: f"_column_{i}" for i, c in enumerate(docs.columns)}
    own = {c: new for c, new in names.items() if c != text and c.lower() not in added}
    base = docs.toDF(*names.values()).select(*own.values(), names[text])
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    with Scratch(spark, "aligned") as scratch:
        rows = scratch.table(
            aligned(base, byte_bpe, piece_bpe, names[text])
            .withColumn("groups_sha256", digest)
            .withColumn("_row", F.monotonically_increasing_id())
            .drop(names[text], "groups"),
            "rows",
        )
        of_b = Window.partitionBy(F.col("pair") % size_b)
        counts = pair_counts(rows).withColumn("best", F.col("n") == F.max("n").over(of_b))
        counts = scratch.table(counts, "counts")
        common = _most_frequent(counts).toPandas().sort_values("pair")
        held = spark.sparkContext.broadcast(
            (common["pair"].to_numpy(np.int64), common["n"].to_numpy(np.int64), common["best"].to_numpy(bool))
        )
        ddl = "_at long, _best long, _sum long, _rare array<struct<pair: long, times: long>>"
        schema = arrow(ddl)
        rare_type = schema.field("_rare").type

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, n, best = held.value
            for batch, pair, times in _by_elements(batches):
                size = batch.num_rows
                row = np.repeat(np.arange(size), batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False))
                at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                sums, firsts = np.zeros(size, np.int64), np.zeros(size, np.int64)
                np.add.at(sums, row[hit], times[hit] * n[at[hit]])
                np.add.at(firsts, row[hit], times[hit] * best[at[hit]])
                rest = pa.StructArray.from_arrays([pa.array(pair[~hit]), pa.array(times[~hit])], fields=list(rare_type.value_type))
                bounds = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=size))])
                rare = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rest).cast(rare_type)
                yield batch_of(schema, batch.column("_row"), firsts, sums, rare)

        scored = scratch.table(map_arrow(rows.select("_row", "pairs", "times"), score, ddl), "scored")
        rare = scored.select("_at", F.explode("_rare").alias("_r")).select("_at", "_r.pair", "_r.times")
        more = rare.join(counts, "pair").groupBy(F.col("_at").alias("_more")).agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_more_best"),
            F.sum(F.col("times") * F.col("n")).alias("_more_sum"),
        )
        scores = scored.drop("_rare").join(more, F.col("_at") == F.col("_more"), "left").select(
            "_at",
            (F.col("_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
            (F.col("_sum") + F.coalesce("_more_sum", F.lit(0))).alias("count_sum"),
        )
        out = rows.drop("pairs", "times").join(scores, F.col("_row") == F.col("_at"))
        return scratch.table(
            out.select(*[F.col(new).alias(old) for old, new in own.items()], *added), "result", keep=True
        )
