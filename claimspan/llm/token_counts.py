"""Token counts without token ids: pieces are counted once per distinct pre-token.

The corpus' pre-tokens and how often each occurs are counted first, and the
tokenizer splits each distinct one once. Documents are then split into
pre-tokens again; for each document the pieces of its pre-tokens, times their
frequencies, are added up. Pieces of the ``COMMON`` most frequent pre-tokens
are broadcast (a bounded table) and added in the task; the others are joined,
one row per document and distinct rare pre-token.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, arrow, batch_of, chunks, extended, map_arrow
from claimspan.llm.pretokens import open_tokenizer, splitter

COMMON = 1 << 18
#: Distinct pre-tokens a task holds before it passes their counts on.
HELD = 300_000


def pieces(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(pre, n, pieces): the distinct pre-tokens of all texts, how often they occur, and the tokens of each."""
    ddl = "pre string, n long"
    schema = arrow(ddl)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(open_tokenizer(tokenizer)[1])
        held: Counter[str] = Counter()
        for batch in chunks(batches, "text"):
            for t in batch.column("text").to_pylist():
                if t:
                    held.update(split(t))
            if len(held) > HELD:
                yield batch_of(schema, list(held), list(held.values()))
                held.clear()
        yield batch_of(schema, list(held), list(held.values()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, _ = open_tokenizer(tokenizer)
        for batch in chunks(batches, "pre"):
            found = made.encode_batch_fast(batch.column("pre").to_pylist(), add_special_tokens=False)
            yield batch_of(out, batch.column("pre"), batch.column("n"), [len(e) for e in found])

    counted = map_arrow(docs.select(F.col(f"`{text}`").alias("text")), count, ddl).groupBy("pre").agg(F.sum("n").alias("n"))
    ddl_out = f"{ddl}, pieces int"
    out = arrow(ddl_out)
    return map_arrow(counted, encode, ddl_out)


def _most_frequent(known: DataFrame) -> DataFrame:
    """At most ``COMMON`` of the most frequent pre-tokens, cut between classes of frequency.

    There are at most 512 classes, eight to each doubling, so nothing but their
    sizes is gathered to find the cut.
    """
    grade = F.floor(8 * F.log2("n")).cast("int")
    room, cut = COMMON, None
    for r in sorted(known.groupBy(grade.alias("grade")).count().collect(), key=lambda r: -r["grade"]):
        room -= r["count"]
        if room < 0:
            break
        cut = r["grade"]
    return known.where(F.lit(False) if cut is None else grade >= cut)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``) for each row of ``docs``.

    Tokens are those of the tokenizers library for the whole text, without
    added special tokens, truncation or padding; ``tokenizer`` is its file, at
    the same path on all executors. ``over_limit``: more than ``limit`` tokens.

    * A null text counts as empty: no bytes, no tokens.
    * Repeated rows each get their row; a null id stays null. An empty table
      gives no rows. Other columns have no part, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    with Scratch(spark, "tokens") as scratch:
        known = scratch.table(pieces(rows, tokenizer), "pieces")
        common = _most_frequent(known).select("pre", "pieces").toPandas()
        held = spark.sparkContext.broadcast(dict(zip(common["pre"], common["pieces"].tolist(), strict=True)))

        def setup():
            split, of = splitter(open_tokenizer(tokenizer)[1]), held.value

            def run(batch: pa.RecordBatch) -> tuple[list, list]:
                sums, rest = [], []
                for t in batch.column("text").to_pylist():
                    found = [(of.get(p), p) for p in split(t)]
                    rare = Counter(p for n, p in found if n is None)
                    sums.append(sum(n for n, _ in found if n is not None))
                    rest.append([{"pre": p, "n": n} for p, n in rare.items()])
                return sums, rest

            return run

        sizes = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
        split = extended(sizes, "common long, rare array<struct<pre: string, n: long>>", "text", setup).drop("text")
        split = scratch.table(split.withColumn("row", F.monotonically_increasing_id()), "split")
        rare = split.select("row", F.explode("rare").alias("r")).select("row", "r.pre", F.col("r.n").alias("times"))
        added = (
            rare.join(known.select("pre", "pieces"), "pre").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
        )
        n = F.col("common") + F.coalesce("more", F.lit(0))
        return scratch.table(
            split.drop("rare").join(added, "row", "left")
            .select(F.col("id").alias(doc_id), "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")),
            "result", keep=True,
        )
