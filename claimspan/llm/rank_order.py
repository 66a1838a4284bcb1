"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 characters,
lower case, words padded with a blank on both sides) of all training texts of a
language, most frequent first. A document's own list is compared with each
profile: an n-gram costs the difference of its ranks, or ``PROFILE`` if the
profile lacks it. The language with the smallest sum is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspan.llm.common import aliased, arrow, batch_of, chunks, extended, map_arrow

#: N-grams in a profile, and in the list of a document.
PROFILE = 300
#: Profiles are handed to all tasks, 300 n-grams a language; beyond this many languages ``predict`` raises an error.
MAX_LANGUAGES = 10_000
UNKNOWN = "und"
#: Distinct n-grams a task holds before it passes their counts on.
HELD = 400_000

_BLANK = 0x20
_LETTER, _MARK = 2, 1
_classes: list[np.ndarray] = []


def _class_of() -> np.ndarray:
    """For each code point: a letter, a mark that may belong to one, or neither."""
    if not _classes:
        import unicodedata

        kinds = (unicodedata.category(chr(c)) for c in range(0x110000))
        _classes.append(
            np.fromiter((_LETTER if k[0] == "L" else _MARK if k[0] == "M" else 0 for k in kinds), np.uint8, 0x110000)
        )
    return _classes[0]


def ngrams(text: str) -> np.ndarray:
    """Every n-gram of a text, each as a number: its up to three characters in 21 bits each."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    kind = _class_of()[points]
    inside = kind > 0
    if not (kind == _LETTER).any():
        return np.empty(0, np.int64)
    # one blank for each gap between words, and one at both ends
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    chars = np.where(inside, points, _BLANK)[keep]
    chars = np.concatenate([[_BLANK], chars, [_BLANK]] if inside[-1] else [[_BLANK], chars])
    real = chars != _BLANK
    two = (chars[:-1] << 21) | chars[1:]
    three = (chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:]
    return np.concatenate([chars[real], two[real[:-1] | real[1:]], three[real[1:-1]]])


def ranked(text: str) -> np.ndarray:
    """The n-grams of a text, most frequent first, equals by number; at most ``PROFILE``."""
    grams, counts = np.unique(ngrams(text), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:PROFILE]]


def profiles(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, rank from 0): the profiles over all rows of ``texts`` that have a text and a language."""
    ddl = "lang string, gram long, n long"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> pa.RecordBatch:
            names = [name for name, (grams, _) in held.items() for _ in range(len(grams))]
            parts = list(held.values()) or [(np.empty(0, np.int64),) * 2]
            return batch_of(schema, names, np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts]))

        for batch in chunks(batches, "text"):
            by: dict[str, list[np.ndarray]] = {}
            for t, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                by.setdefault(name, []).append(ngrams(t))
            for name, lists in by.items():
                grams, counts = np.unique(np.concatenate(lists), return_counts=True)
                if name in held:
                    every, where = np.unique(np.concatenate([held[name][0], grams]), return_inverse=True)
                    counts = np.bincount(where, np.concatenate([held[name][1], counts]), len(every)).astype(np.int64)
                    grams = every
                held[name] = (grams, counts)
            if sum(len(g) for g, _ in held.values()) > HELD:
                yield out()
                held.clear()
        yield out()

    rows = texts.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(
        "text is not null and lang is not null"
    )
    counts = map_arrow(rows, run, ddl).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE).select("lang", "gram", (F.col("rank") - 1).alias("rank"))


def predict(docs: DataFrame, learned: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the table of ``profiles``.

    ``score`` is 1 minus the sum of costs over the largest possible one: 1 for
    a text that ranks its n-grams as the profile does, 0 for one that shares
    none. Equal sums go to the first language in code-point order.

    * A null or empty text, or one without a letter, is ``und`` with score 0;
      so is every text if nothing was learned.
    * Whole texts are read. Repeated rows get equal results. An empty table
      gives no rows. Columns named as the results are replaced; other columns
      are carried along and have no part, nulls in them neither.
    * More than 10,000 learned languages raise an error before any text is read.
    """
    table = learned.limit(MAX_LANGUAGES * PROFILE + 1).collect()
    if len(table) > MAX_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table.sort(key=lambda r: (r["gram"], r["lang"]))
    names = sorted({r["lang"] for r in table})
    number = {name: i for i, name in enumerate(names)}
    held = docs.sparkSession.sparkContext.broadcast(
        (
            names,
            np.array([r["gram"] for r in table], np.int64),
            np.array([number[r["lang"]] for r in table], np.int64),
            np.array([r["rank"] for r in table], np.int64),
        )
    )

    def setup():
        names, grams, owner, ranks = held.value

        def one(t: str | None) -> tuple[str, float]:
            own = ranked(t) if t else grams[:0]
            if not len(own) or not names:
                return UNKNOWN, 0.0
            low, high = np.searchsorted(grams, own, "left"), np.searchsorted(grams, own, "right")
            many = high - low
            place = np.repeat(np.arange(len(own)), many)
            row = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            saved = PROFILE - np.abs(place - ranks[row])
            cost = len(own) * PROFILE - np.bincount(owner[row], saved, len(names))
            best = int(np.argmin(cost))
            return names[best], float(1 - cost[best] / (len(own) * PROFILE))

        def run(batch: pa.RecordBatch) -> tuple[list, list]:
            found = [one(t) for t in batch.column(text).to_pylist()]
            return [name for name, _ in found], [score for _, score in found]

        return run

    return extended(docs, "lang_pred string, score double", text, setup)


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a document is held out: by crc32 of its id as text (a null id is not)."""
    code = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(parts)) == part, F.lit(False))


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``predict`` for all of ``docs`` with profiles of those that are not held out."""
    return predict(docs, profiles(docs.where(~held_out(doc_id)), text, lang), text)


def with_language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are in some language, as they are: those predicted ``und`` go, and so
    do those of score 0, which have no n-gram in common with any learned language.
    """
    rows, name, back = aliased(docs)
    found = identified(rows, name[doc_id], name[text], name[lang])
    return back(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)))
