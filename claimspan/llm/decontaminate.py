"""Benchmark decontamination with a generalised suffix automaton of the test items.

The words of the test items are put into suffix automata, one for each block of
items. Documents stream through them word by word: the state after a word tells
the longest run of words, ending there, that some item contains. A run of at
least ``window`` words is a copied passage, and so is the whole of an item that
is shorter than a window. Words that no item holds reset the automaton, so
stretches too short to hold a window are skipped.

An automaton has at most about ``BLOCK_WORDS`` item words (one item may have
more), hence a bounded size; it is built in a task and broadcast. Benchmarks
with more words take one pass over the documents for each block.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch, aliased, extended, restored, ship, utf8
from claimspan.llm.words import WORD_CHARS, words

WINDOW = 13
#: A document is contaminated if its hit words are at least one in so many of its words.
COVERAGE = 20
BLOCK_WORDS = 250_000

_SPAN = "struct<first: int, last: int, start: long, end: long>"
_FOUND = f"n_words long, longest int, spans array<{_SPAN}>, items array<string>"


@dataclass
class Automaton:
    """States with their longest string, suffix link and transitions, for sequences of words."""

    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    after: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word)

    def _extend(self, last: int, word: int) -> int:
        known = self.after[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at != -1 and word not in self.after[at]:
            self.after[at][word] = new
            at = self.link[at]
        if at != -1:
            then = self.after[at][word]
            self.link[new] = then if self.length[then] == self.length[at] + 1 else self._split(at, then, word)
        return new

    def _split(self, at: int, state: int, word: int) -> int:
        """A copy of ``state`` for the strings that reach it through ``at``."""
        copy = self._state(self.length[at] + 1, self.link[state], dict(self.after[state]))
        self.link[state] = copy
        while at != -1 and self.after[at].get(word) == state:
            self.after[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.after.append(after)
        return len(self.length) - 1


def _build(sequences: list[np.ndarray], window: int) -> dict[str, np.ndarray]:
    """The automaton of the items' word hashes, as arrays."""
    vocabulary = np.unique(np.concatenate([*sequences, np.empty(0, np.uint64)]))
    coded = [np.searchsorted(vocabulary, s).tolist() for s in sequences]
    made = Automaton()
    for s in coded:
        made.add(s)
    n = len(made.length)
    length, link = np.array(made.length), np.array(made.link)
    order = np.argsort(length, kind="stable").tolist()
    frame, mark = np.full(n, -1), np.full(n, -1)  # the state of the last window; the next state with short items
    short: dict[int, list[tuple[int, int]]] = {}
    wholes = []
    for i, s in enumerate(coded):
        if 0 < len(s) < window:
            at = 0
            for word in s:
                at = made.after[at][word]
            short.setdefault(at, []).append((len(s), i))
    for v in order[1:]:
        up = link[v]
        frame[v] = frame[up] if length[up] >= window else (v if length[v] >= window else -1)
        mark[v] = v if v in short else mark[up]
    for i, s in enumerate(coded):
        at = 0
        for k, word in enumerate(s):
            at = made.after[at][word]
            if k + 1 >= window:
                wholes.append((int(frame[at]), i))
    whole = np.unique(np.array(wholes, np.int64).reshape(-1, 2), axis=0)
    shorts = np.array([(v, n_, i) for v, l_ in sorted(short.items()) for n_, i in l_], np.int64).reshape(-1, 3)
    steps = np.array([(v, c, t) for v, d in enumerate(made.after) for c, t in d.items()], np.int64).reshape(-1, 3)
    sizes = [len(s) for s in coded if s]
    least = np.array([min([window, *sizes])])
    return {"vocabulary": vocabulary, "length": length, "link": link, "frame": frame, "mark": mark, "whole": whole,
            "short": shorts, "steps": steps, "least": least}


class Matcher:
    """Finds the passages of one block's items in documents."""

    def __init__(self, arrays: dict[str, np.ndarray], names: list[str], window: int):
        self.window, self.names = window, names
        self.vocabulary, self.least = arrays["vocabulary"], int(arrays["least"][0])
        self.length, self.link = arrays["length"].tolist(), arrays["link"].tolist()
        self.frame, self.mark = arrays["frame"].tolist(), arrays["mark"].tolist()
        self.after: list[dict[int, int]] = [{} for _ in self.length]
        for v, c, t in arrays["steps"].tolist():
            self.after[v][c] = t
        self.whole: dict[int, list[int]] = {}
        for v, i in arrays["whole"].tolist():
            self.whole.setdefault(v, []).append(i)
        self.short: dict[int, list[tuple[int, int]]] = {}
        for v, n, i in arrays["short"].tolist():
            self.short.setdefault(v, []).append((n, i))

    def code(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number in the vocabulary, or -1."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def scan(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """(first, last) words of passages in a run of known words, the items hit, the longest match."""
        state = size = longest = 0
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        frames: set[int] = set()
        for k, word in enumerate(codes):
            while state and word not in self.after[state]:
                state = self.link[state]
                size = self.length[state]
            state = self.after[state].get(word, 0)
            size = size + 1 if state else 0
            longest = max(longest, size)
            if size >= self.window:
                spans.append((k - self.window + 1, k))
                frames.add(self.frame[state])
            at = self.mark[state]
            while at > 0:
                for n, i in self.short[at]:
                    if n <= size:
                        spans.append((k - n + 1, k))
                        items.add(i)
                at = self.mark[self.link[at]]
        for f in frames:
            items.update(self.whole[f])
        return spans, items, longest


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, scratch: Scratch) -> DataFrame:
    """One row for each block of items: names and automaton."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    total = items.select(F.sum(F.length("text") / 2)).first()[0] or 0  # no fewer than the words
    n = max(1, int(total // BLOCK_WORDS))
    ship(benchmark.sparkSession)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["item", "text"])
        data, offsets = utf8(pa.array(rows["text"], pa.large_string()))
        w = words(data, offsets, WORD_CHARS)
        sequences = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        held = io.BytesIO()
        np.savez(held, **_build(sequences, window))
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "items": [rows["item"].tolist()], "made": [held.getvalue()]})

    # equal rows are one item: many of them are no large block
    cut = items.distinct().withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int"))
    made = cut.groupBy("block").applyInPandas(build, "block int, items array<string>, made binary")
    return scratch.table(made, "automata")


def passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with what each document holds of the benchmark: ``n_words``, ``n_hit``, ``longest``
    (words of the longest match), ``spans`` and ``items``.

    Words are runs of digits, letters (A-Z lower-cased) and characters outside
    ASCII. A window is ``window`` successive words of an item; an item of fewer
    is one window. A word inside any occurrence of a window is hit. ``spans``
    are the merged stretches of hit words, with their first and last word and
    their byte range; ``items`` are the ids whose windows occur.

    * A null text has no words, and a null or wordless item no window. An empty
      table on either side gives no rows, or rows without hits.
    * Items that share an id count as one; a null id counts as "".
    * Repeated documents each get their row. Long texts are read whole. Columns
      named as the results are replaced; others are carried along, nulls too.
    """
    with Scratch(docs.sparkSession, "decontaminate") as scratch:
        table = _blocks(benchmark, item_id, item_text, window, scratch)
        numbers = sorted(r["block"] for r in table.select("block").collect())
        rows, names, _ = aliased(docs)
        now, stored = rows, None
        for turn, number in enumerate(numbers or [None]):
            held = None
            if number is not None:
                row = table.where(F.col("block") == number).first()
                held = docs.sparkSession.sparkContext.broadcast((bytes(row["made"]), list(row["items"])))
            if turn:
                for name, _ in _CARRIED:
                    now = now.withColumnRenamed(name, f"_{name}")
            else:
                now = now.select("*", *[F.lit(None).cast(kind).alias(f"_{name}") for name, kind in _CARRIED])
            now = extended(now, _FOUND, names[text], _pass(held, window, names[text])).drop(*[f"_{name}" for name, _ in _CARRIED])
            if turn < len(numbers) - 1:
                now, stored = scratch.turn(now, f"pass-{turn}", stored)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return restored(now.withColumn("n_hit", hit), names, ["n_words", "longest", "spans", "items", "n_hit"])


_CARRIED = [("longest", "int"), ("spans", f"array<{_SPAN}>"), ("items", "array<string>")]


def _pass(held: object, window: int, text: str):
    def setup():
        if held is None:
            matcher = Matcher(_build([], window), [], window)
        else:
            made, names = held.value
            with np.load(io.BytesIO(made)) as arrays:
                matcher = Matcher(dict(arrays), names, window)
        return lambda batch: _found(matcher, batch, text)

    return setup


def _found(matcher: Matcher, batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, list, list, list]:
    """n_words, longest, spans and items of a batch, with what earlier passes found."""
    data, offsets = utf8(batch.column(text))
    w = words(data, offsets, WORD_CHARS)
    codes = matcher.code(w.hash)
    known = codes >= 0
    # runs of known words inside one document, long enough to hold a window
    starts, ends = known.copy(), known.copy()
    inner = w.first[(w.first > 0) & (w.first < len(known))]
    starts[1:] &= ~known[:-1]
    ends[:-1] &= ~known[1:]
    starts[inner] = known[inner]
    ends[inner - 1] = known[inner - 1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long_ = b - a >= matcher.least
    a, b = a[long_], b[long_]
    owner = np.searchsorted(w.first, a, side="right") - 1
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    longest: dict[int, int] = {}
    for d, x, y in zip(owner.tolist(), a.tolist(), b.tolist(), strict=True):
        got, hit, most = matcher.scan(codes[x:y].tolist())
        longest[d] = max(longest.get(d, 0), most)
        if got:
            base = x - int(w.first[d])
            spans.setdefault(d, []).extend((base + p, base + q) for p, q in got)
            items.setdefault(d, set()).update(matcher.names[i] for i in hit)
    out_longest, out_spans, out_items = [], [], []
    old = [batch.column(f"_{n}") for n, _ in _CARRIED]
    for d in range(batch.num_rows):
        was, had, hit = (c[d].as_py() for c in old)
        first = int(w.first[d])
        out_spans.append(
            [
                {
                    "first": p,
                    "last": q,
                    "start": int(w.start[first + p] - offsets[d]),
                    "end": int(w.end[first + q] - offsets[d]),
                }
                for p, q in _merged(spans.get(d, []) + [(s["first"], s["last"]) for s in had or []])
            ]
        )
        out_items.append(sorted(items.get(d, set()) | set(hit or [])))
        out_longest.append(max(longest.get(d, 0), was or 0))
    return w.counts.astype(np.int64), out_longest, out_spans, out_items


def contaminated(coverage: int = COVERAGE) -> Column:
    """Whether the hit words of ``passages`` are at least one in ``coverage`` of all."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))


def clean(
    docs: DataFrame, benchmark: DataFrame, coverage: int = COVERAGE, text: str = "text", **how: object
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    rows, name, back = aliased(docs)
    return back(passages(rows, benchmark, text=name[text], **how).where(~contaminated(coverage)))


def cut(found: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``passages`` with every span taken out of ``text``."""
    data = F.encode(F.col(f"`{text}`"), "UTF-8")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").cast("binary").alias("kept"))
    kept = F.aggregate(
        "spans",
        start,
        lambda s, x: F.struct(
            x["end"].alias("at"),
            F.concat(s["kept"], F.substring(data, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))).alias("kept"),
        ),
    )
    rest = F.substring(data, (kept["at"] + 1).cast("int"), F.octet_length(F.col(f"`{text}`")))
    return found.withColumn(text, F.decode(F.concat(kept["kept"], rest), "UTF-8"))
