"""SentencePiece encoding and decoding with vectorised merge rounds.

Texts of a batch stand on end as one array of symbols. It is cut into words
wherever no piece of the vocabulary holds the two neighbours side by side, since
no merge can ever cross such a place. Each distinct word is merged once: in a
round, the best pair of every word is found as a segmented minimum of pair
ranks, all its occurrences that do not overlap are merged at once, from the left,
and the array is compacted; words without a pair left drop out. The last round
has no word left.

Taking all occurrences at once gives what merging one after the other gives,
unless a merge makes a new pair that ranks as high or higher. Then the word's
round ends with that merge, and the others wait for the next one. Long words
that show such a pair (runs of blanks, mostly) are merged with a priority queue.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimspan.llm.common import arrow, extended, map_arrow, without
from claimspan.llm.words import distinct, hashes_of

_BLANK, _MARK = 0x20, 0x2581
_NONE = np.iinfo(np.int32).max
#: Characters merged at a time; a longer text is taken in parts that end where no merge can cross.
PART_CHARS = 1 << 19
#: A word of more symbols with a pair of the kind above goes to the priority queue.
LONG_WORD = 24


class PairTable:
    """A map from pairs of symbols to the piece they make, looked up for whole arrays (open addressing)."""

    def __init__(self, keys: np.ndarray, made: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        self.probes = 0
        at = self._slot(keys)
        while len(keys):
            self.probes += 1
            free = self.keys[at] < 0
            _, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[at[placed]], self.made[at[placed]] = keys[placed], made[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, made, at = keys[rest], made[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The pieces of these pairs, -1 where there is none."""
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.made[at], np.int32(-1))
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.made[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out


class PieceModel:
    """A SentencePiece model of kind BPE with byte fallback, as arrays."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        made = SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        kinds = np.array([p.type for p in spec.pieces])
        normal = proto.ModelProto.SentencePiece.NORMAL
        norm = spec.normalizer_spec
        if (
            spec.trainer_spec.model_type != proto.TrainerSpec.BPE
            or spec.trainer_spec.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or np.isin(kinds, [proto.ModelProto.SentencePiece.USER_DEFINED, proto.ModelProto.SentencePiece.UNUSED]).any()
            or int((kinds == proto.ModelProto.SentencePiece.BYTE).sum()) != 256
        ):
            raise ValueError(f"{path}: not a plain BPE model with byte fallback, dummy prefix and identity normaliser")
        self.size, self.end = len(kinds), made.eos_id()
        self.byte_ids = np.array([made.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self._symbols(made, kinds == normal)
        self._surfaces(made, kinds == proto.ModelProto.SentencePiece.UNKNOWN)
        #: Random values of code points, for hashing words.
        self.values = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 0x110000, dtype=np.uint64)

    def _symbols(self, made, normal: np.ndarray) -> None:
        """Symbols (pieces, then characters that are none but stand in one), pair table, ranks, bigrams."""
        names = {made.id_to_piece(int(i)): int(i) for i in np.flatnonzero(normal)}
        symbols = dict(names)
        for piece in names:
            for c in piece:
                symbols.setdefault(c, self.size + len(symbols) - len(names))
        self.width = self.size + len(symbols) - len(names)
        pairs: dict[int, int] = {}
        for piece, i in names.items():
            for k in range(1, len(piece)):
                left, right = symbols.get(piece[:k]), symbols.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        self.pairs = PairTable(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        scores = np.array([made.get_score(i) for i in range(self.size)])
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.rank = np.append(ranks, np.int32(_NONE))  # the last one serves -1: no pair
        # characters by number: 0 stands in no piece
        letters = sorted({c for piece in names for c in piece})
        self.letter = np.zeros(0x110000, np.uint16 if len(letters) < 65_000 else np.uint32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.symbol = np.full(len(letters) + 1, -1, np.int32)
        self.symbol[1:] = [symbols[c] for c in letters]
        number = {c: n for n, c in enumerate(letters, 1)}
        joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        beside = {(number[a], number[b]) for piece in names for a, b in zip(piece, piece[1:], strict=False)}
        if beside:
            left, right = np.array(sorted(beside)).T
            joined[left, right] = True
        self.joined = joined
        mark = number.get(chr(_MARK), 0)
        #: Whether a text may be cut before any blank that follows something else.
        self.blank_cuts = not np.delete(joined[:, mark], mark).any() if mark else True

    def _surfaces(self, made, unknown: np.ndarray) -> None:
        surface = [b"" if made.is_control(i) else made.id_to_piece(i).replace("▁", " ").encode() for i in range(self.size)]
        for b, i in enumerate(self.byte_ids.tolist()):
            surface[i] = bytes([b])
        for i in np.flatnonzero(unknown).tolist():
            surface[i] = made.decode([i]).encode()
        self.surface = surface
        self.silent = np.array([made.is_control(i) for i in range(self.size)])
        self.is_byte = np.zeros(self.size, bool)
        self.is_byte[self.byte_ids] = True
        self.blank_first = np.array([s[:1] == b" " for s in surface]) & ~unknown & ~self.is_byte

    # -- encoding ---------------------------------------------------------

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, where each text starts and the last one ends), without begin or end ids."""
        parts, of = [], []
        for row, text in enumerate(texts):
            for part in self._parts(" " + text) if text else ():
                parts.append(part)
                of.append(row)
        ids, counts, at = [], np.zeros(len(texts), np.int64), 0
        while at < len(parts):
            size, stop = len(parts[at]), at + 1
            while stop < len(parts) and size + len(parts[stop]) <= PART_CHARS:
                size += len(parts[stop])
                stop += 1
            found, n = self._encode(parts[at:stop])
            ids.append(found)
            np.add.at(counts, of[at:stop], n)
            at = stop
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(counts)])

    def _parts(self, text: str) -> Iterator[str]:
        start = 0
        while self.blank_cuts and len(text) - start > PART_CHARS:
            cut = text.rfind(" ", start + 1, start + PART_CHARS)
            while cut > start and text[cut - 1] in " ▁":
                cut = text.rfind(" ", start + 1, cut)
            if cut <= start:  # a word of more characters than that
                cut = text.find(" ", start + PART_CHARS)
                while cut > 0 and text[cut - 1] in " ▁":
                    cut = text.find(" ", cut + 1)
                if cut <= 0:
                    break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).copy()
        points[points == _BLANK] = _MARK
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        letters = self.letter[points]
        cut = np.ones(len(points), bool)
        np.logical_not(self.joined[letters[:-1], letters[1:]], out=cut[1:])
        cut[edges[:-1]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(points))
        first, which = distinct(hashes_of(self.values[points], start, end))
        length = (end - start)[first]
        begins = np.cumsum(length) - length
        take = np.arange(int(length.sum())) + np.repeat(start[first] - begins, length)
        symbols = self.symbol[letters[take]]
        alone = symbols < 0  # in no piece, and so a word of its own: kept as -1 - code point
        symbols[alone] = -1 - points[take[alone]].astype(np.int32)
        ids, n = self._bytes(*self.merge(symbols, np.repeat(np.arange(len(first)), length)), len(first))
        at = np.cumsum(n) - n
        many = n[which]
        before = np.concatenate([[0], np.cumsum(many)])
        flat = ids[np.arange(before[-1]) + np.repeat(at[which] - before[:-1], many)]
        return flat, np.diff(before[np.searchsorted(start, edges)])

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged symbols of words on end, and the word of each; ``word`` ascends."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        piece = self._pair(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            rank = self.rank[piece]
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(heads, len(word)))
            best = np.minimum.reduceat(rank, heads)
            if (best == _NONE).any():  # words without a pair left are done
                over = np.repeat(best == _NONE, sizes)
                done.append((symbols[over], word[over]))
                symbols, word, piece, rank = (a[~over] for a in (symbols, word, piece, rank))
                live = best != _NONE
                best, sizes = best[live], sizes[live]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # of neighbouring occurrences every second one, from the left
            run = np.flatnonzero(np.append(True, np.diff(at) > 1))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            at, late = self._until_early_pair(symbols, word, piece, rank, at)
            if len(late):
                size = dict(zip(word[np.flatnonzero(np.append(True, word[1:] != word[:-1]))].tolist(), sizes.tolist(), strict=True))
                long = [w for w in late.tolist() if size[w] > LONG_WORD]
                if long:
                    gone = np.isin(word, long)
                    for w in long:
                        queued = self._queued(symbols[word == w].tolist())
                        done.append((np.array(queued, np.int32), np.full(len(queued), w, word.dtype)))
                    at = at[~gone[at]]
                    keep = ~gone
                    at = (np.cumsum(keep) - 1)[at]
                    symbols, word, piece = symbols[keep], word[keep], piece[keep]
                    if not len(symbols):
                        break
            symbols[at] = piece[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, piece = symbols[keep], word[keep], piece[keep]
            new = place[at]
            stale = np.zeros(len(symbols), bool)
            stale[new] = True
            stale[new[new > 0] - 1] = True
            changed = np.flatnonzero(stale)
            piece[changed] = self._pair(symbols, word, changed)
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(a) for a in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _pair(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The piece that each of these symbols makes with the next one of its word, -1 for none."""
        out = np.full(len(at), -1, np.int32)
        ok = np.flatnonzero(at + 1 < len(symbols))
        left = at[ok]
        ok = ok[(word[left] == word[left + 1]) & (symbols[left] >= 0) & (symbols[left + 1] >= 0)]
        left = at[ok]
        out[ok] = self.pairs(symbols[left].astype(np.int64) * self.width + symbols[left + 1])
        return out

    def _until_early_pair(
        self, symbols: np.ndarray, word: np.ndarray, piece: np.ndarray, rank: np.ndarray, at: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The merges up to, in each word, the first that makes a pair of the same or a better rank; and the words that have one."""
        made, n = piece[at], len(symbols)
        # on the left: the merge before, if it ends there, else the symbol as it is
        left = np.where(at > 0, symbols[np.maximum(at - 1, 0)], np.int32(-1))
        touching = np.flatnonzero(np.append(False, np.diff(at) == 2))
        left[touching] = made[touching - 1]
        left[(at > 0) & (word[np.maximum(at - 1, 0)] != word[at])] = -1
        right = np.where(at + 2 < n, symbols[np.minimum(at + 2, n - 1)], np.int32(-1))
        right[(at + 2 < n) & (word[np.minimum(at + 2, n - 1)] != word[at])] = -1
        early = np.zeros(len(at), bool)
        for a, b in ((left, made), (made, right)):
            ok = np.flatnonzero((a >= 0) & (b >= 0))
            new = self.rank[self.pairs(a[ok].astype(np.int64) * self.width + b[ok])]
            early[ok] |= new <= rank[at[ok]]
        if not early.any():
            return at, word[:0]
        first = np.full(int(word[-1]) + 1, _NONE, np.int64)
        np.minimum.at(first, word[at[early]], at[early])
        return at[at <= first[word[at]]], np.unique(word[at[early]])

    def _queued(self, symbols: list[int]) -> list[int]:
        """One word merged pair by pair from a priority queue."""
        after, before = [*range(1, len(symbols)), -1], [-1, *range(len(symbols) - 1)]
        held: dict[tuple[int, int], int] = {}
        queue: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if i < 0 or j < 0 or symbols[i] < 0 or symbols[j] < 0:
                return
            pair = symbols[i], symbols[j]
            if pair not in held:
                held[pair] = int(self.pairs(np.array([pair[0] * self.width + pair[1]]))[0])
            if held[pair] >= 0:
                heapq.heappush(queue, (int(self.rank[held[pair]]), i, j, *pair))

        gone = [False] * len(symbols)
        for i in range(len(symbols) - 1):
            push(i)
        while queue:
            _, i, j, a, b = heapq.heappop(queue)
            if gone[i] or gone[j] or after[i] != j or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j] = held[a, b], True
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [s for s, g in zip(symbols, gone, strict=True) if not g]

    def _bytes(self, symbols: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each word): symbols that are no piece become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        if not len(odd):
            return symbols, np.bincount(word, minlength=words)
        chars = {int(self.symbol[n]): c for c, n in zip(np.flatnonzero(self.letter), self.letter[self.letter > 0], strict=True)} if (symbols >= self.size).any() else {}
        spelled = [self.byte_ids[list(chr(-1 - s if s < 0 else chars[s]).encode())] for s in symbols[odd].tolist()]
        n = np.ones(len(symbols), np.int64)
        n[odd] = [len(s) for s in spelled]
        out = np.repeat(symbols, n)
        out[np.repeat(symbols, n) != np.repeat(np.where((symbols < 0) | (symbols >= self.size), np.int32(_NONE), symbols), n)] = np.concatenate(spelled)
        return out, np.bincount(np.repeat(word, n), minlength=words)

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of these ids: control ids are silent, the blank of the dummy prefix goes, bad bytes become U+FFFD."""
        flat = np.asarray(ids, np.int64)
        spoken = np.flatnonzero(~self.silent[flat])
        if not len(spoken):
            return ""
        cut = int(self.blank_first[flat[spoken[0]]])
        if spoken[-1] - spoken[0] + 1 == len(spoken):  # no silent id between bytes
            try:
                return b"".join(map(self.surface.__getitem__, flat[spoken].tolist()))[cut:].decode()
            except UnicodeDecodeError:
                pass
        return self._with_bad_bytes(flat.tolist())[cut:]

    def _with_bad_bytes(self, ids: list[int]) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                at += n
            run.clear()

        for i in ids:
            if self.is_byte[i]:
                run += self.surface[i]
            else:
                flush()
                out.append(self.surface[i].decode())
        flush()
        return "".join(out)


@cache
def piece_model(path: str) -> PieceModel:
    """The model of a file, once per worker."""
    return PieceModel(path)


def encoded(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", back: str | None = None) -> DataFrame:
    """All columns of ``docs`` and ``ids``: each whole text as the sentencepiece library encodes it, with the end id.

    ``model`` is the file of a BPE model with byte fallback, at the same path on
    all executors; another kind of model raises an error. With ``back``, a column
    of that name holds the text that ``ids`` decode to.

    * A null or empty text has the end id alone.
    * Each row is on its own: repeated rows get equal ids, an empty table gives
      none. Texts are encoded whole, in parts where they are very long.
    * Columns that bear an added name are replaced; all others keep their values.
    """

    def setup():
        made = piece_model(model)

        def run(batch: pa.RecordBatch) -> tuple[pa.Array, ...]:
            flat, at = made.encode([t or "" for t in batch.column(text).to_pylist()])
            n = np.diff(at)
            out = np.full(len(flat) + len(n), made.end, np.int32)
            stops = np.cumsum(n + 1)
            spoken = np.ones(len(out), bool)
            spoken[stops - 1] = False
            out[spoken] = flat
            bounds = pa.array(np.concatenate([[0], stops]), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(out)).cast(pa.list_(pa.field("element", pa.int32())))
            if back is None:
                return (lists,)
            starts = at[:-1].tolist()
            return lists, pa.array([made.decode(flat[a : a + k]) for a, k in zip(starts, n.tolist(), strict=True)], pa.string())

        return run

    return extended(docs, f"`{ids}` array<int>" + (f", `{back}` string" if back else ""), text, setup)


def decoded(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``text``: what the sentencepiece library decodes ``ids`` to.

    * Null or empty ids give an empty text; a null among them is skipped; an id
      outside of the vocabulary raises an error.
    * A column of the name ``text`` is replaced; all others keep their values.
    """
    base = without(rows, [text])
    shape = T.StructType([*base.schema, T.StructField(text, T.StringType())])
    schema = arrow(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = piece_model(model)
        for batch in batches:
            texts = []
            for r in batch.column(ids):
                values = r.values.drop_null() if r.is_valid else []
                texts.append(made.decode(np.asarray(values)) if len(values) else "")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=schema)

    return map_arrow(base, run, shape)
