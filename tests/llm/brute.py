"""Plain Python versions of the operators, from their contracts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def common_lines(rows, least):
    key = lambda line: line.strip(" \t\n\r\x0b\x0c").translate(LOWER)
    seen = Counter(k for _, text in rows for k in {key(line) for line in (text or "").split("\n")} if k)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not (key(line) and seen[key(line)] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def passages(rows, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add("" if item is None else str(item))
    out = []
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in windows:
                    found |= windows[w]
                    hit.update(range(k, k + n))
        out.append((i, len(words), len(hit), sorted(found)))
    return out


def top_k(rows, every, k, scale=256):
    whole = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v) in enumerate(whole):
        if i % every == 0:
            others = [
                (-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(whole) if m != n and len(w) == len(v)
            ]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(others)[:k], 1)]
    return out


def near_duplicates(rows, n=5, percent=75):
    sets = []
    for i, text in rows:
        words = NOT_SPACE.findall((text or "").translate(LOWER))
        if len(words) >= n:
            sets.append((i, {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}))
        else:
            sets.append((i, {tuple(words)} if words else set()))
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                up[high] = low
    return [(i, len(s), root(i), root(i) == i) for i, s in sets]


def tokens(rows, path, end=None):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    tail = [] if end is None else [end]
    return [(i, (t or ""), made.encode(t or "", add_special_tokens=False).ids + tail) for i, t in rows]


def crc_of_ids(ids):
    return zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))


def hard_negatives(rows, every, positives, negatives, low=30, high=90, scale=256):
    whole = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v, label) in enumerate(whole):
        if i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, other == label)
            for m, (j, w, other) in enumerate(whole)
            if m != n and len(w) == len(v)
        )
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p]
            out += [(i, j, r, k, -p, -s) for r, (s, k, _) in enumerate(fits[:negatives], 1)]
    return out


def alignment(rows, byte_bpe, library):
    """Digest columns of the alignment, from offsets of the tokenizers library and pieces of sentencepiece."""
    import hashlib

    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    made = Tokenizer.from_file(byte_bpe)
    made.encode_special_tokens = True
    letters = sorted(ByteLevel.alphabet())
    plain = {b for b in range(256) if chr(b) in letters and (0x21 <= b <= 0x7E or 0xA1 <= b)}
    of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}

    def piece(i):
        return bytes([i - 3]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc, text in rows:
        whole = (" " + text).encode() if text else b""
        a = made.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        bytes_a = [bytes(of[c] for c in made.id_to_token(i)) for i in a]
        bytes_b = [piece(i) for i in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends = []
        for side in (bytes_a, bytes_b):
            at = 0
            ends.append([at := at + len(t) for t in side])
        links, i, j = [], 0, 0
        groups, start = [], (0, 0)
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append((a[start[0] : i], b[start[1] : j]))
                start = (i, j)
        counts.update(links)
        docs.append((doc, len(a), len(b), links, groups))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc, n_a, n_b, links, groups in docs:
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        sha = hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""
        out.append((doc, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha))
    return out
