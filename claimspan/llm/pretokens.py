"""Pre-tokens of a byte-level BPE tokenizer, found with arrays instead of a pattern search.

The pattern of the tokenizer (fixed value of its public file): contractions, a
run of letters, of numbers or of other characters with at most one blank before
it, and white space. Texts with an apostrophe go through the pattern itself.
A tokenizer encodes each pre-token on its own, so a text's tokens are those of
its pre-tokens in order; special tokens in a text are pre-tokens of their own,
as the library's default has it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import regex

PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
#: Texts of fewer characters are split by the pattern, which is then quicker.
_SHORT = 200
_classes: list[np.ndarray] = []


def _class_of() -> np.ndarray:
    """For each code point: white space, letter, number or other, as the pattern sees it."""
    if not _classes:
        kind = np.full(0x110000, _OTHER, np.uint8)
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
        every = points.astype("<u4").tobytes().decode("utf-32-le")
        for name, number in ((r"\s", _SPACE), (r"\p{L}", _LETTER), (r"\p{N}", _NUMBER)):
            found = "".join(regex.findall(name + "+", every))
            kind[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = number
        _classes.append(kind)
    return _classes[0]


def starts_of(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts without an apostrophe start.

    ``points`` are the code points of the texts on end, ``edges`` where each of
    the (non-empty) texts starts.
    """
    kind = _class_of()[points]
    n = len(kind)
    starts = np.empty(n, bool)
    starts[0] = True
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts[edges] = True
    space = kind == _SPACE
    # The last white space before other text: a blank joins what follows, anything else stands alone.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:]
    last[edges[1:] - 1] = False
    at = np.flatnonzero(last)
    starts[at] = True
    starts[at[points[at] == 0x20] + 1] = False
    return np.flatnonzero(starts)


def _plain(text: str) -> list[str]:
    """The pre-tokens of a text without an apostrophe."""
    cut = starts_of(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.zeros(1, np.int64)).tolist()
    return [text[a:b] for a, b in zip(cut, [*cut[1:], len(text)], strict=True)]


def splitter(specials: list[str]) -> Callable[[str], list[str]]:
    """A function from a text to its pre-tokens; ``specials`` are the tokenizer's special tokens."""
    special = regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) or r"(?!)")

    def plain(text: str) -> list[str]:
        return PATTERN.findall(text) if len(text) < _SHORT or "'" in text else _plain(text)

    def split(text: str) -> list[str]:
        if not any(s in text for s in specials):
            return plain(text)
        out, at = [], 0
        for m in special.finditer(text):
            out += plain(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + plain(text[at:])

    return split


@cache
def byte_letters() -> np.ndarray:
    """The code point that stands for each byte in the tokenizer's vocabulary: itself if it prints, or one from 256 on."""
    prints = np.zeros(256, bool)
    for a, b in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)):
        prints[a : b + 1] = True
    return np.where(prints, np.arange(256), 255 + np.cumsum(~prints)).astype("<u4")


def open_tokenizer(path: str):
    """The tokenizer of a .json file, and its special tokens."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made, [t.content for t in made.get_added_tokens_decoder().values()]
