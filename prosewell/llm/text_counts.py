"""Counts of one text, as the quality operators see it. Separators are the six of `common.WORD`."""

from __future__ import annotations

from collections import Counter

import numpy as np

SYMBOLS = "#*$%&|<>"
WINDOW = 5
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGIT = b"0123456789"
_SYMBOL = SYMBOLS.encode()
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)


def word_chars(text: str) -> int:
    """Code points of `text` that are in words."""
    return len(text) - sum(map(text.count, " \t\n\v\f\r"))


def repeat_words(words: list[bytes]) -> int:
    """Words within 5-word windows that the text has twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    table: dict[bytes, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words], dtype=np.uint64)
    if len(table) == len(words):
        return 0
    hashes = sum(ids[i : i + n] * _FACTORS[i] for i in range(WINDOW))
    order = np.sort(hashes)
    if not (order[1:] == order[:-1]).any():
        return 0
    windows = list(zip(*(words[i : i + n] for i in range(WINDOW)), strict=True))
    found = Counter(windows)
    inside = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero([found[w] > 1 for w in windows])
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + WINDOW, -1)
    return int((np.cumsum(inside) > 0).sum())


def has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\v\f\r"))


def dup_lines(lines: list[str]) -> int:
    """Lines with a word that equal an earlier line."""
    filled = [line for line in lines if has_word(line)]
    return len(filled) - len(set(filled))


def shares(data: bytes) -> tuple[int, int, int, int, int, int]:
    """Symbols, capitals, small letters, digits, exclamation marks and bars among the bytes."""
    n = len(data)
    return (
        n - len(data.translate(None, _SYMBOL)),
        n - len(data.translate(None, _UPPER)),
        n - len(data.translate(None, _LOWER)),
        n - len(data.translate(None, _DIGIT)),
        data.count(b"!"),
        data.count(b"|"),
    )
