"""Hashed word n-grams of whole texts with numpy, block by block."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from ledgerlens.llm.common import blocks
from ledgerlens.llm.tokens import mixed

PIECE = 1 << 20
WORD, SIGN = 1, 2

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
#: Letters, digits and what is beyond ASCII make words, other printable characters make signs, the rest separates.
_CLASS = np.where(_UPPER | _DIGIT | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128), WORD, np.where((_BYTES > 32) & (_BYTES < 127), SIGN, 0)).astype(np.uint8)
_VALUE = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, PIECE + 1), np.uint64(b), np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def _tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash (letters in lower case) and shape of each run of word or sign characters.

    Shapes: 1 a sign, 2 with digits, 3 lower case, 4 a capital first, 5 all capitals, 6 mixed.
    """
    points = np.frombuffer(data, np.uint8)
    kind = np.concatenate(([0], _CLASS[points], [0])).astype(np.int8)
    change = kind[1:] != kind[:-1]
    start = np.flatnonzero(change[:-1] & (kind[1:-1] > 0))
    end = np.flatnonzero(change[1:] & (kind[1:-1] > 0)) + 1
    up, down = _power(len(points) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[points] * up[:len(points)], dtype=np.uint64)))
    h = mixed((total[end] - total[start]) * down[start])
    capitals = np.concatenate(([0], np.cumsum(_UPPER[points])))
    digits = np.concatenate(([0], np.cumsum(_DIGIT[points])))
    n_up, size = capitals[end] - capitals[start], end - start
    first = _UPPER[points[start]] if len(start) else np.zeros(0, bool)
    shape = np.select([kind[1:-1][start] == SIGN, digits[end] > digits[start], n_up == 0, (n_up == 1) & first, n_up == size], [1, 2, 3, 4, 5], 6)
    return start, h, shape.astype(np.uint64)


def token_blocks(texts: Iterable[str | None], size: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of consecutive texts: the number of tokens of each, and hashes and shapes of all."""
    for _, held in blocks(texts, size):
        data = [t.encode("utf-8", "surrogatepass") for t in held]
        if len(data) == 1 and len(data[0]) > PIECE:  # a very long text goes piece by piece
            found, at, text = [], 0, data[0]
            while at < len(text):
                end = at + PIECE
                if end < len(text):
                    cut = max(text.rfind(b" ", at + 1, end), text.rfind(b"\n", at + 1, end))
                    end = cut if cut > at else end
                found.append(_tokens(text[at:end])[1:])
                at = end
            h, shape = (np.concatenate(x) for x in zip(*found))
            yield np.array([len(h)]), h, shape
            continue
        start, h, shape = _tokens(b"\0".join([*data, b""]))
        yield np.diff(np.searchsorted(start, np.cumsum([len(d) + 1 for d in data])), prepend=0), h, shape


def ngrams(counts: np.ndarray, h: np.ndarray, shape: np.ndarray, bits: int) -> np.ndarray:
    """Feature numbers, a column for each kind and a row for each token: words, pairs of words, and
    one to three shapes with signs as they are and repeats marked.  2^bits stands for no feature
    (at the start of a text).
    """
    none = np.uint32(1 << bits)
    place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
    before = lambda x, n: np.concatenate((np.zeros(n, np.uint64), x[:-n]))[:len(x)]
    same = (before(h, 1) == h) & (place > 0)
    form = np.where(shape == 1, h, shape + np.uint64(10) * same.astype(np.uint64))
    f1, f2 = before(form, 1), before(form, 2)
    kinds = [(h, 0), (mixed(before(h, 1), 1) ^ h, 1), (form, 0), (mixed(f1, 2) ^ form, 1), (mixed(f2, 3) ^ mixed(f1, 2) ^ form, 2)]
    out = np.empty((len(h), len(kinds)), np.uint32)
    for k, (key, least) in enumerate(kinds):
        out[:, k] = np.where(place >= least, mixed(key, 20 + k) >> np.uint64(64 - bits), none)
    return out
