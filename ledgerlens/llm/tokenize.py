"""Byte-level BPE of whole texts with the ``tokenizers`` library, fast enough for a corpus.

The library's pre-tokenizer cuts a text into pieces (words with their leading space, numbers,
punctuation, white space) and merges inside each piece alone, so a piece has the same ids wherever
it stands.  Pieces are found here with numpy over blocks of texts, and the library's model encodes
each distinct piece once for each Python worker; a bounded table keeps the ids.  Texts with
characters outside the ranges below, or with an added token (such as ``<|endoftext|>``) spelt out, go
through the library's own ``encode``.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from ledgerlens.llm.common import blocks

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2

#: Characters whose class is settled in every Unicode version: Latin and general punctuation.
SAFE = (0x250, 0x2000, 0x2070)
LETTER, NUMBER, SPACE, OTHER, BREAK = 1, 2, 3, 4, 0
#: White_Space characters in the safe ranges.
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
         0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F)
LONGEST = 64          # longer pieces are encoded each time
TABLE_BITS = 22       # slots of the table of pieces
MOST_PIECES = 1 << 21  # it starts anew beyond this


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def _class_table() -> np.ndarray:
    out = np.full(0x2071, OTHER, np.uint8)
    for cp in range(0x2070):
        kind = unicodedata.category(chr(cp))[0]
        out[cp] = SPACE if cp in WHITE else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    out[0x2070] = BREAK
    return out


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts; one for each vocabulary file and Python process."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def at(cls, path: str | None) -> Encoder:
        path = path or default_path()
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.classes, self.letters = _class_table(), _byte_letters()
        rng = np.random.Generator(np.random.PCG64(7))
        self.value = rng.integers(1, 1 << 63, 0x2071, dtype=np.uint64)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(1 << TABLE_BITS, np.uint64)
        self.at_id = np.zeros(1 << TABLE_BITS, np.int32)
        self.n_ids = np.zeros(1 << TABLE_BITS, np.int32)
        self.ids, self.used, self.pieces = np.zeros(1 << 20, self.width), 0, 0

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, and whether the key is there (else the slot is free)."""
        mask = np.uint64((1 << TABLE_BITS) - 1)
        slot = ((h ^ (h >> np.uint64(29))) & mask).astype(np.int64)
        there = self.key[slot] == h
        todo = np.flatnonzero(~there & (self.key[slot] != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(mask)
            now = self.key[slot[todo]]
            there[todo] = now == h[todo]
            todo = todo[(now != h[todo]) & (now != 0)]
        return slot, there

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        found = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]
        n = np.fromiter(map(len, found), np.int64, len(found))
        while self.used + int(n.sum()) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), self.width)])
        self.ids[self.used:self.used + int(n.sum())] = np.fromiter(chain.from_iterable(found), self.width, int(n.sum()))
        at = self.used + np.cumsum(n) - n
        slot, _ = self._find(hashes)
        todo = np.arange(len(hashes))
        while len(todo):  # of several new keys that meet in one slot, the first takes it
            free = todo[self.key[slot[todo]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.key[slot[put]], self.at_id[slot[put]], self.n_ids[slot[put]] = hashes[put], at[put], n[put]
            todo = todo[self.key[slot[todo]] != hashes[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << TABLE_BITS) - 1)
        self.used += int(n.sum())
        self.pieces += len(pieces)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width)

    def starts(self, points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Where a piece starts; ``points`` ends with a break and has one between texts."""
        start = np.ones(len(points), bool)
        start[1:] = kinds[1:] != kinds[:-1]
        start[1:] |= kinds[1:] == BREAK
        # The last white space before a word stands alone, and a blank joins the word.
        last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & (kinds[1:] != BREAK))
        start[last] = True
        blank = last[points[last] == 0x20]
        start[blank + 1] = False
        # An apostrophe alone takes a following s, t, m, d, re, ve or ll.
        quote = np.flatnonzero(points[:-1] == 0x27)
        quote = quote[start[quote] & (kinds[quote + 1] == LETTER)]
        if len(quote):
            a, b = points[quote + 1], points[np.minimum(quote + 2, len(points) - 1)]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            for hit, n in ((quote[one], 1), (quote[two], 2)):
                start[hit + 1] = False
                start[hit + n + 1] = True
        return start

    def block(self, texts: list[str], joined: str, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        if self.pieces > MOST_PIECES:
            self._clear()
        kinds = self.classes[np.minimum(points, 0x2070)]
        begin = self.starts(points, kinds)
        s = np.flatnonzero(begin)
        e = np.append(s[1:], len(points))
        real = kinds[s] != BREAK
        s, e = s[real], e[real]
        self._powers(len(points) + 1)
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(self.value[points] * self.up[:len(points)], out=total[1:])
        h = ((total[e] - total[s]) * self.down[s]) | np.uint64(1)
        slot, there = self._find(h)
        long = (e - s) > LONGEST
        new = np.flatnonzero(~there & ~long)
        if len(new):
            fresh, first = np.unique(h[new], return_index=True)
            self._learn(fresh, [joined[s[i]:e[i]] for i in new[first].tolist()])
            slot, there = self._find(h)
        source, at, n = self.ids, self.at_id[slot].astype(np.int64), self.n_ids[slot].astype(np.int64)
        if long.any():
            extra, used = [source[:self.used]], self.used
            for i in np.flatnonzero(long).tolist():
                ids = self.plain(joined[s[i]:e[i]])
                at[i], n[i] = used, len(ids)
                extra.append(ids)
                used += len(ids)
            source = np.concatenate(extra)
        ends = np.cumsum(n)
        ids = source[np.repeat(at - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        stops = np.cumsum([len(t) + 1 for t in texts])
        upto = np.concatenate(([0], ends))[np.searchsorted(s, stops)]
        return ids, np.diff(upto, prepend=0)

    def encode(self, texts, size: int = 1 << 17) -> Iterator[np.ndarray]:
        """The ids of each text in turn (null: none), with bounded memory beside the text itself."""
        for _, held in blocks(texts, size):
            joined, points = laid_out(held)
            special = any(a in joined for a in self.added)
            if not special and settled(points, len(held)):
                yield from np.split(*self._cuts(held, joined, points))
                continue
            for t in held:
                if special and any(a in t for a in self.added):
                    yield self.plain(t)
                    continue
                joined, points = laid_out([t])
                yield self.block([t], joined, points)[0] if settled(points, 1) else self.plain(t)

    def _cuts(self, held, joined, points):
        ids, n = self.block(held, joined, points)
        return ids, np.cumsum(n)[:-1]


def laid_out(texts: list[str]) -> tuple[str, np.ndarray]:
    """The texts in a row, a break after each, and the code points."""
    joined = "⁰".join([*texts, ""])
    return joined, np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)


def settled(points: np.ndarray, n: int) -> bool:
    """Whether all characters but the ``n`` breaks have a settled class."""
    high = points[points >= SAFE[0]]
    return bool((high >= SAFE[1]).all() and (high <= SAFE[2]).all()) and int((high == SAFE[2]).sum()) == n


def id_crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
