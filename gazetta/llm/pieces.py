"""Token ids of texts from a memory of pieces, for byte-level tokenizers.

Byte-level tokenizers split a text by a pattern and encode each match alone. A
match never reaches over the start of a space that a visible character
follows (nor over some other places), so texts are cut there first, and the ids of every distinct cut, and
of every distinct match in it, are worked out once and kept in the worker.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from gazetta.llm.util import hash_ranges, ranges

#: The pattern that splits text before the merges (a fixed value of the public vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: First bytes of printable ASCII and of U+00C0 to U+027F: before a space and one
#: of these there is always an end between two matches.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xCA] = True
#: Between an ASCII letter and ASCII punctuation, too, and between punctuation
#: other than an apostrophe (which may begin 's, 't, ...) and a letter.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[[*range(48, 58), *range(128, 256)]] = False
_BEFORE_LETTER = _MARK.copy()
_BEFORE_LETTER[ord("'")] = False
_MATCH = regex.compile(PATTERN)


def cuts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each cut, cuts per text)."""
    n = len(raw)
    mark = np.zeros(n + 1, bool)
    if n:
        letter, a, b = _LETTER[raw], raw[:-1], raw[1:]
        mark[: n - 1] = (a == 32) & _VISIBLE[b]
        inner = offsets[(offsets > 0) & (offsets < n)]
        mark[inner - 1] = False  # its visible character is in the next text
        mark[1:n] |= (letter[:-1] & _MARK[b]) | (_BEFORE_LETTER[a] & letter[1:])
        mark[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(mark)
    return start, np.diff(np.searchsorted(start, offsets))


class _Pool:
    """Id lists by code, in growing arrays."""

    def __init__(self):
        self.ids, self.start, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = self.n = 0

    def add(self, ids: np.ndarray, size: np.ndarray):
        n, m = self.n, len(size)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + m > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.ids[self.used: self.used + len(ids)] = ids
        self.size[n: n + m] = size
        self.start[n: n + m] = self.used + np.cumsum(size) - size
        self.used, self.n = self.used + len(ids), n + m

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[codes]
        return self.ids[ranges(self.start[codes], size)], size


class Memory:
    """Ids of strings; ``encode`` gives (all ids, ids per string) of new ones.
    Forgets everything when more than ``most`` strings are held."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int):
        self.encode, self.most = encode, most
        self.code, self.pool = {}, _Pool()

    def of_new(self, keys: list, string_at: Callable[[int], str]) -> np.ndarray:
        """Codes of distinct keys; ``string_at(i)`` is the string of the i-th."""
        new = [i for i, k in enumerate(keys) if k not in self.code]
        if len(self.code) + len(new) > self.most:
            self.code, self.pool, new = {}, _Pool(), range(len(keys))
        if len(new):
            ids, size = self.encode([string_at(i) for i in new])
            self.code.update(zip((keys[i] for i in new), range(self.pool.n, self.pool.n + len(new))))
            self.pool.add(ids, size)
        return np.fromiter(map(self.code.__getitem__, keys), np.int64, len(keys))


def by_match(encode_matches: Callable) -> Callable:
    """An ``encode`` for ``TextIds`` that splits cuts by the pattern."""

    def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [_MATCH.findall(c) for c in new]
        flat = [m for f in found for m in f]
        code = {m: i for i, m in enumerate(dict.fromkeys(flat))}
        ids, size = encode_matches(list(code))
        at = np.fromiter(map(code.__getitem__, flat), np.int64, len(flat))
        start = np.cumsum(size) - size
        return ids[ranges(start[at], size[at])], per_group(size[at], np.fromiter(map(len, found), np.int64, len(found)))

    return encode


def per_group(sizes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Sums of ``sizes`` over consecutive groups of so many entries."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.cumsum(groups)
    return total[ends] - total[ends - groups]


class TextIds:
    """Ids of texts; ``encode`` gives (all ids, ids per cut) of new cuts."""

    def __init__(self, encode: Callable, most: int = 500_000):
        self.memory = Memory(encode, most)

    def of(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids per text)."""
        start, per_text = cuts(raw, offsets)
        size = np.diff(np.concatenate([start, [len(raw)]]))
        keys, first, where = np.unique(hash_ranges(raw, start, size), return_index=True, return_inverse=True)
        lo, hi, data = start[first].tolist(), (start + size)[first].tolist(), raw.tobytes()
        codes = self.memory.of_new(keys.tolist(), lambda i: data[lo[i]: hi[i]].decode())
        ids, sizes = self.memory.pool.get(codes[where])
        return ids, per_group(sizes, per_text)
