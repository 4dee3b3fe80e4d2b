"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes outside space and 0x09-0x0D. Its hash is that of its bytes alone; a shingle's hash is
that of the hashes of its words in order. Two different shingles share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

BYTES_AT_ONCE = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits; one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: np.uint64) -> np.ndarray:
        found = np.full(n + 1, base, np.uint64)
        found[0] = 1
        return np.multiply.accumulate(found)

    return of(_BASE), of(_INVERSE)


class Words:
    """The words of some texts: ``hashes`` of all in order, text i has those from ``begin[i]`` to ``begin[i + 1]``."""

    def __init__(self, texts: list[bytes], lower: bool):
        self.n = len(texts)
        joined = b" ".join([*texts, b""]) if texts else b" "
        self.bytes = np.frombuffer(joined, np.uint8)
        if lower:
            self.bytes = _LOWER[self.bytes]
        sizes = np.array([len(text) + 1 for text in texts], np.int64)
        self.text_begin = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.concatenate([[False], ~WHITE[self.bytes], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.begin = np.searchsorted(self.starts, self.text_begin)
        room = max(BYTES_AT_ONCE * 2, 1 << int(len(self.bytes)).bit_length())
        powers, inverses = _powers(room)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers[: len(self.bytes)])])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * inverses[self.starts])

    def counts(self) -> np.ndarray:
        return np.diff(self.begin)

    def windows(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words inside a text, and where (in ``hashes``) each begins."""
        total = len(self.hashes)
        if total < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        found = np.zeros(total - size + 1, np.uint64)
        for k in range(size):
            found += self.hashes[k : total - size + 1 + k] * _FACTORS[k % len(_FACTORS)] + np.uint64(k)
        last = np.repeat(self.begin[1:], self.counts())[: len(found)]
        at = np.flatnonzero(np.arange(len(found)) + size <= last)
        return mix(found[at]), at

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text, ascending, and where each text's begin; of fewer words the whole sequence is one."""
        hashes, at = self.windows(size)
        owner = np.searchsorted(self.begin, at, "right") - 1
        counts = self.counts()
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            whole = []
            for text in short.tolist():
                words = self.hashes[self.begin[text] : self.begin[text + 1]]
                whole.append(np.sum(words * _FACTORS[: len(words)] + np.uint64(len(words)), dtype=np.uint64))
            hashes = np.concatenate([hashes, mix(np.array(whole, np.uint64))])
            owner = np.concatenate([owner, short])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        if len(hashes):
            new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
            hashes, owner = hashes[new], owner[new]
        return hashes, np.searchsorted(owner, np.arange(self.n + 1))


def in_parts(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes (NULL: empty) in runs of about ``BYTES_AT_ONCE``, a longer text alone; with each run's first place."""
    first, size, part = 0, 0, []
    for place, text in enumerate(texts):
        raw = text.encode() if text else b""
        if part and size + len(raw) > BYTES_AT_ONCE:
            yield first, part
            first, size, part = place, 0, []
        part.append(raw)
        size += len(raw)
    if part:
        yield first, part
