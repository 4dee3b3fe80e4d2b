"""Byte-level BPE by two-tier lookup: a minimal perfect hash over the vocabulary, merges only for what it misses.

A text is cut into pre-tokens by a pattern. A pre-token that is itself in the vocabulary is one probe of the
hash. Any other is merged from single bytes: neighbours are linked, candidate merges wait in a heap, lowest rank
first and leftmost among equals, so a pre-token of n bytes takes O(n log n) whatever its length.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from refinery.llm.chunks import ByChunk, Ids, runs, whole_texts
from refinery.llm.encoder import has_long_space

_SECOND_SEED = 0x9E3779B9
_LISTS_AT_ONCE = 2048


class PerfectHash:
    """A minimal perfect hash over byte strings: n keys on n slots, two arrays of numbers, no stored keys.

    A key's first hash names its bucket, the bucket's displacement sends each of its keys to a slot of its own.
    Any other string lands on some slot too, so the caller compares it with the key found there.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size // 3)
        self.shift = np.zeros(self.buckets, np.int64)
        members: dict[int, list[int]] = {}
        for index, key in enumerate(keys):
            members.setdefault(zlib.crc32(key) % self.buckets, []).append(index)
        self.slots = np.full(self.size, -1, np.int64)
        free = iter(range(self.size))
        for bucket, found in sorted(members.items(), key=lambda item: -len(item[1])):
            if len(found) == 1:
                slot = next(slot for slot in free if self.slots[slot] < 0)
                self.shift[bucket], self.slots[slot] = -slot - 1, found[0]
                continue
            for displacement in range(1 << 30):
                places = [self._displaced(keys[index], displacement) for index in found]
                if len(set(places)) == len(places) and all(self.slots[place] < 0 for place in places):
                    break
            self.shift[bucket] = displacement
            self.slots[places] = found
        self._shift, self._slots = self.shift.tolist(), self.slots.tolist()

    def _displaced(self, key: bytes, displacement: int) -> int:
        return zlib.crc32(key, (_SECOND_SEED + displacement * 0x85EBCA6B) & 0xFFFFFFFF) * 0x9E3779B97F4A7C15 % (1 << 64) % self.size

    def index(self, key: bytes) -> int:
        """Place in the list of keys of the one key that ``key`` can be."""
        shift = self._shift[zlib.crc32(key) % self.buckets]
        return self._slots[-shift - 1 if shift < 0 else self._displaced(key, shift)]


class Vocabulary:
    """Token strings and their ranks; a rank is the token's id and the order of its merge."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens = list(ranks)
        self.ids = list(ranks.values())
        self.ranks = ranks
        self.whole = PerfectHash(self.tokens) if ranks else None
        self.pattern = regex.compile(pattern)
        self.by_chunk = ByChunk(self._learn, has_long_space, self.pattern.findall, pa.int32())

    def encode(self, texts: pa.Array) -> pa.LargeListArray:
        """Ids of each text of a run, without special tokens."""
        return self.by_chunk.encode(texts)

    def _learn(self, chunks: pa.Array) -> Ids:
        found = list(map(self.pattern.findall, chunks.to_pylist()))
        ids = {piece: self._piece(piece.encode()) for piece in set().union(*found)}
        own = [list(chain.from_iterable(map(ids.__getitem__, pieces))) for pieces in found]
        return np.fromiter(chain.from_iterable(own), np.int32), np.array(list(map(len, own)), np.int64)

    def _piece(self, piece: bytes) -> list[int]:
        index = self.whole.index(piece)
        if self.tokens[index] == piece:
            return [self.ids[index]]
        return self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token: the lowest-ranked pair of neighbours is joined until no pair is in the vocabulary."""
        ranks, n = self.ranks, len(piece)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is part of another
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not end[i] or j >= n or end[j] != stop:
                continue  # one of the two has changed since
            end[i], end[j], after[i] = stop, 0, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (rank := ranks.get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (rank, i, end[after[i]]))
            if before[i] >= 0:
                if (rank := ranks.get(piece[before[i] : stop])) is not None:
                    heapq.heappush(heap, (rank, before[i], stop))
        found, i = [], 0
        while i < n:
            found.append(ranks[piece[i : end[i]]])
            i = after[i]
        return found


def read_ranks(path: str) -> bytes:
    """A rank file (one base64 token and its rank a line), read once on the driver."""
    with open(path, "rb") as file:
        return file.read()


def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


@lru_cache(maxsize=1)
def _vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(_ranks(ranks), pattern)


@lru_cache(maxsize=1)
def _tokens(ranks: bytes) -> tuple[pa.Array, np.ndarray]:
    """The token of each id, one after the other, and its length."""
    of = {rank: token for token, rank in _ranks(ranks).items()}
    rows = [of.get(i) for i in range(max(of, default=-1) + 1)]
    return pa.array(rows, pa.large_binary()), np.array([len(row or b"") for row in rows], np.int64)


def _joined(ids: pa.Array, tokens: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The bytes of each list of ids: all tokens in a row by one take, cut where the lists end."""
    ids = ids.fill_null([])
    found = tokens.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id that the vocabulary does not have")
    ends = np.concatenate([[0], np.cumsum(sizes[ids.flatten().to_numpy()])])[np.asarray(ids.offsets) - ids.offsets[0].as_py()]
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), found.buffers()[2]]).cast(pa.binary())


def encode(text: Column, ranks: bytes, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Ids (array<int>) of a text column, whole texts, each match of ``pattern`` separately; NULL counts as empty.

    An empty text has no ids, a repeated one the same ids again, and other columns of the table are not touched.
    ``ranks`` is the content of a rank file; it is sent to the tasks with the function, about 1 MB.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(ranks, pattern)
        for batch in batches:
            texts = whole_texts(batch)
            found = [vocabulary.encode(texts.slice(a, b - a)).cast(pa.list_(pa.int32())) for a, b in runs(texts)]
            yield pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))
            pa.default_memory_pool().release_unused()

    return ids(text)


def decode(ids: Column, ranks: bytes) -> Column:
    """Bytes of a column of ids (array<int>); NULL counts as no ids. An id outside the vocabulary is an error."""

    @F.arrow_udf("binary")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, sizes = _tokens(ranks)
        for batch in batches:
            parts = [_joined(batch.slice(at, _LISTS_AT_ONCE), tokens, sizes) for at in range(0, len(batch), _LISTS_AT_ONCE)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())
            pa.default_memory_pool().release_unused()

    return text(ids)
