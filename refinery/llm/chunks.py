"""Texts cut at places that no token crosses, so that each different part of many texts is encoded once.

A chunk is a space or a line break with all that follows up to the next one. Arrow kernels cut a run of texts, give each
different chunk a number and put the ids of the chunks in the places of the texts; a model sees the different chunks alone.
Texts in which a model's tokens may cross such a place are cut by that model's own rule instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 1 << 23
KEPT_BYTES = 1 << 24  # of chunks and their ids that a model keeps from run to run

Ids = tuple[np.ndarray, np.ndarray]  # all ids in a row, and how many each chunk has


def cut(texts: pa.Array) -> pa.LargeListArray:
    """The chunks of each text; joined they are the text."""
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    flat, offsets = parts.flatten(), np.asarray(parts.offsets).astype(np.int64)
    bare = np.zeros(len(flat), bool)
    bare[offsets[:-1]] = True
    bare = pc.or_(pa.array(bare), pc.starts_with(flat, "\n"))
    whole = pc.if_else(bare, flat, pc.binary_join_element_wise(pa.scalar(" ", flat.type), flat, pa.scalar("", flat.type)))
    return pa.LargeListArray.from_arrays(pa.array(offsets), whole)


class ByChunk:
    """Ids of texts by a model that encodes arrays of chunks.

    ``learn`` gives the ids of some chunks; ``alone`` marks texts that can't be cut here, ``pieces`` cuts those. Chunks stay
    known from run to run until they fill ``KEPT_BYTES``; then those of the latest run alone do. Memory is that and a run.
    """

    def __init__(self, learn: Callable[[pa.Array], Ids], alone: Callable[[pa.Array], pa.Array], pieces: Callable[[str], list[str]], kind: pa.DataType):
        self.learn, self.alone, self.pieces = learn, alone, pieces
        self.known, self.ids = pa.array([""], pa.large_string()), _lists(np.zeros(0, np.int32), np.zeros(1, np.int64), kind)
        self.kind = kind

    def encode(self, texts: pa.Array) -> pa.LargeListArray:
        """The ids of each text of a run (large_string without NULL)."""
        alone = self.alone(texts)
        if not pc.any(alone).as_py():
            return self._encode(cut(texts))
        apart = pa.array(map(self.pieces, texts.filter(alone).to_pylist()), pa.large_list(pa.large_string()))
        return self._encode(put(cut(pc.if_else(alone, "", texts)), alone, apart))

    def _encode(self, chunks: pa.LargeListArray) -> pa.LargeListArray:
        coded = chunks.flatten().dictionary_encode()
        where = pc.index_in(coded.dictionary, value_set=self.known)
        new = pc.is_null(where)
        fresh = coded.dictionary.filter(new)
        if len(fresh):
            marked = new.to_numpy(zero_copy_only=False)
            place = where.fill_null(0).to_numpy().astype(np.int64)
            place[marked] = len(self.known) + np.arange(len(fresh))
            self.known = pa.concat_arrays([self.known, fresh])
            self.ids, where = pa.concat_arrays([self.ids, _lists(*self.learn(fresh), self.kind)]), pa.array(place)
        found = self.ids.take(where.take(coded.indices))
        if self.known.nbytes + self.ids.nbytes > KEPT_BYTES:
            self.known, self.ids = coded.dictionary, self.ids.take(where)
        ends = np.asarray(found.offsets)[np.asarray(chunks.offsets) - chunks.offsets[0].as_py()]
        return pa.LargeListArray.from_arrays(pa.array(ends - ends[0]), found.flatten())


def _lists(ids: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)), pa.array(ids).cast(kind))


def put(rows: pa.Array, where: pa.Array, others: pa.Array) -> pa.Array:
    """``rows`` with those marked by ``where`` replaced by ``others`` in order."""
    marked = where.to_numpy(zero_copy_only=False)
    order = np.arange(len(rows))
    order[marked] = len(rows) + np.arange(len(others))
    return pa.concat_arrays([rows, others]).take(pa.array(order))


def whole_texts(column: pa.Array) -> pa.Array:
    """A column of texts as ``ByChunk`` takes it; NULL is empty."""
    return column.cast(pa.large_string()).fill_null("")


def runs(texts: pa.Array, size: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Places of texts in runs of about ``size`` bytes, a longer text alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + size, "right")))
        yield first, last
        first = last
