"""Documents packed into sequences of a fixed size by first-fit decreasing, in randomised groups.

A document longer than a sequence is cut into full sequences where it is encoded; these need no partner. What is left of each
document goes to a group drawn from the place of the row, so equal rows and hot sources are spread like any others. In a group
the longest piece comes first and goes to the first sequence with room: a tournament tree holds the room of the sequences in
its leaves and the larger of two children in each node above, so a sequence is found in as many steps as the tree is high.

First-fit decreasing leaves gaps where no piece is as short as what is left. A gap beyond ``spare`` ids is filled by cutting
pieces of the group's last sequences, and the one sequence that is then left part-full is cut into powers of two, which
trainers take without padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.encoder import as_binary, encoder
from refinery.llm.tables import stored

SEQUENCE_IDS = 2048
GROUP_IDS = 1 << 19  # ids of a group, about: 1 MB
SPARE = 16
_PIECE = "doc_id bigint, doc_tokens bigint, start bigint, length bigint, ids binary"
_PIECE_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("part", pa.int64()), ("number", pa.int64()),
])
_PLACED = f"{_PIECE}, sequence_id bigint, offset bigint"
_PLACED_ARROW = pa.schema([*list(_PIECE_ARROW)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())])
_NUMBERS = 33  # bits of a number within its task or group; the task or group stands above


class Rooms:
    """Sequences in order with the room that each has left, in a tournament tree."""

    def __init__(self, sequences: int, size: int):
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.room = [size] * (2 * self.leaves)

    def take(self, length: int) -> int:
        """The first sequence with room for ``length``; the room is taken."""
        room, node = self.room, 1
        if room[1] < length:
            raise ValueError(f"no sequence has room for {length}")
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        found = node - self.leaves
        room[node] -= length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return found


def pack(lengths: list[int], size: int, spare: int = SPARE) -> list[list[tuple[int, int, int]]]:
    """Sequences, each a list of (piece, start in it, length); ``lengths`` are positive and at most ``size``.

    Longest first, equal ones in the order given. Every id of every piece is in exactly one place.
    """
    rooms = Rooms(len(lengths), size)
    sequences: list[list[tuple[int, int, int]]] = []
    for piece in sorted(range(len(lengths)), key=lambda piece: -lengths[piece]):
        place = rooms.take(lengths[piece])
        if place == len(sequences):
            sequences.append([])
        sequences[place].append((piece, 0, lengths[piece]))
    return _without_gaps(sequences, size, spare)


def _used(sequence: list[tuple[int, int, int]]) -> int:
    return sum(length for _, _, length in sequence)


def _without_gaps(sequences: list[list[tuple[int, int, int]]], size: int, spare: int) -> list[list[tuple[int, int, int]]]:
    """Fills gaps beyond ``spare`` from the last sequences; a rest that is still part-full becomes powers of two."""
    at = 0
    while at < len(sequences):
        gap = size - _used(sequences[at])
        if gap <= spare:
            at += 1
            continue
        if at == len(sequences) - 1:
            return sequences[:-1] + _powers_of_two(sequences[-1])
        donor = sequences[-1]
        while gap and donor:
            piece, start, length = donor.pop()
            taken = min(gap, length)
            sequences[at].append((piece, start, taken))
            gap -= taken
            if taken < length:
                donor.append((piece, start + taken, length - taken))
        if not donor:
            sequences.pop()
    return sequences


def _powers_of_two(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces of one sequence in several without padding, the longest first."""
    left, rest, found = _used(sequence), list(reversed(sequence)), []
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        found.append([])
        while room:
            piece, start, length = rest.pop()
            taken = min(room, length)
            found[-1].append((piece, start, taken))
            room -= taken
            if taken < length:
                rest.append((piece, start + taken, length - taken))
    return found


def packed(
    docs: DataFrame, model: str, pattern: str, end_id: int, size: int = SEQUENCE_IDS, group_ids: int = GROUP_IDS, spare: int = SPARE
) -> DataFrame:
    """Every piece of every document: ``doc_id``, ``doc_tokens``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    ``model`` is the content of a tokenizers file and ``pattern`` cuts texts where it does; ``end_id`` ends each document, so a
    NULL or empty text is one id. ``ids`` are little-endian numbers, of 2 bytes if the vocabulary allows. ``offset`` is the
    piece's place in its sequence; pieces of a sequence follow each other from 0 without a gap and hold ``size`` ids at most.
    Sequence ids are unique, not dense. Repeated rows and NULL ids are packed like others, each row by itself; columns other
    than ``doc_id`` and ``text`` are ignored; no documents give no pieces. The same rows in the same files are packed alike.
    """
    pieces = stored(_pieces(docs, model, pattern, end_id, size), "pieces")
    full = F.col("length") == size
    number = F.shiftleft("part", _NUMBERS) + F.col("number")
    alone = pieces.filter(full).select(*_PLACED_ARROW.names[:5], (number * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = pieces.filter(~full)
    total = rest.agg(F.sum("length")).first()[0] or 0
    drawn = F.pmod(F.xxhash64("part", "number"), F.lit(-(-total // group_ids) or 1)).alias("group")
    width = np.dtype(encoder(model, pattern).kind).itemsize

    def place(key: tuple[pa.Scalar, ...], found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(found).sort_by([("part", "ascending"), ("number", "ascending")])
        group = key[0].as_py() << _NUMBERS
        yield _rows(table, pack(table.column("length").to_pylist(), size, spare), group, width)

    grouped = rest.select(*_PIECE_ARROW.names, drawn).groupBy("group").applyInArrow(place, _PLACED)
    return alone.unionByName(grouped)


def _pieces(docs: DataFrame, model: str, pattern: str, end_id: int, size: int) -> DataFrame:
    """Documents cut into full sequences and a rest; ``part`` and ``number`` tell all rows apart, equal ones too."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = encoder(model, pattern)
        part, number = TaskContext.get().partitionId(), 0
        for batch in found:
            for a, b, ids, begin in shared.ended(batch.column("text"), end_id):
                tokens = np.diff(begin)
                pieces = -(-tokens // size)
                doc = np.repeat(np.arange(b - a), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
                length = np.minimum(tokens[doc] - start, size)
                arrays = [
                    batch.column("doc_id").slice(a, b - a).take(pa.array(doc)), pa.array(tokens[doc]), pa.array(start), pa.array(length),
                    as_binary(ids, np.append(begin[doc] + start, begin[-1])), pa.array(np.full(len(doc), part)),
                    pa.array(number + np.arange(len(doc))),
                ]
                number += len(doc)
                yield pa.RecordBatch.from_arrays(arrays, schema=_PIECE_ARROW)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(batches, f"{_PIECE}, part bigint, number bigint")


def _rows(table: pa.Table, sequences: list[list[tuple[int, int, int]]], group: int, width: int) -> pa.RecordBatch:
    """The packed pieces of one group, with their ids."""
    piece, begin, length = (np.array([place[i] for sequence in sequences for place in sequence], np.int64) for i in range(3))
    sizes = [len(sequence) for sequence in sequences]
    before = np.concatenate([[0], np.cumsum(length)])
    firsts = np.cumsum([0, *sizes[:-1]])
    offset = before[:-1] - np.repeat(before[firsts], sizes)
    number = np.repeat(np.arange(len(sizes)), sizes)
    rows = table.take(pa.array(piece))
    ids = [
        raw[a * width : (a + n) * width]
        for raw, a, n in zip(rows.column("ids").to_pylist(), begin.tolist(), length.tolist(), strict=True)
    ]
    arrays = [
        rows.column("doc_id"), rows.column("doc_tokens"), pa.array(rows.column("start").to_numpy() + begin), pa.array(length),
        pa.array(ids, pa.binary()), pa.array((group + number) * 2 + 1), pa.array(offset),
    ]
    flat = [array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array for array in arrays]
    return pa.RecordBatch.from_arrays(flat, schema=_PLACED_ARROW)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids`` of each sequence of ``packed``, the ids of its pieces joined in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    empty = F.lit(b"")
    return joined.select("sequence_id", "length", F.aggregate("parts", empty, lambda ids, part: F.concat(ids, part["ids"])).alias("ids"))


def checksums(ids: Column, kind: str) -> Column:
    """CRC-32 of the ids of each row (little-endian numbers of type ``kind``), taken as numbers of 4 bytes."""

    @F.arrow_udf("bigint")
    def sums(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([zlib.crc32(np.frombuffer(row.as_buffer(), kind).astype("<u4").tobytes()) for row in batch], pa.int64())

    return sums(ids)
