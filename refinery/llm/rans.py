"""Static range asymmetric numeral system over token ids.

One table of frequencies is shared by all blocks. A block interleaves many coder states ("lanes"): symbol i belongs
to lane i % lanes, so one step codes a symbol of every lane at once. Each block can be decoded without the others,
and from any of its checkpoints (the states and the place in the word stream before a step).

States are 64 bits wide and are kept in [2^31, 2^63); words are 32 bits.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MAGIC = b"RNS1"
_HEADER = struct.Struct("<4sIIIIIII")  # magic, symbols, lanes, steps between checkpoints, checkpoints, words, table's and ids' crc32


class Table:
    """Frequencies scaled to a power of two, at least 1 for every symbol that occurs."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray, bits: int = 20):
        """``symbols`` ascending with ``counts`` above 0; at most 2^bits of them. Deterministic."""
        symbols, counts = np.asarray(symbols, np.uint32), np.asarray(counts, np.float64)
        total = 1 << bits
        if len(symbols) > total:
            raise ValueError(f"{len(symbols)} symbols do not fit a table of {total}")
        self.bits = bits
        self.symbols = symbols
        if len(symbols):
            scaled = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
            rest = total - int(scaled.sum())
            if rest > 0:
                scaled[int(np.argmax(counts))] += rest
            while rest < 0:  # many rare symbols were raised to 1: the most frequent ones give way
                most = int(np.argmax(scaled))
                taken = min(-rest, int(scaled[most]) // 2)
                scaled[most] -= taken
                rest += taken
        else:
            scaled = np.zeros(0, np.int64)
        self.frequency = scaled.astype(np.uint64)
        self.start = (np.cumsum(scaled) - scaled).astype(np.uint64)
        self.place = np.repeat(np.arange(len(symbols), dtype=np.uint32), scaled)
        # Ids are found by a list of all numbers up to the largest, where that is no vast one.
        self.at = None
        if len(symbols) and symbols[-1] < total:
            self.at = np.full(int(symbols[-1]) + 1, len(symbols), np.uint32)
            self.at[symbols] = np.arange(len(symbols))
        self.crc = zlib.crc32(self.frequency.tobytes(), zlib.crc32(symbols.tobytes()))

    def index(self, ids: np.ndarray) -> np.ndarray:
        """Places of ids among the symbols. Every id must be in the table."""
        if not len(ids):
            return np.zeros(0, np.uint32)
        if self.at is None:
            found = np.searchsorted(self.symbols, ids)
        else:
            found = self.at[np.minimum(ids, len(self.at) - 1)]
        if not len(self.symbols) or found.max() >= len(self.symbols) or not np.array_equal(self.symbols[found], ids):
            raise ValueError("an id is not in the table")
        return found

    def to_bytes(self) -> bytes:
        return struct.pack("<II", self.bits, len(self.symbols)) + self.symbols.tobytes() + self.frequency.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        bits, n = struct.unpack_from("<II", data)
        symbols = np.frombuffer(data, "<u4", n, 8)
        return cls(symbols, np.frombuffer(data, "<u4", n, 8 + 4 * n), bits)


def encode(ids: np.ndarray, table: Table, lanes: int = 2048, checkpoint_steps: int = 64) -> bytes:
    """One block. Every id must be in the table. An empty block is a bare header."""
    ids = np.asarray(ids, np.uint32)
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    index = table.index(ids)
    frequency, start = table.frequency[index], table.start[index]
    bits = np.uint64(table.bits)
    room = frequency << np.uint64(63 - table.bits)
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = []
    saved: list[tuple[int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        here = slice(step * lanes, min(n, (step + 1) * lanes))
        x, f = state[: here.stop - here.start], frequency[here]
        full = x >= room[here]
        if full.any():
            out = x[full]
            words.append(out.astype(np.uint32))
            written += len(out)
            x[full] = out >> _WORD
        quotient = x // f
        x[:] = (quotient << bits) + (x - quotient * f) + start[here]
        if step and step % checkpoint_steps == 0:
            saved.append((written, state.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    saved = saved[::-1]
    head = _HEADER.pack(_MAGIC, n, lanes, checkpoint_steps, len(saved), len(stream), table.crc, zlib.crc32(ids.astype("<u4").tobytes()))
    checkpoints = b"".join(struct.pack("<I", len(stream) - at) + lane_states.astype("<u8").tobytes() for at, lane_states in saved)
    return head + state.astype("<u8").tobytes() + checkpoints + stream.astype("<u4").tobytes()


def decode(block: bytes, table: Table, checkpoint: int = 0) -> np.ndarray:
    """Ids of a block from a checkpoint on (0: the start, checked against its crc32; k: the k-th checkpoint)."""
    magic, n, lanes, every, checkpoints, n_words, table_crc, crc = _HEADER.unpack_from(block)
    if magic != _MAGIC or table_crc != table.crc:
        raise ValueError("not a block of this table")
    at = _HEADER.size
    each = 4 + 8 * lanes
    words_at = at + 8 * lanes + checkpoints * each
    if len(block) != words_at + 4 * n_words:
        raise ValueError("a block is cut short")
    position = 0
    if checkpoint:
        at += 8 * lanes + (checkpoint - 1) * each
        (position,) = struct.unpack_from("<I", block, at)
        at += 4
    state = np.frombuffer(block, "<u8", lanes, at).astype(np.uint64)
    words = np.frombuffer(block, "<u4", n_words, words_at).astype(np.uint64)
    first = checkpoint * every * lanes
    out = np.empty(n - first, np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for begin in range(first, n, lanes):
        stop = min(n, begin + lanes)
        x = state[: stop - begin]
        slot = x & mask
        place = table.place[slot]
        out[begin - first : stop - first] = place
        x[:] = table.frequency[place] * (x >> bits) + slot - table.start[place]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = (x[low] << _WORD) | words[position : position + len(low)]
            position += len(low)
    ids = table.symbols[out] if len(out) else out
    if position != n_words or (state != _LOW).any() or (not checkpoint and zlib.crc32(ids.astype("<u4").tobytes()) != crc):
        raise ValueError("a block does not match its checksum")
    return ids
