"""Ids of the tokenizers library for many texts: each different part of a run of texts is asked for once.

Where the model's file allows, the library's merges are asked for pre-tokens alone, cut by the pattern and written in the
byte-level alphabet here: nearly half of the library's time for a word goes into places in the text that nothing reads. Some
pre-tokens at a time are one piece, with a letter between them that no merge has, as each piece has its own cost.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, models, pre_tokenizers

from refinery.llm.chunks import ByChunk, Ids, put, runs, whole_texts

_WORDS_AT_ONCE = 20_000
_JOINED = 32  # pre-tokens that go to the library in one piece
_JOINT = "\xff"  # what a byte that is in no text is written as; a model of texts has no merge for it
_MARKS = ".,;:!?)"
# All that any of the libraries takes for white space.
_WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_LETTERS = "".join(filter(str.isalpha, map(chr, range(0x250))))
_ENDS_IN_LETTER = rf"[{_LETTERS}]\z"
_ONE_WORD = rf"\A ?[{_LETTERS}]+\z"
# A space or line break with white space before it and white space, or nothing, behind it: runs of three and more, and runs of
# two at the end. Byte-level patterns keep all but the last character of a run together.
_LONG_SPACE = rf"[{_WHITE}][ \n]([{_WHITE}]|\z)"


def _byte_letters() -> list[str]:
    """The character of the byte-level alphabet for each byte: itself if it can be printed, else the next one from U+0100 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in printed else next(others)) for byte in range(256)]


_BYTE_LETTERS = _byte_letters()
_FIRST, _SECOND = (np.array([(letter.encode() + b"\0")[i] for letter in _BYTE_LETTERS], np.uint8) for i in range(2))


def _ends(rows: pa.Array) -> np.ndarray:
    """Where each of some large strings or binaries begins in their bytes, and where the last ends."""
    return np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]


def _in_byte_letters(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words in the byte-level alphabet, and how many of its letters each has."""
    ends = _ends(words)
    raw = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    wide = _SECOND[raw] > 0
    place = np.concatenate([[0], np.cumsum(1 + wide)])
    letters = np.empty(place[-1], np.uint8)
    letters[place[:-1]] = _FIRST[raw]
    letters[place[:-1][wide] + 1] = _SECOND[raw[wide]]
    edges = pa.py_buffer(place[ends - ends[0]].astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(words), edges, pa.py_buffer(letters)), np.diff(ends)


def has_long_space(texts: pa.Array) -> pa.Array:
    """Whether pre-tokens of a text may cross the edge of a chunk."""
    return pc.match_substring_regex(texts, _LONG_SPACE)


class Encoder:
    """A byte-level model of the library. ``plain`` takes the strings of its special tokens for text; else they are its tokens."""

    def __init__(self, model: str, pattern: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        arrow = pa.uint16() if self.kind == "<u2" else pa.uint32()
        self.pieces = regex.compile(pattern).findall
        self.bare = Tokenizer(self.tokenizer.model) if _is_plain(self.tokenizer) else None
        if self.bare:
            vocabulary = self.bare.get_vocab()
            self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
            self.joint = vocabulary[_JOINT]
        mixed = " " + _LETTERS + _LETTERS[::-1]
        self.words_are_whole = self.pieces(mixed) == [mixed]
        self.by_chunk = ByChunk(self._learn, has_long_space, self.pieces, arrow)

    def lists(self, texts: pa.Array) -> pa.LargeListArray:
        """Ids of each text of a run; a text with a special token's string goes to the library whole."""
        whole = pa.array(np.zeros(len(texts), bool))
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        if not pc.any(whole).as_py():
            return self.by_chunk.encode(texts)
        ids = [self.tokenizer.encode(text, add_special_tokens=False).ids for text in texts.filter(whole).to_pylist()]
        found = self.by_chunk.encode(pc.if_else(whole, "", texts))
        return put(found, whole, pa.array(ids, found.type))

    def ended(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs of texts (NULL: empty): first and last place, all ids with ``end_id`` after each text, and where each text begins."""
        texts = whole_texts(column)
        for a, b in runs(texts):
            lists = self.lists(texts.slice(a, b - a))
            begin = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            yield a, b, np.insert(lists.flatten().to_numpy(), begin[1:], end_id), begin + np.arange(len(begin))
            del lists
            pa.default_memory_pool().release_unused()

    def _learn(self, chunks: pa.Array) -> Ids:
        """Words and the marks behind them are asked for apart: byte-level patterns end a run of letters before such a mark."""
        words = pc.utf8_rtrim(chunks, characters=_MARKS)
        ends = _ends(chunks)
        inside = pc.binary_length(words).to_numpy()
        apart = (inside < np.diff(ends)) & pc.match_substring_regex(words, _ENDS_IN_LETTER).to_numpy(zero_copy_only=False)
        # A word and its marks lie behind each other, so parts are the same bytes with one more edge.
        edges = np.insert(ends, np.flatnonzero(apart) + 1, (ends[:-1] + inside)[apart])
        parts = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), chunks.buffers()[2]).dictionary_encode()
        ids, counts = self._pieces(parts.dictionary) if self.bare else self._asked(parts.dictionary.to_pylist())
        return _spread(ids, counts, parts.indices, np.concatenate([[0], np.cumsum(1 + apart)]))

    def _pieces(self, parts: pa.Array) -> Ids:
        """Ids of different parts by way of their different pre-tokens; a run of letters is one."""
        one = pc.match_substring_regex(parts, _ONE_WORD) if self.words_are_whole else pa.array(np.zeros(len(parts), bool))
        several = pc.invert(one)
        cut = pa.array(map(self.pieces, parts.filter(several).to_pylist()), pa.large_list(pa.large_string()))
        whole = pa.LargeListArray.from_arrays(pa.array(np.arange(len(parts) + 1)), parts)
        pieces = put(whole, several, cut)
        coded = pieces.flatten().dictionary_encode()
        return _spread(*self._merged(coded.dictionary), coded.indices, np.asarray(pieces.offsets) - pieces.offsets[0].as_py())

    def _merged(self, words: pa.Array) -> Ids:
        """Ids of different pre-tokens by the model's merges; the letters of its tokens tell where a pre-token's ids end."""
        letters, sizes = _in_byte_letters(words)
        edges = pa.array(np.append(np.arange(0, len(letters), _JOINED), len(letters)))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(edges, letters), pa.scalar(_JOINT, letters.type))
        ids = [np.zeros(0, self.kind)]
        for at in range(0, len(joined), _WORDS_AT_ONCE // _JOINED):
            some = joined.slice(at, _WORDS_AT_ONCE // _JOINED).to_pylist()
            encoded = self.bare.encode_batch_fast([some], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(encoded[0].ids, self.kind))
        every = np.concatenate(ids)
        every = every[every != self.joint]
        ends = np.searchsorted(np.cumsum(self.sizes[every]), np.cumsum(sizes), "right")
        return every, np.diff(ends, prepend=0)

    def _asked(self, words: list[str]) -> Ids:
        ids, counts = [], []
        for at in range(0, len(words), _WORDS_AT_ONCE):
            some = words[at : at + _WORDS_AT_ONCE]
            encoded = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(encoded.ids, self.kind))
            counts.append(np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(some)))
        return np.concatenate(ids), np.concatenate(counts)


def _spread(ids: np.ndarray, counts: np.ndarray, taken: pa.Array, edges: np.ndarray) -> Ids:
    """Ids of runs of the rows ``taken``, where row i of ``counts`` has that many ids."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), pa.array(ids)).take(taken)
    return lists.flatten().to_numpy(), np.diff(np.asarray(lists.offsets)[edges])


def _is_plain(tokenizer: Tokenizer) -> bool:
    """Whether the ids of a text without added tokens are those of its pre-tokens, merged one by one or with joints between them."""
    level, model = tokenizer.pre_tokenizer, tokenizer.model
    return (
        tokenizer.normalizer is None and isinstance(model, models.BPE) and model.dropout is None
        and not model.ignore_merges and not model.continuing_subword_prefix and not model.end_of_word_suffix
        and isinstance(level, pre_tokenizers.ByteLevel) and not level.add_prefix_space and level.use_regex
        and all(token.special for token in tokenizer.get_added_tokens_decoder().values())
        and all(model.token_to_id(letter) is not None for letter in _BYTE_LETTERS)
        and not any(_JOINT in token for token in tokenizer.get_vocab(with_added_tokens=False) if token != _JOINT)
    )


@lru_cache(maxsize=2)
def encoder(model: str, pattern: str, plain: bool = False) -> Encoder:
    """One per Python worker, kept from task to task."""
    return Encoder(model, pattern, plain)


def as_binary(ids: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Rows of ids as binaries; ``begin`` says where each begins, and where the last ends."""
    width = ids.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin * width), pa.py_buffer(ids)]).cast(pa.binary())


def flat(rows: pa.Array, kind: str) -> np.ndarray:
    """All ids of some rows of ``as_binary``, one row after the other."""
    rows = rows.cast(pa.large_binary())
    if not len(rows):
        return np.zeros(0, kind)
    ends = _ends(rows)
    return np.frombuffer(rows.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind)
