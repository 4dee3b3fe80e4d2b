"""Alignment of two tokenizers over the same bytes: groups between common token ends, links between overlapping tokens.

Arrow-native pipeline, a block of documents at a time. Both models' ids become list columns; flattening gives the tokens,
parent indices their documents, and segmented cumulative sums of token sizes their ends in the document. A hash join on
(document, end) pairs the ends that both have: these close a group. A full join of the same tables gives all ends of either
side; between two of them lies one overlap of one token of each side, that is one link. ``Table.group_by`` counts the id pairs
of a block, Spark adds the counts up over all blocks, and each block gets back the counts of its own pairs only.

Blocks hold about ``block_bytes`` of text, a longer text alone, so no step holds more than that, and a pair that all texts
share is one row per block.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.chunks import ByChunk, Ids
from refinery.llm.encoder import Encoder
from refinery.llm.tables import stored

_BLOCK_BYTES = 1 << 21
_BLOCK_TEXTS = 4096
_BLOCK_BITS = 33  # bits of a block's number within its task; the task stands above
_TOGETHER = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
SPACE = "▁"  # fixed value: how a piece writes a space
_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_STORED = f"block bigint, docs array<struct<{_DOC}>>, links binary, code int, a int, b int, n bigint"
_DOC_ARROW = pa.struct([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()),
])
_STORED_ARROW = pa.schema([
    ("block", pa.int64()), ("docs", pa.list_(_DOC_ARROW)), ("links", pa.binary()), ("code", pa.int32()), ("a", pa.int32()),
    ("b", pa.int32()), ("n", pa.int64()),
])
_RESULT = f"{_DOC}, n_best bigint, count_sum bigint"
_RESULT_ARROW = pa.schema([*_DOC_ARROW, ("n_best", pa.int64()), ("count_sum", pa.int64())])


def byte_of_character() -> dict[str, int]:
    """The bytes that characters of a byte-level vocabulary stand for: printable ones for themselves, the others for 256 and up."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + place): byte for place, byte in enumerate(hidden)}


class Side:
    """One model: ids of a run of texts (list<int>), and the bytes of each id."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode = encode
        self.tokens = pa.array(tokens, pa.large_binary())
        self.sizes = pa.array([len(token) for token in tokens], pa.int64())


def _byte_level(model: str, pattern: str) -> Side:
    shared = Encoder(model, pattern, plain=True)
    of = byte_of_character()
    names = [shared.tokenizer.id_to_token(i) for i in range(shared.tokenizer.get_vocab_size())]
    tokens = [bytes(map(of.__getitem__, name)) if all(c in of for c in name) else name.encode() for name in names]
    return Side(shared.lists, tokens)


class _Pieces:
    """A piece model that puts a space before each text. Texts are given with that space here."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.tokens = [bytes([int(name[3:-1], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
        self.space = self.model.piece_to_id(SPACE)
        # Where no piece holds a space after another character, or a line break, no token crosses the edge of a chunk, as long
        # as spaces that follow each other stay together. Else texts go to the model whole.
        apart = names[self.space] == SPACE and not any(SPACE in name.lstrip(SPACE) or "\n" in name for name in names)
        pieces = _TOGETHER.findall if apart else lambda text: [text]
        self.by_chunk = ByChunk(self._learn, (lambda texts: pc.match_substring(texts, "  ")) if apart else (lambda texts: pc.greater(pc.binary_length(texts), 0)), pieces, pa.int32())

    def _learn(self, chunks: pa.Array) -> Ids:
        """The model puts a space before each chunk: one that has it already goes without, from others it is taken off."""
        new = chunks.to_pylist()
        found = self.model.encode([chunk[1:] if chunk[:1] == " " else chunk for chunk in new], num_threads=1)
        own = [[self.space] if chunk == " " else ids if chunk[:1] == " " else ids[1:] for chunk, ids in zip(new, found, strict=True)]
        return np.fromiter(chain.from_iterable(own), np.int32), np.array(list(map(len, own)), np.int64)


def _piece_level(model: bytes) -> Side:
    pieces = _Pieces(model)
    return Side(pieces.by_chunk.encode, pieces.tokens)


@lru_cache(maxsize=1)
def _sides(byte_model: str, pattern: str, piece_model: bytes) -> tuple[Side, Side]:
    os.environ["OMP_NUM_THREADS"] = "1"
    pa.set_cpu_count(1)  # Spark already runs a task per core
    return _byte_level(byte_model, pattern), _piece_level(piece_model)


def _only(ids: pa.LargeListArray, good: np.ndarray) -> pa.LargeListArray:
    """The lists with those emptied that are not good; numbers as int."""
    counts = pc.list_value_length(ids).to_numpy()
    flat = ids.flatten().cast(pa.int32())
    if not good.all():
        flat = flat.filter(pa.array(np.repeat(good, counts)))
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts * good)])), flat)


def _ends(ids: pa.LargeListArray, side: Side) -> pa.Table:
    """``doc`` (place in the block) and ``end`` (in the document's bytes) of each token, its id and its place."""
    flat, parents = pc.list_flatten(ids), pc.list_parent_indices(ids)
    running = pc.cumulative_sum(side.sizes.take(flat)).to_numpy() if len(flat) else np.zeros(0, np.int64)
    before = np.concatenate([[0], running])[np.asarray(ids.offsets)[:-1]]
    ends = running - before[parents.to_numpy()]
    return pa.table({"doc": parents, "end": pa.array(ends), "id": flat, "at": pa.array(np.arange(len(flat)))})


def _joined_bytes(ids: pa.LargeListArray, side: Side) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and where each document's begin."""
    flat = pc.list_flatten(ids)
    found = side.tokens.take(flat)
    running = np.concatenate([[0], np.cumsum(side.sizes.take(flat).to_numpy())]) if len(flat) else np.zeros(1, np.int64)
    data = found.buffers()[2]
    return np.frombuffer(data, np.uint8)[: running[-1]] if data is not None else np.zeros(0, np.uint8), running[np.asarray(ids.offsets)]


def _true_ones(texts: list[bytes], ids: pa.LargeListArray, side: Side) -> np.ndarray:
    """Whether the tokens of each document give its bytes."""
    data, begin = _joined_bytes(ids, side)
    sizes = np.array([len(text) for text in texts], np.int64)
    if np.array_equal(np.diff(begin), sizes) and data.tobytes() == b"".join(texts):
        return np.ones(len(texts), bool)
    return np.array([data[a:b].tobytes() == text for text, a, b in zip(texts, begin.tolist(), begin[1:].tolist())])  # noqa: B905


class Block:
    """Tokens, groups and links of the documents of a block; those without tokens have empty lists."""

    def __init__(self, texts: list[str | None], a: Side, b: Side):
        spaced = [" " + text if text else "" for text in texts]
        raw = [text.encode() for text in spaced]
        found = [side.encode(pa.array(spaced, pa.large_string())) for side in (a, b)]
        good = np.logical_and.reduce([_true_ones(raw, ids, side) for ids, side in zip(found, (a, b), strict=True)])
        self.lists = [_only(ids, good) for ids in found]
        self.tables = [_ends(ids, side) for ids, side in zip(self.lists, (a, b), strict=True)]
        self.n = len(texts)

    def counts(self, of: int) -> np.ndarray:
        return pc.list_value_length(self.lists[of]).to_numpy()

    def common(self) -> pa.Table:
        """Ends that both sides have, in order: the places of their tokens."""
        left, right = (table.select(["doc", "end", "at"]) for table in self.tables)
        met = left.join(right, ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
        return met.sort_by("at")

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, id of A and id of B of each link, in order."""
        left, right = self.tables
        either = left.rename_columns({"id": "id_a", "at": "at_a"}).join(
            right.rename_columns({"id": "id_b", "at": "at_b"}), ["doc", "end"], join_type="full outer", use_threads=False
        )
        # An end that only one side has lies in that token of the other side which ends next.
        place = either.column("doc").to_numpy().astype(np.int64) << 40 | either.column("end").to_numpy()
        either = either.take(pa.array(np.argsort(place)))
        filled = [pc.fill_null_backward(either.column(name).combine_chunks()) for name in ("id_a", "id_b")]
        return either.column("doc").to_numpy(), *(column.to_numpy() for column in filled)

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """Number of groups of each document, and the checksum of their ids as text."""
        met = self.common()
        last_a, last_b = met.column("at").to_numpy(), met.column("at_b").to_numpy()
        n_groups = np.bincount(self.tables[0].column("doc").to_numpy()[last_a], minlength=self.n)
        n_a, n_b = (len(table) for table in self.tables)
        # Written in order: the A ids of a group, then its B ids. A token moves by the other side's tokens before its group.
        ends_a, ends_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        ends_a[last_a], ends_b[last_b] = True, True
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        before_b = np.concatenate([[0], last_b + 1])
        place_a = np.arange(n_a) + before_b[group_a]
        place_b = np.arange(n_b) + (last_a + 1)[group_b]
        written = np.zeros(n_a + n_b, np.int64)
        written[place_a] = 3 * self.tables[0].column("id").to_numpy() + ends_a
        written[place_b] = 3 * self.tables[1].column("id").to_numpy() + 2 * ends_b
        text = _decimals(int(written.max()) // 3 + 1 if len(written) else 1).take(pa.array(written))
        size = np.asarray(pc.binary_length(text))
        begin = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *(self.counts(0) + self.counts(1))])]
        data = text.buffers()[2].to_pybytes() if len(written) else b""
        sums = [hashlib.sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(begin.tolist(), begin[1:].tolist())]  # noqa: B905
        return n_groups, sums


@lru_cache(maxsize=2)
def _decimals_up_to(ids: int) -> pa.Array:
    return pa.array([f"{i}{mark}" for i in range(ids) for mark in ",|;"], pa.large_string())


def _decimals(ids: int) -> pa.Array:
    """Each id in decimal, followed by a comma, a bar or a semicolon."""
    return _decimals_up_to(1 << (ids - 1).bit_length())


def _aligned(doc_ids: list, texts: list, block: int, a: Side, b: Side) -> Iterator[pa.RecordBatch]:
    """One row with the block's documents and links, and one per id pair of the block with its count."""
    found = Block(texts, a, b)
    n_groups, sums = found.groups()
    doc, id_a, id_b = found.links()
    pairs = pa.table({"pair": pa.array(id_a.astype(np.int64) << 32 | id_b)})
    counts = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by([("count_all", "descending"), ("pair", "ascending")])
    known, n = counts.column("pair").combine_chunks(), counts.column("count_all")
    codes = pc.index_in(pairs.column("pair"), value_set=known).to_numpy().astype("<u4")
    docs = pa.StructArray.from_arrays([
        pa.array(doc_ids, pa.int64()), pa.array(found.counts(0), pa.int64()), pa.array(found.counts(1), pa.int64()),
        pa.array(n_groups, pa.int64()), pa.array(np.bincount(doc, minlength=found.n), pa.int64()), pa.array(sums, pa.string()),
    ], fields=list(_DOC_ARROW))
    # Bytes of equal weight side by side: the upper ones are mostly zero and hardly take room.
    links = codes.view(np.uint8).reshape(-1, 4).T.tobytes()
    size = len(known)
    yield pa.RecordBatch.from_arrays([
        pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
        pa.array([len(links).to_bytes(8, "little") + pa.compress(links, "zstd", asbytes=True)], pa.binary()), *(pa.nulls(1, f.type) for f in list(_STORED_ARROW)[3:]),
    ], schema=_STORED_ARROW)
    if size:
        pair = known.to_numpy()
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(size, block)), *(pa.nulls(size, f.type) for f in list(_STORED_ARROW)[1:3]), pa.array(np.arange(size, dtype=np.int32)),
            pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)), n.combine_chunks(),
        ], schema=_STORED_ARROW)


def aligned(docs: DataFrame, byte_model: str, pattern: str, piece_model: bytes, block_bytes: int = _BLOCK_BYTES) -> DataFrame:
    """Per document: tokens of both models, groups, links, and how usual its links are in the whole corpus.

    ``byte_model`` and ``piece_model`` are the contents of a byte-level tokenizers file (A) and of a piece model (B) that puts a
    space before a text; A reads the text with that space. Strings of special tokens are text. A token's bytes are its entry's;
    where both models end a token a group ends. Tokens whose bytes overlap are linked, each occurrence by itself. ``n_best``
    counts the links whose id pair is the most frequent of all pairs with that B id (ties all count), ``count_sum`` adds up
    the corpus-wide counts of the links' pairs. ``groups_sha256`` is over ``a1,a2|b1;a3|b2`` in decimal.

    A text that is NULL or empty, or whose tokens don't give its bytes, has zeros and ``''``. Repeated rows count again and each
    gives a row; no documents give no rows; columns other than ``doc_id`` and ``text`` are left out.
    """

    def blocks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(byte_model, pattern, piece_model)
        number = TaskContext.get().partitionId() << _BLOCK_BITS
        doc_ids: list = []
        texts: list = []
        size = 0
        for batch in found:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                more = len(text or "")
                if texts and (size + more > block_bytes or len(texts) >= _BLOCK_TEXTS):
                    yield from _aligned(doc_ids, texts, number, a, b)
                    doc_ids, texts, size, number = [], [], 0, number + 1
                doc_ids.append(doc_id)
                texts.append(text)
                size += more
        if texts:
            yield from _aligned(doc_ids, texts, number, a, b)

    rows = stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(blocks, _STORED), "alignment")
    pairs = rows.filter(F.col("code").isNotNull()).select("block", "code", "a", "b", "n")
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "pair_counts")
    # At most one row per entry of B's vocabulary.
    best = counts.groupBy(F.col("b").alias("of_b")).agg(F.max("total").alias("most"))
    usual = counts.join(F.broadcast(best), F.col("b") == F.col("of_b")).select(
        F.col("a").alias("of_a"), "of_b", "total", (F.col("total") == F.col("most")).alias("is_best")
    )
    known = pairs.join(usual, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b"))).select(
        F.col("block").alias("of_block"), "code", "total", "is_best"
    )
    of_docs = rows.filter(F.col("docs").isNotNull()).select("block", "docs", "links")
    return of_docs.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_scored, _RESULT)


def _scored(docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links."""
    total, best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
    code = known.column("code").to_numpy()
    total[code], best[code] = known.column("total").to_numpy(), known.column("is_best").to_numpy().astype(np.int64)
    found = []
    for row, links in zip(docs.column("docs").combine_chunks(), docs.column("links").to_pylist(), strict=True):
        fields = dict(zip(_DOC_ARROW, row.values.flatten(), strict=True)).values()
        raw = pa.decompress(links[8:], int.from_bytes(links[:8], "little"), "zstd", asbytes=True)
        codes = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()
        arrays = list(fields)
        edges = np.cumsum([0, *arrays[4].to_numpy().tolist()])
        sums = [np.concatenate([[0], np.cumsum(values[codes])]) for values in (best, total)]
        arrays += [pa.array(np.diff(s[edges])) for s in sums]
        found.append(pa.RecordBatch.from_arrays(arrays, schema=_RESULT_ARROW))
    return pa.Table.from_batches(found, _RESULT_ARROW)
