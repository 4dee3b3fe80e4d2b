"""BPE and token files against the libraries they have to agree with."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401
from tokenizers import Tokenizer

from refinery.llm import bpe, queries, rans, token_files
from refinery.llm.encoder import flat
from refinery.operators.storage import new_folder

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
VOCABULARY = bpe._vocabulary(RANKS, public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())},
)
with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    MODEL = file.read()
LIBRARY = Tokenizer.from_str(MODEL)


def test_the_hash_is_minimal_and_perfect():
    hashed = VOCABULARY.whole
    assert sorted(hashed.index(token) for token in VOCABULARY.tokens) == list(range(len(VOCABULARY.tokens)))
    assert all(VOCABULARY.tokens[hashed.index(token)] == token for token in VOCABULARY.tokens[::97])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_are_those_of_the_library(text):
    ids = VOCABULARY.encode(pa.array([text, text + text], pa.large_string()))
    assert ids[0].as_py() == TIKTOKEN.encode_ordinary(text) and ids[1].as_py() == TIKTOKEN.encode_ordinary(text + text)
    assert bpe._joined(ids, *bpe._tokens(RANKS)).to_pylist() == [text.encode(), (text + text).encode()]


def test_lists_without_ids_and_unknown_ids():
    lists = pa.array([None, [], [5, 6]], pa.list_(pa.int32()))
    assert bpe._joined(lists, *bpe._tokens(RANKS)).to_pylist() == [b"", b"", TIKTOKEN.decode_bytes([5, 6])]
    with pytest.raises((ValueError, IndexError)):
        bpe._joined(pa.array([[10**6]], pa.list_(pa.int32())), *bpe._tokens(RANKS))


def test_a_long_piece_is_merged_in_reasonable_time():
    piece = prose(1, 30_000).replace(" ", "")
    assert VOCABULARY.merge(piece.encode()) == TIKTOKEN.encode_ordinary(piece)


def test_columns_of_odd_texts(spark):
    docs = documents(spark, ODD)
    coded = docs.withColumn("ids", bpe.encode(F.col("text"), RANKS)).withColumn("back", bpe.decode(F.col("ids"), RANKS))
    for row in coded.collect():
        assert row.ids == TIKTOKEN.encode_ordinary(row.text or "") and bytes(row.back) == (row.text or "").encode()
        assert row.rank == "x"
    assert docs.limit(0).select(bpe.encode(F.col("text"), RANKS)).collect() == []


def test_the_bpe_query(spark, sf_dir, given_documents):
    found = {row.doc_id: row for row in queries.op5_byte_bpe(spark, sf_dir).collect()}
    assert len(found) == given_documents.count()
    for row in given_documents.collect():
        ids = TIKTOKEN.encode_ordinary(row.text or "")
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(1, 40), st.integers(1, 5))
def test_a_block_comes_back(ids, lanes, every):
    symbols, counts = np.unique(np.array([*ids, 7, 70_000], np.uint32), return_counts=True)
    table = rans.Table.from_bytes(rans.Table(symbols, counts).to_bytes())
    block = rans.encode(np.array(ids, np.uint32), table, lanes, every)
    assert rans.decode(block, table).tolist() == ids
    width = max(1, min(lanes, len(ids)))
    for checkpoint in range(1, -(-max(1, -(-len(ids) // width)) // every)):
        assert rans.decode(block, table, checkpoint).tolist() == ids[checkpoint * every * width :]


def test_steps_of_a_block_are_few():
    """A step costs the same calls however many lanes it has; a block of the token files has 128 steps and a checkpoint half-way."""
    ids = np.random.default_rng(1).integers(0, 5000, 1 << 18).astype(np.uint32)
    table = rans.Table(*np.unique(ids, return_counts=True))
    block = rans.encode(ids, table)
    _, n, lanes, every, checkpoints, *_ = rans._HEADER.unpack_from(block)
    assert -(-n // lanes) == 128 and checkpoints == 1
    assert np.array_equal(rans.decode(block, table), ids) and np.array_equal(rans.decode(block, table, 1), ids[lanes * every :])


def test_a_table_with_many_rare_symbols_and_damage():
    table = rans.Table(np.arange(60_000), np.array([10**12, *[1] * 59_999]))
    assert table.frequency.sum() == 1 << 20 and table.frequency.min() >= 1
    block = bytearray(rans.encode(np.arange(0, 60_000, 3, dtype=np.uint32), table))
    block[-5] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(bytes(block), table)


def expected_files(docs):
    rows = sorted(docs, key=lambda row: (row.doc_id is not None, row.doc_id or 0))
    start, found = 0, []
    for row in rows:
        ids = [*LIBRARY.encode(row.text or "", add_special_tokens=False).ids, 2]
        found.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return found


def test_files_of_odd_texts(spark):
    rows = [*ODD, (8, "a <|endoftext|> in the text", "en", "a"), *[(100 + i, prose(i, i), "en", "c") for i in range(40)]]
    docs = documents(spark, rows).repartition(5)
    path = new_folder(spark, "tokens")
    token_files.write(docs, path, MODEL, public_tokenizers.PATTERN, 2, group_ids=500, block_ids=300)
    found = token_files.read(spark, path)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected_files(docs.collect())


def test_files_of_no_documents(spark):
    path = new_folder(spark, "tokens")
    token_files.write(documents(spark, []), path, MODEL, public_tokenizers.PATTERN, 2)
    assert token_files.read(spark, path).collect() == []


def test_the_token_file_query(spark, sf_dir, given_documents):
    found = queries.op1_rans_token_files(spark, sf_dir).orderBy("start").collect()
    assert [tuple(row) for row in found] == [row[:4] for row in expected_files(given_documents.collect())]


def test_ids_are_found_by_a_list():
    """Places in the table by one look each; a table of vast numbers is searched. An id that is not there is an error in both."""
    for symbols in ([2, 5, 9], [2, 5, 1 << 30]):
        table = rans.Table(symbols, [3, 1, 2])
        assert (table.at is None) == (symbols[-1] > 9)
        ids = np.array([5, 2, symbols[-1], 5], np.uint32)
        assert table.index(ids).tolist() == [1, 0, 2, 1]
        assert rans.decode(rans.encode(ids, table), table).tolist() == ids.tolist()
        for wrong in (3, symbols[-1] + 1):
            with pytest.raises(ValueError, match="not in the table"):
                rans.encode(np.array([2, wrong], np.uint32), table)


def test_ids_of_all_rows_at_once():
    rows = pa.array([b"\x01\x00\x02\x00", b"", b"\x03\x00"], pa.binary())
    assert flat(rows, "<u2").tolist() == [1, 2, 3]
    assert flat(rows.slice(1), "<u2").tolist() == [3]
    assert flat(rows.slice(3), "<u2").tolist() == flat(rows.slice(1, 1), "<u2").tolist() == []
