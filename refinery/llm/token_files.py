"""Token files: the ids of all documents in one order, in independently decodable blocks.

A file set is a folder with ``frequencies`` (one table shared by all blocks) and ``groups``. A row of ``groups``
holds whole documents in a binary ``payload``: a header, the index of its documents (id, number of ids) and one or
more blocks of ``rans``. ``part`` and ``first`` give the place of its first id: ids before it in its part; the
reader adds up the parts. Spark's writer commits the rows, so a lost executor leaves no half-written file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refinery.llm import rans
from refinery.llm.encoder import as_binary, encoder, flat

_INDEX = struct.Struct("<4sII")
_MAGIC = b"TKG1"
_GROUPS = "part int, group int, first bigint, n_ids bigint, payload binary"


def tokenize(docs: DataFrame, model: str, pattern: str, end_id: int) -> DataFrame:
    """``doc_id`` and ``ids`` of each document, the end id included: little-endian numbers, 2 bytes if all ids fit."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = encoder(model, pattern)
        for batch in found:
            for a, b, ids, begin in shared.ended(batch.column("text"), end_id):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), as_binary(ids, begin)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(batches, "doc_id bigint, ids binary")


def _counts(tokens: DataFrame, kind: str) -> DataFrame:
    """How often each id occurs; a task sends one row per id at most."""

    def partial(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in found:
            # All rows at once: a count of each has as many places as the vocabulary.
            seen = np.bincount(flat(batch.column("ids"), kind))
            if len(seen) > len(total):
                seen[: len(total)] += total
                total = seen
            else:
                total[: len(seen)] += seen
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(total[ids])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(partial, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write(
    docs: DataFrame,
    path: str,
    model: str,
    pattern: str,
    end_id: int,
    group_ids: int = 1 << 18,
    block_ids: int = 1 << 18,
) -> None:
    """Writes the ids of all documents (``doc_id``, ``text``; other columns are ignored) in ascending ``doc_id`` order.

    ``model`` is the content of a tokenizers file, ``pattern`` cuts texts where that model does. A NULL or empty
    text is the end id alone. NULL ids come first; documents with equal ids follow each other in the order of a
    hash of their ids, so copies are interchangeable. A group is closed by the document that brings it to
    ``group_ids``; a document beyond ``block_ids`` is cut into several blocks of its group. No table may be empty
    of columns, but an empty one gives an empty file set.
    """
    spark = docs.sparkSession
    kind = encoder(model, pattern).kind
    tokenize(docs, model, pattern, end_id).write.parquet(f"{path}/tokens")
    tokens = spark.read.parquet(f"{path}/tokens")
    # At most one row per entry of the vocabulary.
    counts = sorted(map(tuple, _counts(tokens, kind).collect()))
    table = rans.Table([i for i, _ in counts], [n for _, n in counts])
    frequencies = table.to_bytes()
    spark.createDataFrame([(bytearray(frequencies),)], "frequencies binary").coalesce(1).write.parquet(f"{path}/frequencies")

    def groups(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _table(frequencies)
        part = TaskContext.get().partitionId()
        index: list[tuple[int | None, int]] = []
        ids: list[np.ndarray] = []
        number = first = size = 0

        def close() -> pa.RecordBatch:
            payload = _pack(index, np.concatenate(ids), shared, block_ids)
            row = {"part": [part], "group": [number], "first": [first], "n_ids": [size], "payload": [payload]}
            return pa.RecordBatch.from_pydict(row, schema=_GROUPS_ARROW)

        for batch in found:
            for doc_id, row in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                values = np.frombuffer(row.as_buffer(), kind)
                index.append((doc_id, len(values)))
                ids.append(values)
                size += len(values)
                if size >= group_ids:
                    yield close()
                    number, first, size = number + 1, first + size, 0
                    index, ids = [], []
        if index:
            yield close()

    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    ordered = tokens.select("doc_id", "ids").repartitionByRange(spread, *order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(groups, _GROUPS).write.parquet(f"{path}/groups")


_GROUPS_ARROW = pa.schema([("part", pa.int32()), ("group", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])


@lru_cache(maxsize=2)
def _table(frequencies: bytes) -> rans.Table:
    return rans.Table.from_bytes(frequencies)


def _pack(index: list[tuple[int | None, int]], ids: np.ndarray, table: rans.Table, block_ids: int) -> bytes:
    known = np.array([doc_id is not None for doc_id, _ in index], np.uint8)
    doc_ids = np.array([doc_id or 0 for doc_id, _ in index], "<i8")
    sizes = np.array([n for _, n in index], "<u4")
    blocks = [rans.encode(ids[at : at + block_ids], table) for at in range(0, len(ids), block_ids)]
    body = known.tobytes() + doc_ids.tobytes() + sizes.tobytes()
    body += np.array([len(block) for block in blocks], "<u4").tobytes()
    return _INDEX.pack(_MAGIC, len(index), len(blocks)) + struct.pack("<I", zlib.crc32(body)) + body + b"".join(blocks)


def _unpack(payload: bytes, table: rans.Table) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, sizes and all ids of a group."""
    magic, n_docs, n_blocks = _INDEX.unpack_from(payload)
    at = _INDEX.size + 4
    end = at + 13 * n_docs + 4 * n_blocks
    if magic != _MAGIC or zlib.crc32(payload[at:end]) != struct.unpack_from("<I", payload, _INDEX.size)[0]:
        raise ValueError("a group's index does not match its checksum")
    known = np.frombuffer(payload, np.uint8, n_docs, at)
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at + n_docs)
    sizes = np.frombuffer(payload, "<u4", n_docs, at + 9 * n_docs)
    lengths = np.frombuffer(payload, "<u4", n_blocks, at + 13 * n_docs)
    found = []
    for length in lengths.tolist():
        found.append(rans.decode(payload[end : end + length], table))
        end += length
    named = [doc_id if is_known else None for doc_id, is_known in zip(doc_ids.tolist(), known.tolist(), strict=True)]
    return named, sizes, np.concatenate(found)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``.

    Every block is decoded and checked whether or not the ids are returned.
    """
    frequencies = bytes(spark.read.parquet(f"{path}/frequencies").first()[0])
    groups = spark.read.parquet(f"{path}/groups")
    # One row per part, that is per task of the writer.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = groups.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    placed = groups.join(parts, F.col("part") == F.col("of_part")).select((F.col("first") + F.col("earlier")).alias("first"), "payload")
    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def documents(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(frequencies)
        for batch in found:
            for first, payload in zip(batch.column("first").to_pylist(), batch.column("payload"), strict=True):
                doc_ids, sizes, ids = _unpack(payload.as_buffer().to_pybytes(), table)
                ends = np.cumsum(sizes.astype(np.int64))
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                out = [pa.array(doc_ids, pa.int64()), pa.array(first + ends - sizes), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return placed.mapInArrow(documents, columns)
