"""Exact top-k by inner product over a vector-approximation file.

The file holds a byte per component, one of 256 cells of equal width. Vectors of one length share their cells, so one product
of a query with the cells bounds a vector's score from above and below, and the two are equally far apart for all of a
query's candidates.

First pass: cells of a block of candidates meet a block of queries, and what could be among a query's best of the block
is kept with its bounds. Then, over all blocks, a query's candidates are read exactly in the order of their upper bounds:
the first k, and after them only those whose upper bound reaches the k-th score found. No other exact vector is moved.

Of equal vectors only the k + 1 with the smallest ids are candidates: the others can't be among any query's k best, as
ties go to the smaller id. So one very common vector costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.tables import stored

CELLS = 256
SCALE = 64
CANDIDATES_PER_BLOCK, QUERIES_PER_BLOCK = 65_536, 2048
_QUERIES_AT_ONCE = 64
_LEAST_BYTE = 128  # cell 0 is stored as -128
_EXACT = float(1 << 53)  # doubles below hold every whole number
_EXACT_SINGLE = float(1 << 24)
_LONG = (1 << 63) - 1
_ROW, _QUERY = ["vec_id", "k1", "k2"], ["query_id", "q1", "q2"]
_BOUNDED = "query_id bigint, q1 bigint, q2 bigint, vec_id bigint, k1 bigint, k2 bigint, low double, high double"
_SCORED = "query_id bigint, q1 bigint, q2 bigint, vec_id bigint, k1 bigint, k2 bigint, score bigint"


def _whole(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``x`` (whole numbers as doubles), ``dim`` and a key of ``x``: each different row that takes part, once."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    # Doubles from 2^53 on are whole numbers.
    floors = F.transform(scaled, lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x))
    finite = F.forall("x", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), floors.alias("x")).filter(F.col("vec_id").isNotNull() & finite)
    keyed = rows.select("*", F.size("x").alias("dim"), F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2"))
    return keyed.dropDuplicates(["vec_id", "x"])


def _grids(whole: DataFrame, cells: int) -> DataFrame:
    """Per length of vectors: the ``least`` component and the ``width`` of a cell."""
    least, most = F.coalesce(F.min(F.array_min("x")), F.lit(0.0)), F.coalesce(F.max(F.array_max("x")), F.lit(0.0))
    found = whole.groupBy(F.col("dim").alias("of_dim")).agg(least.alias("least"), most.alias("most"))
    wide = (F.col("most") - F.col("least") + 1) / cells
    return found.select("of_dim", "least", "most", F.greatest(F.lit(1.0), F.when(wide < _EXACT, F.ceil(wide).cast("double")).otherwise(wide)).alias("width"))


def _cells(cells: int) -> Column:
    """Cells of ``x``, from -128 on, each in a byte."""
    cell = lambda x: F.floor(F.least(F.greatest((x - F.col("least")) / F.col("width"), F.lit(0.0)), F.lit(cells - 1.0)))
    return F.transform("x", lambda x: (cell(x) - _LEAST_BYTE).cast("tinyint"))


def bounds(queries: np.ndarray, cells: np.ndarray, least: float, most: float, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that each row of cells can have for each query; scores stop at the ends of a long."""
    most_cell = float(CELLS - 1)
    largest = max(abs(least), abs(most) + width)
    with np.errstate(all="ignore"):
        single = np.abs(queries).max(initial=0) * most_cell * max(1, queries.shape[1]) < _EXACT_SINGLE
        kind = np.float32 if single else np.float64
        product = (queries.astype(kind) @ (cells.astype(kind) + kind(_LEAST_BYTE)).T).astype(np.float64)
        base = product * width + (least * queries.sum(axis=1))[:, None]
        low = base + (np.minimum(queries, 0).sum(axis=1) * (width - 1))[:, None]
        high = base + (np.maximum(queries, 0).sum(axis=1) * (width - 1))[:, None]
        in_all = np.abs(queries).sum(axis=1) * largest * 4
        # Where doubles round, bounds are moved apart by more than any rounding.
        slack = np.where(in_all < _EXACT, 0.0, in_all * (queries.shape[1] + 8) * 2.0**-50)[:, None]
        low, high = low - slack, high + slack
        unknown = ~(np.isfinite(low) & np.isfinite(high))
        low[unknown], high[unknown] = -np.inf, np.inf
    return np.clip(low, -float(1 << 63), float(1 << 63)), np.clip(high, -float(1 << 63), float(1 << 63))


def _scan(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """First pass over a block: for each query the candidates that can be among its k best of the block."""
    found = []
    if len(queries) and len(candidates):
        wanted, cells = np.stack(queries["x"].to_numpy()), np.stack(candidates["cells"].to_numpy())
        ids, k1, k2 = (candidates[name].to_numpy() for name in _ROW)
        asking = {name: queries[name].to_numpy() for name in ("vec_id", "k1", "k2")}
        least, most, width = (float(queries[name].iloc[0]) for name in ("least", "most", "width"))
        for at in range(0, len(wanted), _QUERIES_AT_ONCE):
            lowest, highest = bounds(wanted[at : at + _QUERIES_AT_ONCE], cells, least, most, width)
            for row, (low, high) in enumerate(zip(lowest, highest, strict=True)):
                other = ids != asking["vec_id"][at + row]
                low[~other] = -np.inf
                border = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
                left = np.flatnonzero((high >= border) & other)
                found.append(pd.DataFrame({
                    "query_id": asking["vec_id"][at + row], "q1": asking["k1"][at + row], "q2": asking["k2"][at + row],
                    "vec_id": ids[left], "k1": k1[left], "k2": k2[left], "low": low[left], "high": high[left],
                }))
    return pd.concat(found) if found else pd.DataFrame(columns=[*_QUERY, *_ROW, "low", "high"])


def bounded(whole: DataFrame, is_query: Column, k: int, cells: int = CELLS) -> DataFrame:
    """The first pass: pairs of a query and a candidate with the bounds of their score; no pair of a k best is missing.

    ``rank`` is a candidate's place among its query's by upper bound. Those below the k-th lower bound are out.
    """
    grids = stored(_grids(whole, cells), "grids")  # a row for each length of vectors
    first = F.row_number().over(Window.partitionBy("dim", "k1", "k2").orderBy("vec_id"))
    rows = whole.select("vec_id", "x", "dim", "k1", "k2")
    distinct = rows.withColumn("nth", first).filter(F.col("nth") <= k + 1)
    candidates = stored(distinct.join(grids, F.col("dim") == F.col("of_dim")).select("dim", *_ROW, _cells(cells).alias("cells")), "cells")
    queries = rows.filter(is_query).join(grids, F.col("dim") == F.col("of_dim"))
    candidate_blocks = max(1, -(-candidates.count() // CANDIDATES_PER_BLOCK))
    query_blocks = max(1, -(-rows.filter(is_query).count() // QUERIES_PER_BLOCK))
    own = {"candidate": F.pmod(F.xxhash64("vec_id"), F.lit(candidate_blocks)), "query": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks))}

    def dealt(rows: DataFrame, to: str, other: str, others: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint")))
        return rows.withColumn(f"{to}_block", own[to]).withColumn(f"{other}_block", every)

    blocks = ["dim", "query_block", "candidate_block"]
    asking = dealt(queries, "query", "candidate", candidate_blocks).groupBy(*blocks)
    asked_of = dealt(candidates, "candidate", "query", query_blocks).groupBy(*blocks)
    pairs = asking.cogroup(asked_of).applyInPandas(lambda left, right: _scan(left, right, k), _BOUNDED)
    of_query = Window.partitionBy(*_QUERY)
    ranked = pairs.withColumn("rank", F.row_number().over(of_query.orderBy(F.desc("high"), *_ROW)))
    # Bounds of a query's candidates are equally far apart, so the k-th lower bound belongs to the k-th upper one.
    border = F.min(F.when(F.col("rank") <= k, F.col("low"))).over(of_query)
    return ranked.withColumn("border", border).filter((F.col("rank") <= k) | (F.col("high") >= F.col("border"))).drop("border")


def _products(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact, cut to a long."""
    a, b = (side.flatten().to_numpy(zero_copy_only=False) for side in (left, right))
    lengths = left.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    if not np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, lengths.max(initial=0)) < _EXACT:
        sums = [sum(int(x) * int(y) for x, y in zip(a[end - n : end], b[end - n : end], strict=True)) for end, n in zip(ends, lengths, strict=True)]
        return np.array([max(-_LONG - 1, min(_LONG, total)) for total in sums], np.int64)
    scores = np.zeros(len(lengths))
    some = lengths > 0
    if some.any():
        scores[some] = np.add.reduceat(a * b, (ends - lengths)[some])
    return scores.astype(np.int64)


def read(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The exact ``score`` of pairs of a query and a candidate; only the vectors of these pairs are moved."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            score = _products(batch.column("asked"), batch.column("x"))
            names = [*_QUERY, *_ROW]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(score, pa.int64())], names=[*names, "score"])

    exact = whole.select(*_ROW, "x")
    asked = whole.select(*[F.col(name).alias(to) for name, to in zip(_ROW, _QUERY, strict=True)], F.col("x").alias("asked"))
    both = pairs.select(*_QUERY, *_ROW).join(asked, _QUERY).join(exact, _ROW)
    return both.select(*_QUERY, *_ROW, "asked", "x").mapInArrow(batches, _SCORED)


def top_k(vectors: DataFrame, is_query: Column, k: int, cells: int = CELLS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's k best; ties go to the smaller ``vec_id``.

    ``is_query`` may look at ``vec_id``; ``cells`` per component are 256 at most. Components are floor(64 x). Rows that share a query's ``vec_id`` are its own and
    no candidates; equal rows count once, and rows of one ``vec_id`` with different vectors are queries and candidates each.
    Vectors that are NULL or hold NULL or non-finite components, and rows without an id, take no part; vectors
    only meet those of their own length. Scores beyond a long stop at its ends. Other columns are ignored; an empty table gives an empty result.
    """
    whole = stored(_whole(vectors), "vectors")
    pairs = stored(bounded(whole, is_query, k, cells), "bounds")
    first = stored(read(pairs.filter(F.col("rank") <= k), whole), "first")
    certain = first.groupBy(*_QUERY).agg(F.min("score").alias("certain"))
    reaching = pairs.filter(F.col("rank") > k).join(certain, _QUERY).filter(F.col("high") >= F.col("certain"))
    found = first.unionByName(read(reaching, whole))
    rank = F.row_number().over(Window.partitionBy(*_QUERY).orderBy(F.desc("score"), *_ROW))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
