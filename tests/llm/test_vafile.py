"""Top-k against every score."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import vafile

SCHEMA = "vec_id bigint, embedding array<float>, rank string, score string"


def brute(rows, k):
    whole = {}
    for vec_id, values in rows:
        if vec_id is None or values is None or any(x is None or not math.isfinite(x) for x in values):
            continue
        whole[vec_id, tuple(math.floor(64 * x) for x in values)] = 1
    found = []
    for q, a in whole:
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b))
            found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def check(spark, rows, k=20, **more):
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    found = vafile.top_k(table, F.col("vec_id") % 20 == 0, k, **more)
    assert sorted(map(tuple, found.collect())) == brute(rows, k)


def single(x):
    return float(np.float32(x))


def vectors(n, d, seed, steps=64):
    draw = random.Random(seed)
    return [(i, [draw.randint(-steps, steps) / 64 for _ in range(d)]) for i in range(n)]


@pytest.mark.parametrize("n, d", [(300, 16), (15, 3), (1, 2), (0, 2)])
def test_every_score(spark, n, d):
    check(spark, vectors(n, d, n))


def test_ties_and_common_vectors(spark):
    check(spark, vectors(200, 2, 5, steps=2) + [(i, [0.5, 0.25]) for i in range(200, 400)])


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(vafile, "CANDIDATES_PER_BLOCK", 40)
    monkeypatch.setattr(vafile, "QUERIES_PER_BLOCK", 3)
    check(spark, vectors(200, 8, 6))


def test_odd_vectors(spark):
    odd = [(40, None), (60, [None, 1.0]), (80, [math.nan, 1.0]), (100, [math.inf, 1.0]), (None, [1.0, 1.0]), (120, []), (121, []), (140, [1.0]), (140, [1.0])]
    check(spark, vectors(30, 2, 7) + odd)


def test_coarse_cells(spark):
    """Components that span many cells, and few cells for them: bounds are apart and more vectors are read."""
    draw = random.Random(8)
    check(spark, [(i, [single(draw.uniform(-900, 900)) for _ in range(6)]) for i in range(300)], k=5)
    check(spark, [(i, [single(draw.gauss(0, 2e6)) for _ in range(3)]) for i in range(60)], k=5)
    check(spark, [(i, [single(draw.uniform(-9, 9)) for _ in range(4)]) for i in range(300)], k=5, cells=16)


def test_ids_with_several_vectors(spark):
    rows = vectors(120, 3, 9) + [(i % 45, row) for i, row in vectors(90, 3, 10)]
    check(spark, rows, k=7)


def test_bounds_hold_every_score():
    draw = np.random.default_rng(11)
    for size in (3, 300, 1e5, 1e9):
        rows = np.floor(draw.normal(0, size, (200, 12)))
        least, most = rows.min(), rows.max()
        width = max(1.0, math.ceil((most - least + 1) / vafile.CELLS))
        cells = np.clip((rows - least) // width, 0, vafile.CELLS - 1) - 128
        low, high = vafile.bounds(rows[:20], cells.astype(np.int8), least, most, width)
        exact = np.array([[max(-1 << 63, min(1 << 63, sum(int(x) * int(y) for x, y in zip(a, b, strict=True)))) for b in rows] for a in rows[:20]], dtype=object)
        assert (low <= exact).all() and (exact <= high).all()


def test_exact_vectors_are_read_for_few_pairs(spark, monkeypatch):
    """Of 400 x 20 pairs, and a vector that a third of the rows share, the exact vectors of a few are read."""
    monkeypatch.setattr(vafile, "CANDIDATES_PER_BLOCK", 100)
    rows = vectors(400, 32, 12, steps=300)
    rows = [(i, rows[1][1] if i % 3 == 0 else row) for i, row in rows]
    asked = []
    monkeypatch.setattr(vafile, "read", lambda pairs, whole, read=vafile.read: asked.append(pairs.count()) or read(pairs, whole))
    check(spark, rows, k=5)
    assert asked[0] == 20 * 5 and asked[1] < 20 * 12


def test_huge_components_saturate(spark):
    table = spark.createDataFrame([(0, [3e37], "", ""), (1, [3e37], "", ""), (2, [-3e37], "", "")], SCHEMA)
    found = sorted(map(tuple, vafile.top_k(table, F.col("vec_id") % 20 == 0, 5).collect()))
    assert found == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -(1 << 63))]
