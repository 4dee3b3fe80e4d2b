"""Rows at places of an order, against sorting."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.operators import selection
from refinery.operators.selection import rows_at


def expected(values, places):
    placed = sorted(enumerate(values), key=lambda row: (row[1] is not None, row[1] or 0, row[0]))
    return {place: (placed[place - 1][1], placed[place - 1][0]) for place in places if 1 <= place <= len(values)}


def found(spark, values, places):
    df = spark.createDataFrame(list(enumerate(values)), "k bigint, v bigint").repartition(3)
    return rows_at(df, {"v": F.col("v"), "less": -F.col("v")}, "k", places)


@pytest.mark.parametrize("top", [3, 10**6, 2**62])
def test_large_ranges_ties_and_missing_values(spark, top):
    draw = random.Random(top)
    values = [draw.choice([None, draw.randrange(-top, top), 5]) for _ in range(500)]
    both = found(spark, values, [1, 2, 170, 171, 333, 500, 501])
    assert both["v"] == expected(values, [1, 2, 170, 171, 333, 500])
    less = expected([None if v is None else -v for v in values], [1, 2, 170, 171, 333, 500])
    assert both["less"] == less


def test_no_rows(spark):
    assert found(spark, [], [1]) == {"v": {}, "less": {}}
    assert found(spark, [None, None], [2, 3]) == {"v": {2: (None, 1)}, "less": {2: (None, 1)}}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20)), max_size=30), st.sets(st.integers(0, 35), max_size=5))
def test_any_places(spark, values, places):
    cells, selection.CELLS = selection.CELLS, 4
    try:
        assert found(spark, values, places)["v"] == expected(values, places)
    finally:
        selection.CELLS = cells
