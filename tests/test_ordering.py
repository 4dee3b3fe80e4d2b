"""Latest record, dense key, neighbours and version closing against plain Python or one global window."""

import datetime as dt
from itertools import groupby

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from refinery.operators import ordering
from refinery.operators.ordering import close_versions, dense_key, in_order, latest_per_key, with_neighbours
from refinery.operators.skew import Limits
from refinery.operators.storage import pin

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DAY = dt.date


def test_latest_per_key_rule_table(spark):
    df = spark.createDataFrame(
        [(1, DAY(2024, 1, 1), "a"), (1, DAY(2024, 2, 1), "b"), (1, None, "c"), (2, None, "d"),
         (None, DAY(2024, 1, 1), "e"), (3, DAY(2024, 1, 1), "z"), (3, DAY(2024, 1, 1), "y"), (3, DAY(2024, 1, 1), None)],
        "k int, d date, v string",
    )
    assert rows(latest_per_key(df, "k", "d"), "k", "v") == [(1, "b"), (2, "d"), (3, "y")]


def test_latest_per_key_keeps_one_row_per_task_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.current_date().alias("d"), "id")
    text = plan(latest_per_key(df, "k", "d"))
    before_shuffle = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@FEW
@given(st.lists(st.tuples(st.none() | st.integers(0, 3), st.none() | st.integers(0, 5)), max_size=40))
def test_latest_per_key_gives_one_row_per_key(spark, pairs):
    df = spark.createDataFrame(pairs, "k int, d int")
    newest = {}
    for key, day in pairs:
        if key is not None:
            newest[key] = max(newest.get(key, -1), -1 if day is None else day)
    expected = sorted((k, None if d == -1 else d) for k, d in newest.items())
    assert sorted(tuple(row) for row in latest_per_key(df, "k", "d").collect()) == expected


@FEW
@given(st.lists(st.tuples(st.none() | st.integers(0, 4), st.sampled_from(["a", "b", None])), max_size=60))
def test_dense_key_is_the_global_row_number(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b string").repartition(5)
    order = [F.col("a").asc_nulls_first(), F.col("b").desc_nulls_last()]
    keyed = dense_key(df, order, "key")
    expected = df.withColumn("key", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert keyed.columns == ["a", "b", "key"] and keyed.schema["key"].dataType.simpleString() == "bigint"
    assert rows(keyed) == rows(expected)


def hot(spark, n=20_000):
    """A third of all rows are exact copies of one row, a tenth have NULLs only."""
    row = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(0, n, 1, 8).select(row.cast("int").alias("k"), (row % 7).cast("int").alias("v"))


def test_dense_key_numbers_copies_apart(spark):
    df = hot(spark)
    keyed = dense_key(df, [F.col("k").asc_nulls_first()], "key")
    summary = keyed.agg(F.count("*"), F.count_distinct("key"), F.min("key"), F.max("key")).first()
    assert tuple(summary) == (20_000, 20_000, 1, 20_000)
    assert rows(keyed, "k", "v") == rows(df)
    back = keyed.withColumn("before", F.lag(F.coalesce("k", F.lit(-1))).over(Window.orderBy("key")))
    assert back.filter(F.coalesce("k", F.lit(-1)) < F.col("before")).isEmpty()


def test_in_order_cuts_a_group_of_copies(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [row["count"] for row in in_order(hot(spark), [F.col("k")]).groupBy("_chunk").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_dense_key_is_a_scan_of_its_pinned_rows(spark, plan):
    text = plan(dense_key(hot(spark), [F.col("k")], "key"))
    assert "SinglePartition" not in text and "hashpartitioning" not in text
    assert text.count("BroadcastHashJoin") == 1 and "Window" not in text


@pytest.mark.parametrize("distinct", [False, True])
def test_dense_key_pins_its_rows_once(spark, monkeypatch, distinct):
    pinned = []
    monkeypatch.setattr(ordering, "pin", lambda df: pinned.append(df) or pin(df))
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    keyed = dense_key(df, [F.col("k"), F.col("id").desc()], "key", distinct)
    assert len(pinned) == 1
    expected = df.withColumn("key", F.row_number().over(Window.orderBy("k", F.col("id").desc())).cast("bigint"))
    assert rows(keyed) == rows(expected)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 50])
def test_neighbours_of_light_and_heavy_keys(spark, rows_per_task):
    df = hot(spark, 6000).withColumn("o", F.monotonically_increasing_id() % 40)
    order = [F.col("o"), F.col("v").asc_nulls_first()]
    near = with_neighbours(df, "k", order, {"next": ("o", 1), "before": ("v", -1)}, Limits(rows_per_task))
    window = Window.partitionBy("k").orderBy(*order)
    expected = df.withColumns({"next": F.lead("o").over(window), "before": F.lag("v").over(window)})
    assert rows(near) == rows(expected)


VERSIONS = [
    ("A", "2011-07-01 00:00:00", 1, DAY(2011, 7, 1), DAY(2012, 6, 29)),
    ("A", "2012-06-30 15:00:00", 2, DAY(2012, 6, 30), None),
    ("B", None, 3, None, DAY(2023, 12, 31)),
    ("B", "2024-01-01 00:00:00", 4, DAY(2024, 1, 1), None),
    ("C", None, 5, None, None),
    ("C", None, 6, None, None),
    ("D", "2024-05-05 08:00:00", 7, DAY(2024, 5, 5), DAY(2024, 5, 4)),
    ("D", "2024-05-05 09:00:00", 8, DAY(2024, 5, 5), None),
    (None, "2024-05-05 09:00:00", 9, DAY(2024, 5, 5), DAY(2024, 5, 5)),
    (None, "2024-05-06 09:00:00", 10, DAY(2024, 5, 6), None),
]


@pytest.mark.parametrize("rows_per_task", [1_000_000, 1])
def test_close_versions_rule_table(spark, rows_per_task):
    df = spark.createDataFrame([row[:3] for row in VERSIONS], "k string, s string, i int")
    df = df.withColumn("s", F.col("s").cast("timestamp"))
    closed = close_versions(df, "k", "s", "e", [F.col("i")], Limits(rows_per_task))
    found = {row.i: (row.k, row.s, row.e) for row in closed.collect()}
    assert found == {row[2]: (row[0], row[3], row[4]) for row in VERSIONS}


@FEW
@given(st.sets(st.tuples(st.sampled_from("ab"), st.dates(DAY(2020, 1, 1), DAY(2020, 12, 31))), max_size=30))
def test_versions_with_different_starts_do_not_overlap(spark, versions):
    df = spark.createDataFrame(sorted(versions), "k string, s date")
    closed = close_versions(df, "k", "s", "e", [])
    for _, of_key in groupby(sorted(tuple(row) for row in closed.collect()), key=lambda row: row[0]):
        of_key = list(of_key)
        assert of_key[-1][2] is None
        for this, following in zip(of_key, of_key[1:]):
            assert this[1] <= this[2] == following[1] - dt.timedelta(days=1)
