"""As-of join and ranges of hot keys, against plain comparisons of all rows of a key."""

import datetime as dt
import random

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.operators import ranges
from refinery.operators.asof import as_of_join
from refinery.operators.ordering import with_neighbours
from refinery.operators.skew import Limits

DAY = dt.date(2020, 1, 1)
LEFT, RIGHT = "k string, at date, x int", "key string, since date, id int, cost int"
WAYS = {"search": Limits(), "window": Limits(broadcast_bytes=0), "ranges": Limits(4, 0), "ranges beside": Limits(4, 3_000)}


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def expected(left, right):
    found = []
    for k, at, x in left:
        held = [r for r in right if k is not None and at is not None and r[0] == k and (r[1] is None or r[1] <= at)]
        best = max(held, key=lambda r: (r[1] is not None, r[1] or DAY, r[2], r[3])) if held else None
        found.append((k, at, x, *((best[2], best[3]) if best else (None, None))))
    return sorted(map(repr, found))


def joined(spark, left, right, limits):
    met = as_of_join(
        spark.createDataFrame(left, LEFT), ("k", "at"), spark.createDataFrame(right, RIGHT), ("key", "since"),
        {"id": "id", "cost": "cost"}, ties=["id"], limits=limits,
    )
    assert met.columns == ["k", "at", "x", "id", "cost"]
    return sorted(map(repr, map(tuple, met.collect())))


@pytest.mark.parametrize("way", WAYS)
def test_odd_rows(spark, way):
    left = [("a", day(5), 1), ("a", day(5), 1), ("a", None, 2), (None, day(3), 3), ("b", day(0), 4), ("c", day(9), 5), ("a", day(0), 6)]
    right = [("a", day(5), 1, 10), ("a", day(5), 2, 20), ("a", day(6), 3, 30), (None, day(0), 4, 40), ("b", day(1), 5, 50), ("c", None, 6, 60)]
    assert joined(spark, left, right, WAYS[way]) == expected(left, right)
    assert joined(spark, [], right, WAYS[way]) == [] and joined(spark, left, [], WAYS[way]) == expected(left, [])


@pytest.mark.parametrize("way", WAYS)
def test_hot_products(spark, way):
    draw = random.Random(1)
    days = {"hot": 300, "tied": 1, "cold": 300, None: 50}
    left = [(k, day(draw.randrange(days[k])), i) for i in range(900) for k in [draw.choice(["hot", "hot", "tied", "cold" if i % 50 == 0 else "hot", None])]]
    right = [(draw.choice(["hot", "hot", "tied", "cold"]), draw.choice([None, *map(day, range(0, 300, 7))]), i, i) for i in range(120)]
    assert joined(spark, left, right, WAYS[way]) == expected(left, right)


few = settings(max_examples=8, deadline=None)
DAYS = st.one_of(st.none(), st.integers(0, 6).map(day))


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), DAYS, st.integers(0, 3)), max_size=25),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), DAYS, st.integers(0, 9), st.integers(0, 3)), max_size=12))
def test_all_ways_agree_with_a_plain_comparison(spark, left, right):
    wanted = expected(left, right)
    for limits in (WAYS["search"], WAYS["ranges"]):
        assert joined(spark, left, right, limits) == wanted


def test_no_pairs_of_a_product_are_made(spark, plan):
    left, right = spark.createDataFrame([("a", DAY, 1)], LEFT), spark.createDataFrame([("a", DAY, 1, 1)], RIGHT)
    for limits in WAYS.values():
        text = plan(as_of_join(left, ("k", "at"), right, ("key", "since"), {"cost": "cost"}, limits=limits))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "SortMergeJoin" not in text.replace("_of_range", "") or "_of_range" in text
    assert "Exchange hashpartitioning(k" not in plan(as_of_join(left, ("k", "at"), right, ("key", "since"), {"cost": "cost"}))


def test_the_expression_of_the_time_is_in_no_condition(spark, plan):
    """Where the left side is a join, a condition on the time would be worked out on both its sides, however dear it is."""
    lines, orders = spark.range(20).selectExpr("id AS o", "concat('k', id % 3) AS k"), spark.range(20).selectExpr("id AS of", "id % 7 AS d")
    when = F.when(F.col("o") % 5 > 0, F.date_add(F.lit(DAY), F.col("d").cast("int")))
    left = lines.join(orders, F.col("o") == F.col("of")).select("k", when.alias("at"), F.col("o").cast("int").alias("x"))
    right = spark.createDataFrame([("k0", DAY, 1, 1)], RIGHT)
    text = plan(as_of_join(left, ("k", "at"), right, ("key", "since"), {"cost": "cost"}, limits=WAYS["window"]))
    conditions = [line for line in text.splitlines() if "Filter" in line or "Join" in line]
    assert conditions and not [line for line in conditions if "date_add" in line or "% 5" in line]


@pytest.mark.parametrize("way", WAYS)
def test_many_rows_without_a_time(spark, way):
    left = [("hot", None, i) for i in range(60)] + [("hot", day(i % 9), i) for i in range(40)] + [("cold", None, 1), ("cold", day(1), 2)]
    right = [("hot", None, 1, 1), ("hot", day(3), 2, 2), ("cold", None, 3, 3)]
    assert joined(spark, left, right, WAYS[way]) == expected(left, right)


def hot_days(spark, n=40_000):
    """Two thirds of the rows are of one key, over 2,000 days."""
    key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.date_add(F.lit(DAY), (F.xxhash64("id") % 1000).cast("int")).alias("at"), F.col("id").cast("int").alias("x"))


def test_a_hot_key_is_cut_into_even_ranges(spark):
    df = hot_days(spark)
    cut = ranges.borders(df, "k", "at", Limits(2_000))
    found = cut.collect()
    assert [row["_heavy"] for row in found] == ["hot"] and not found[0]["_tied"]
    sizes = ranges.with_range(df, "k", "at", cut).filter("k = 'hot'").groupBy("_range").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    sizes = sizes.orderBy("_range").collect()
    assert len(sizes) >= 13 and max(row.n for row in sizes) < 1.3 * 2_000
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))


def test_neighbours_of_a_hot_key_need_no_pin_of_rows(spark, plan):
    df = hot_days(spark)
    near = with_neighbours(df, "k", [F.col("at"), F.col("x")], {"next": ("x", 1), "before": ("x", -1)}, Limits(2_000), by="at")
    plain = with_neighbours(df, "k", [F.col("at"), F.col("x")], {"next": ("x", 1), "before": ("x", -1)})
    assert rows(near) == rows(plain)
    text = plan(near)
    assert "hashpartitioning(k" in text and "rangepartitioning" not in text and "SinglePartition" not in text


def test_one_value_that_is_too_hot(spark):
    df = hot_days(spark, 6_000).withColumn("at", F.when(F.col("x") % 5 > 0, F.lit(DAY)).when(F.col("x") % 2 == 0, F.col("at")))
    order, take = [F.col("at"), F.col("x")], {"next": ("x", 1), "before": ("x", -1)}
    assert [row["_tied"] for row in ranges.borders(df, "k", "at", Limits(500)).collect()] == [True]
    assert rows(with_neighbours(df, "k", order, take, Limits(500), by="at")) == rows(with_neighbours(df, "k", order, take))
