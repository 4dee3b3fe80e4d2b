"""Left joins with hot keys on either side against Spark's plain left join."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from refinery.operators.skew import Limits, apart, heavy_keys, left_join, small_tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Left keys 1 (hot), NULL (hot) and 2..40; rights hot on 1 and on 3, one without key 1, copies and NULL keys."""
    folder = tmp_path_factory.mktemp("join")

    def stored(name, df):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    i = F.col("id")
    left = spark.range(0, 120, 1, 4).select(
        i.alias("id"), F.when(i % 3 == 0, 1).when(i % 7 == 0, None).otherwise(i % 40).cast("int").alias("k")
    )
    r1 = spark.range(0, 90, 1, 4).select(
        F.when(i % 3 == 0, 1).when(i % 5 == 0, 3).when(i % 11 == 0, None).otherwise(i % 30).cast("int").alias("k1"),
        (i % 2).alias("a"),
    )
    r2 = spark.range(0, 60, 1, 4).select(F.when(i % 2 == 0, 3).otherwise(i % 50 + 4).cast("int").alias("k2"), (i % 3).alias("b"))
    return stored("left", left), stored("r1", r1), stored("r2", r2)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 20, 4, 1])
@pytest.mark.parametrize("spread", [True, False])
@pytest.mark.parametrize("broadcast_bytes", [0, 1900, 1_000_000])
def test_left_join_is_the_plain_left_join(tables, rows_per_task, spread, broadcast_bytes):
    left, r1, r2 = tables
    by = F.xxhash64("id") if spread else None
    expected = left.join(r1, F.col("k") == F.col("k1"), "left").join(r2, F.col("k") == F.col("k2"), "left")
    joined = left_join(left, "k", {"k1": r1, "k2": r2}, by, Limits(rows_per_task, broadcast_bytes))
    assert joined.columns == ["id", "k", "k1", "a", "k2", "b"]
    assert rows(joined) == rows(expected)


def test_heavy_keys_counts_null_too(tables):
    left, right, _ = tables

    def heavy(df, key):
        return {row[key]: row["count"] for row in df.groupBy(key).count().collect() if row["count"] > 10}

    found = found_keys({"left": left.select("k"), "right": right.select("k1")}, Limits(10))
    assert found == {"left": heavy(left, "k"), "right": heavy(right, "k1")}
    assert None in found["left"]


def found_keys(keys, limits):
    found = {name: {} for name in keys}
    for name, key, n in heavy_keys(keys, limits).collect():
        found[name][key] = n
    return found


@pytest.mark.parametrize("heavy", [[], [None], [1], [1, None]])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_heavy_rows_are_told_apart(spark, heavy, broadcast_bytes):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([("k", key) for key in heavy] + [("other", 2)], "name string, key int")
    light, hot = apart(df, "k", keys, Limits(broadcast_bytes=broadcast_bytes))
    assert {row[0] for row in hot.collect()} == set(heavy)
    assert light.count() == 3 - len(heavy)


def test_hot_keys_of_one_table_do_not_hide_those_of_another(spark):
    left = spark.range(0, 60_000).select((F.col("id") % 12_000).alias("k"))
    right = spark.range(0, 600).select(F.lit(-1).cast("bigint").alias("r"))
    found = found_keys({"left": left, "right": right}, Limits(4))
    assert len(found["left"]) == 12_000 and found["right"] == {-1: 600}


def test_keys_of_different_types_are_an_error(spark):
    with pytest.raises(TypeError):
        heavy_keys({"a": spark.range(1), "b": spark.range(1).select(F.lit("x"))})


def test_heavy_keys_of_many_rows_come_from_a_sample(spark):
    i = F.col("id")
    many = spark.range(0, 300_000, 1, 4).select(F.when(i % 3 == 0, -1).when(i % 3 == 1, None).otherwise(i).alias("k"))
    found = found_keys({"many": many}, Limits(20_000))["many"]
    assert found.keys() == {-1, None} and all(80_000 < n < 120_000 for n in found.values())
    assert found_keys({"many": many}, Limits(200_000)) == {"many": {}}


def test_parts_of_a_hot_key_go_to_different_tasks(spark, tables):
    left, r1, _ = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def tasks_of_key_one(joined):
            return joined.filter("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()

        assert tasks_of_key_one(left_join(left, "k", {"k1": r1}, limits=Limits(broadcast_bytes=0))) == 1
        assert tasks_of_key_one(left_join(left, "k", {"k1": r1}, F.xxhash64("id"), Limits(5, 0))) >= 5
        assert tasks_of_key_one(left_join(left, "k", {"k1": r1}, limits=Limits(5, 0))) >= 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_joins_without_heavy_keys_share_the_shuffle_of_the_left_side(spark, tables, plan):
    left, r1, r2 = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(left_join(left, "k", {"k1": r1, "k2": r2}, F.xxhash64("id"), Limits(broadcast_bytes=0)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2 and text.count("Exchange") == 3


def test_spark_splits_hot_keys_of_the_left_side_at_run_time(spark, tmp_path):
    """What the two lookups of the fact rely on, with thresholds fit for this little data."""
    i = F.col("id")
    spark.range(0, 400_000, 1, 8).select(
        i.alias("id"),
        F.when(i % 3 == 0, None).when(i % 3 == 1, 1).otherwise(i % 1000).cast("int").alias("k"),
        F.when(i % 2 == 0, 7).otherwise(i % 1000).cast("int").alias("h"),
        F.sha2(i.cast("string"), 256).alias("text"),
    ).write.parquet(f"{tmp_path}/left")
    spark.range(1000).select(i.cast("int").alias("k1"), (i * 2).alias("v")).write.parquet(f"{tmp_path}/right")
    left, right = spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/right")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        limits = Limits(broadcast_bytes=0)
        first = left_join(left, "k", {"k1": right}, limits=limits)
        both = left_join(first, "h", {"k2": right.toDF("k2", "w")}, limits=limits)
        run = both.agg(F.count("text"), F.sum("v"), F.sum("w"))
        assert run.first()[0] == 400_000
        run.collect()
        final = run._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("skew=true") == 2
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_only_tables_of_a_checked_size_are_broadcast(spark, tables, plan):
    left, r1, r2 = tables
    sizes = {"k1": 1500, "k2": 1000}  # both between these and twice as much
    assert small_tables({"k1": r1, "k2": r2}, Limits(broadcast_bytes=sizes["k2"] // 4)) == set()
    assert small_tables({"k1": r1, "k2": r2}, Limits(broadcast_bytes=2 * sizes["k1"])) == {"k1", "k2"}
    assert small_tables({"empty": r1.filter("k1 > 1000")}, Limits(broadcast_bytes=0)) == {"empty"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(left_join(left, "k", {"k1": r1, "k2": r2}))
        assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
