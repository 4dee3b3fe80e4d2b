"""As-of join: each row meets the latest version of its key that had begun by then."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.operators import ranges
from refinery.operators.skew import LIMITS, Limits, beside, small_tables


def as_of_join(
    left: DataFrame,
    left_on: tuple[str, str],
    right: DataFrame,
    right_on: tuple[str, str],
    take: Mapping[str, str],
    ties: Sequence[str] = (),
    limits: Limits = LIMITS,
) -> DataFrame:
    """``left`` with the columns ``take`` (``{new: column of right}``) of the right row that held at its time, NULL where none did.

    ``left_on`` and ``right_on`` name key and time, of the same types on both sides. A right row holds from its time on (from
    ever, if the time is missing) until the next one of the key; of those that begin together the last in the ascending order
    of ``ties``, then of ``take``, missing values first, counts. A left row without key or time meets none. Every left row
    comes back once, copies too.

    A right table measured as small is sent to every task as one sorted list per key, and a left row searches its list: no left
    row moves. Otherwise both sides meet in one shuffle by key, and a window hands each left row the version before it. Hot keys
    are cut by time: each range is a task of its own and gets the last version of the ranges before it. Where a single time holds
    too many rows of a hot key, its left rows are also cut by a hash, and its versions copied to each part.
    """
    key, time = right_on
    needed = list(dict.fromkeys([key, time, *ties, *take.values()]))
    versions = right.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(time).alias("_time"),
        F.struct(F.col(time).alias("_time"), *[F.col(c).alias(f"_tie_{i}") for i, c in enumerate(ties)],
                 *[F.col(c).alias(f"_take_{i}") for i, c in enumerate(take.values())]).alias("_version"),
    )
    if small_tables({key: right.select(*needed)}, limits):
        met = _by_search(left, left_on, versions)
    else:
        met = _by_window(left, left_on, versions, limits)
    return met.select(*left.columns, *[F.col("_version")[f"_take_{i}"].alias(new) for i, new in enumerate(take)])


def _by_search(left: DataFrame, left_on: tuple[str, str], versions: DataFrame) -> DataFrame:
    lists = versions.groupBy("_key").agg(F.array_sort(F.collect_list("_version")).alias("_versions"))
    met = left.join(F.broadcast(lists), F.col(left_on[0]) == F.col("_key"), "left")
    before = ranges.not_above(F.col("_versions"), F.col(left_on[1]), lambda version: version["_time"])
    return met.withColumn("_before", before).withColumn("_version", F.get("_versions", F.col("_before") - 1))


def _by_window(left: DataFrame, left_on: tuple[str, str], versions: DataFrame, limits: Limits) -> DataFrame:
    key, time = (F.col(column) for column in left_on)
    # Rows without a time go along and get none at the end: as a condition, the expression of the time would be put in place
    # of its name on both sides of whatever join ``left`` comes from, and be worked out for every row several times.
    others = left.filter(key.isNull())
    rows = left.filter(key.isNotNull()).select(key.alias("_key"), time.alias("_time"), F.struct(*left.columns).alias("_left")).unionByName(
        versions, allowMissingColumns=True
    )
    cut = ranges.borders(rows.select("_key", "_time"), "_key", "_time", limits)
    rows = ranges.with_range(rows, "_key", "_time", cut, limits)
    # Only where one time is too hot for a range: left rows by a hash, versions in every part.
    parts = F.when(F.col("_tied"), F.size("_borders") + 2).otherwise(1)
    whole = F.array(F.pmod(F.xxhash64("_left"), parts).cast("int"))
    rows = rows.withColumn("_part", F.explode(F.when(F.col("_left").isNotNull(), whole).otherwise(F.sequence(F.lit(0), parts - 1))))
    # Versions come before the left rows of their time, and among themselves in the order of the struct.
    so_far = Window.partitionBy("_key", "_range", "_part").orderBy("_time", F.col("_left").isNotNull(), "_version")
    held = rows.withColumn("_held", F.last("_version", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    held = held.filter(F.col("_left").isNotNull())
    carried = _carried(ranges.with_range(versions, "_key", "_time", cut, limits), cut)
    same = (F.col("_key") == F.col("_of_key")) & (F.col("_range") == F.col("_of_range"))
    version = F.when(F.col("_time").isNotNull(), F.coalesce("_held", "_carried"))
    met = held.join(beside(carried, limits), same, "left").select("_left.*", version.alias("_version"))
    return met.unionByName(others, allowMissingColumns=True)


def _carried(versions: DataFrame, cut: DataFrame) -> DataFrame:
    """For each range of each hot key the last version of the ranges before it: as many rows as ranges."""
    last = versions.filter(F.col("_borders").isNotNull()).groupBy("_key", "_range").agg(F.max("_version").alias("_last"))
    every = cut.select(F.col("_heavy").alias("_of_key"), F.explode(F.sequence(F.lit(0), F.size("_borders"))).alias("_of_range"))
    same: Column = (F.col("_of_key") == F.col("_key")) & (F.col("_of_range") == F.col("_range"))
    earlier = Window.partitionBy("_of_key").orderBy("_of_range").rowsBetween(Window.unboundedPreceding, -1)
    return every.join(last, same, "left").select("_of_key", "_of_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
