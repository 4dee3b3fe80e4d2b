"""Keys that hold too many rows for one task, and a left join that stays spread out over them."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.operators.storage import pin

SAMPLED_ROWS = 1_000


@dataclass(frozen=True)
class Limits:
    """``rows_per_task``: rows of one key that a task may hold. ``broadcast_bytes``: largest table sent to every task."""

    rows_per_task: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024


LIMITS = Limits()


def heavy_keys(keys: Mapping[str, DataFrame], limits: Limits = LIMITS) -> DataFrame:
    """``name``, ``key`` (NULL too) and about how many rows ``n`` it has, for each key of a table of ``keys``, given as its
    key column alone, with more than ``rows_per_task`` rows. Pinned; as long as all rows over ``rows_per_task`` at most.

    Counted on a sample in which a key at the limit has ``SAMPLED_ROWS`` rows, so next to nothing is shuffled.
    The answer only decides how rows are spread over tasks, never which rows are in a result: a key missed or
    named in error costs time. The key columns must be of one type.
    """
    types = {df.schema[0].dataType for df in keys.values()}
    if len(types) != 1:
        raise TypeError(f"keys of different types: {types}")
    fraction = min(1.0, SAMPLED_ROWS / limits.rows_per_task)
    named = [df.select(F.lit(name).alias("name"), F.col(df.columns[0]).alias("key")) for name, df in keys.items()]
    rows = reduce(DataFrame.unionByName, named)
    sampled = rows.sample(fraction, seed=1) if fraction < 1 else rows
    counts = sampled.groupBy("name", "key").agg(F.count(F.lit(1)).alias("n"))
    above = counts.filter(F.col("n") > limits.rows_per_task * fraction)
    return pin(above.select("name", "key", F.ceil(F.col("n") / fraction).alias("n")))


def beside(rows: DataFrame, limits: Limits) -> DataFrame:
    """A pinned table of keys and a few numbers, to be broadcast if its size allows it."""
    small = rows.count() * len(rows.columns) * _BYTES_PER_KEY <= limits.broadcast_bytes
    return F.broadcast(rows) if small else rows


def apart(df: DataFrame, key: str, heavy: DataFrame, limits: Limits = LIMITS) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is not among the heavy ones of the table ``key``, and those whose key is."""
    keys = beside(heavy.filter(F.col("name") == key).select(F.col("key").alias("_heavy")), limits)
    same = F.col(key).eqNullSafe(F.col("_heavy"))
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")


_BYTES_PER_KEY = 64  # taken for each key or number of a hot key
_BYTES_PER_VALUE = 8  # taken for each value on top of its text


def small_tables(tables: Mapping[str, DataFrame], limits: Limits = LIMITS) -> set[str]:
    """Names of the tables whose values, written out, take no more than ``broadcast_bytes``.

    Rows are counted first, which for stored tables hardly reads anything; only tables with few rows are
    measured in full.
    """
    counts = _one_number(tables, lambda df: F.count(F.lit(1)))
    few_rows = {
        name: df
        for name, df in tables.items()
        if counts[name] * len(df.columns) * _BYTES_PER_VALUE <= limits.broadcast_bytes
    }

    def written_out(df: DataFrame) -> Column:
        lengths = [F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) for column in df.columns]
        return F.coalesce(F.sum(reduce(Column.__add__, lengths) + len(lengths) * _BYTES_PER_VALUE), F.lit(0))

    sizes = _one_number(few_rows, written_out) if few_rows else {}
    return {name for name, size in sizes.items() if size <= limits.broadcast_bytes}


def _one_number(tables: Mapping[str, DataFrame], number: Callable[[DataFrame], Column]) -> dict[str, int]:
    found = [df.agg(F.lit(name).alias("name"), number(df).alias("number")) for name, df in tables.items()]
    return {row["name"]: row["number"] for row in reduce(DataFrame.unionByName, found).collect()}


def left_join(
    left: DataFrame,
    left_key: str,
    rights: Mapping[str, DataFrame],
    spread: Column | None = None,
    limits: Limits = LIMITS,
    small: set[str] | None = None,
) -> DataFrame:
    """``left`` left-joined to each table of ``rights`` (named by its key column) on ``left_key``.

    Tables found to be small are broadcast. For the others, without heavy keys this is the plain chain of
    left joins, with one shuffle of the left side for all of them. The rows of a heavy key are cut into
    parts, each part of one side meets each part of the other sides once, and every combination of parts is a
    join key of its own.

    ``spread`` is an expression over the left row that cuts the left rows of a heavy key; without it they are
    left to Spark's own skew join, which can split the left side of a left join but never the right; where adaptive
    execution is off, a hash of the left row cuts them. ``small`` names the tables measured as small already. The
    right rows of a heavy key are cut by position, so that copies part too, and pinned first: a position must
    be the same if a task is run again.
    """
    columns = [*left.columns, *[column for df in rights.values() for column in df.columns]]
    rights = {name: df.filter(F.col(name).isNotNull()) for name, df in rights.items()}
    if small is None:
        small = small_tables(rights, limits)
    large = {name: df for name, df in rights.items() if name not in small}
    if large:
        left = _join_large(left, left_key, large, spread, limits)
    for name in rights:
        if name in small:
            left = left.join(F.broadcast(rights[name]), F.col(left_key) == F.col(name), "left")
    return left.select(*columns)


def _join_large(left, left_key, rights, spread, limits) -> DataFrame:
    if spread is None and left.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        spread = F.xxhash64(*left.columns)
    keys = {name: df.select(name) for name, df in rights.items()}
    if spread is not None:
        keys[left_key] = left.select(left_key)
    heavy = heavy_keys(keys, limits)
    if heavy.isEmpty():
        return reduce(
            lambda df, name: df.join(rights[name], F.col(left_key) == F.col(name), "left"), rights, left
        )

    sides = [left_key, *rights]
    parts = beside(_parts_table(sides, heavy, limits), limits)
    joined = _cut(left, left_key, parts, sides, F.lit(0) if spread is None else spread)
    lost = F.lit(False)
    for name, right in rights.items():
        numbered = _with_position(right, name, heavy, limits)
        pieces = _cut(numbered, name, parts, sides, F.col("_position")).drop("_position", *map(_total, sides))
        pieces = pieces.withColumnsRenamed({_part(side): f"{_part(side)}_of_{name}" for side in sides})
        same = [F.col(_part(side)) == F.col(f"{_part(side)}_of_{name}") for side in sides]
        joined = joined.join(pieces, reduce(Column.__and__, same, F.col(left_key) == F.col(name)), "left")
        # A key cut on the right has a match there, so a copy of the left row that met none is surplus.
        lost = lost | ((F.col(_total(name)) > 1) & F.col(name).isNull())
    return joined.filter(~lost)


def _part(side: str) -> str:
    return f"_part_{side}"


def _total(side: str) -> str:
    return f"_parts_{side}"


def _parts_table(sides, heavy, limits) -> DataFrame:
    """One row per heavy key: into how many parts each side cuts it."""
    def parts(side: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("name") == side, F.ceil(F.col("n") / limits.rows_per_task))), F.lit(1))

    return pin(heavy.groupBy(F.col("key").alias("_heavy")).agg(*[parts(side).cast("int").alias(_total(side)) for side in sides]))


def _with_position(right: DataFrame, name: str, heavy: DataFrame, limits: Limits) -> DataFrame:
    light, hot = apart(right, name, heavy, limits)
    light = light.withColumn("_position", F.lit(0).cast("bigint"))
    return light.unionByName(pin(hot).withColumn("_position", F.monotonically_increasing_id()))


def _cut(df, key, parts, sides, by: Column) -> DataFrame:
    """Gives each row its own part and copies it to all parts of the other sides."""
    df = df.join(parts, F.col(key).eqNullSafe(F.col("_heavy")), "left").drop("_heavy")
    df = df.withColumns({_total(side): F.coalesce(_total(side), F.lit(1)) for side in sides})
    for side in sides:
        total = F.col(_total(side))
        place = F.pmod(by, total).cast("int") if side == key else F.explode(F.sequence(F.lit(0), total - 1))
        df = df.withColumn(_part(side), place)
    return df
