"""Operators that need all rows, or all rows of a key, in one order - without a task that holds them all."""

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.operators import ranges
from refinery.operators.skew import LIMITS, Limits, apart, beside, heavy_keys
from refinery.operators.storage import pin

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row number within it below


def ascending(df: DataFrame, *but: str) -> list[Column]:
    """All other columns in schema order: breaks every tie but that of exact copies."""
    return [F.col(column).asc_nulls_last() for column in df.columns if column not in but]


def latest_per_key(
    df: DataFrame, key: str, date: str, ties: Sequence[Column] | None = None
) -> DataFrame:
    """The newest row of each key; rows without a key are dropped and a missing date is the oldest.

    Spark keeps one row per key and task before it shuffles, so a key with many rows stays cheap.
    """
    order = [F.col(date).desc_nulls_last(), *(ascending(df, key, date) if ties is None else ties)]
    newest = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.filter(F.col(key).isNotNull()).withColumn("_rank", newest).filter("_rank = 1").drop("_rank")


def _told_apart(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The rows with columns that tell exact copies apart, and an order in which no two rows tie.

    Copies are counted per task of ``df`` before they are shuffled and numbered within that count, so a row is the same
    row if a task is run again, and a group of copies is spread by the tasks that it comes from.
    """
    counted = df.withColumn("_from", F.spark_partition_id()).groupBy(*df.columns, "_from").agg(F.count(F.lit(1)).alias("_copies"))
    copies = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies")
    return copies, [*ascending(df), F.col("_from"), F.col("_copy")]


def in_order(df: DataFrame, order: Sequence[Column], distinct: bool = False) -> DataFrame:
    """The rows in one global order, pinned, with ``_chunk`` (place of the partition) and ``_at`` (place of the row).

    Both grow along the order. Rows that tie in ``order`` go by their other columns and copies by number, so Spark can
    put the border between two partitions anywhere, even between exact copies. ``distinct`` says that no two rows tie in
    ``order``. Columns have to be comparable; a double of -0.0 comes back as 0.0.
    """
    rows, ties = (df, []) if distinct else _told_apart(df)
    placed = pin(rows.orderBy(*order, *ties).select(*df.columns))
    return placed.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_chunk", F.shiftrightunsigned("_at", _INDEX_BITS)
    )


def dense_key(df: DataFrame, order: Sequence[Column], name: str, distinct: bool = False) -> DataFrame:
    """Adds the bigint column ``name``: 1..N in the given order, as one global ``row_number`` would."""
    placed = in_order(df, order, distinct)
    # One row per partition of the sort, of which there are at most spark.sql.shuffle.partitions: counted once here, and
    # small enough for the driver and for every task.
    sizes = sorted(map(tuple, placed.groupBy("_chunk").agg(F.count(F.lit(1))).collect()))
    before = accumulate((rows for _, rows in sizes), initial=0)
    starts = df.sparkSession.createDataFrame([(chunk, at) for (chunk, _), at in zip(sizes, before)], "_chunk bigint, _start bigint")
    row_in_chunk = F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return placed.join(F.broadcast(starts), "_chunk").select(
        *df.columns, (F.col("_start") + row_in_chunk + 1).alias(name)
    )


def in_turn(df: DataFrame, *but: str) -> list[Column]:
    """As ``ascending``, in plain columns: each after the mark that it is missing."""
    return [part for column in df.columns if column not in but for part in (F.col(column).isNull(), F.col(column))]


def with_neighbours(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    take: Mapping[str, tuple[str, int]],
    limits: Limits = LIMITS,
    by: str | None = None,
) -> DataFrame:
    """Adds columns taken from the next (+1) or the previous (-1) row of the same key: ``{new: (column, step)}``.

    ``by`` names the first column of ``order``, a number, date or time; all of ``order`` are then plain columns, ascending with
    missing values first. Hot keys are cut into ranges of it (``ranges.py``): one shuffle by key and range, and the rows at the
    borders from one small table. Hot keys without ``by``, or with one value of it that is too hot itself, are put in one global
    order (see ``in_order``).
    """
    if by is not None:
        cut = ranges.borders(df.select(key, by), key, by, limits)
        tied = cut.filter("_tied").select(F.lit(key).alias("name"), F.col("_heavy").alias("key"))
        if tied.isEmpty():
            return _neighbours_by_range(df, key, order, take, by, cut, limits)
        rest, hot = apart(df, key, tied, limits)
        near = _neighbours_by_range(rest, key, order, take, by, cut.filter("NOT _tied"), limits)
        return near.unionByName(_neighbours_by_place(hot, key, order, take))
    heavy = heavy_keys({key: df.select(key)}, limits)
    if heavy.isEmpty():
        return _neighbours_by_window(df, key, order, take)
    light, hot = apart(df, key, heavy, limits)
    return _neighbours_by_window(light, key, order, take).unionByName(_neighbours_by_place(hot, key, order, take))


def _neighbours_by_window(df, key, order, take) -> DataFrame:
    rows = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({new: F.lag(column, -step).over(rows) for new, (column, step) in take.items()})


def _neighbours_by_range(df, key, order, take, by, cut, limits) -> DataFrame:
    if cut.isEmpty():
        return _neighbours_by_window(df, key, order, take)
    taken = F.struct(*[F.col(column).alias(new) for new, (column, _) in take.items()])
    ranged = ranges.with_range(df, key, by, cut, limits).withColumn("_taken", taken)
    # First and last row of each range of the hot keys: two rows per range, found before anything is shuffled.
    turn = F.struct(F.struct(*order).alias("order"), F.col("_taken").alias("taken"))
    ends = ranged.filter(F.col("_borders").isNotNull()).groupBy(F.col(key).alias("_of_key"), F.col("_range").alias("_of_range")).agg(
        F.min(turn)["taken"].alias("_first"), F.max(turn)["taken"].alias("_last")
    )
    along = Window.partitionBy("_of_key").orderBy("_of_range")
    borders = ends.select("_of_key", "_of_range", F.lead("_first").over(along).alias("_after"), F.lag("_last").over(along).alias("_before"))
    rows = Window.partitionBy(key, "_range").orderBy(*order)
    met = ranged.withColumns({"_next": F.lead("_taken").over(rows), "_previous": F.lag("_taken").over(rows)})
    same = F.col(key).eqNullSafe(F.col("_of_key")) & (F.col("_range") == F.col("_of_range"))
    met = met.join(beside(borders, limits), same, "left")
    sides = {1: F.coalesce("_next", "_after"), -1: F.coalesce("_previous", "_before")}
    return met.select(*df.columns, *[sides[step][new].alias(new) for new, (_, step) in take.items()])


def _neighbours_by_place(df, key, order, take) -> DataFrame:
    placed = in_order(df, [F.col(key), *order]).withColumn(
        "_row", F.struct(F.col(key).alias("key"), *[F.col(c).alias(new) for new, (c, _) in take.items()])
    )
    # The first and the last row of each partition of the sort: two rows per partition, small enough to broadcast.
    ends = placed.groupBy("_chunk").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    firsts = placed.join(F.broadcast(ends.select(F.col("_first").alias("_at"))), "_at")
    lasts = placed.join(F.broadcast(ends.select(F.col("_last").alias("_at"))), "_at")
    chunks = Window.orderBy("_chunk")
    borders = (
        firsts.select("_chunk", F.col("_row").alias("_first_row"))
        .join(F.broadcast(lasts.select("_chunk", F.col("_row").alias("_last_row"))), "_chunk")
        .select(
            "_chunk",
            F.lead("_first_row").over(chunks).alias("_after"),
            F.lag("_last_row").over(chunks).alias("_before"),
        )
    )
    rows = Window.partitionBy("_chunk").orderBy("_at")
    met = placed.withColumns({"_next": F.lead("_row").over(rows), "_previous": F.lag("_row").over(rows)})
    met = met.join(F.broadcast(borders), "_chunk").withColumns(
        {"_next": F.coalesce("_next", "_after"), "_previous": F.coalesce("_previous", "_before")}
    )

    def taken(new: str, step: int) -> Column:
        other = F.col("_next" if step > 0 else "_previous")
        return F.when(other["key"].eqNullSafe(F.col(key)), other[new]).alias(new)

    return met.select(*df.columns, *[taken(new, step) for new, (_, step) in take.items()])


def close_versions(
    df: DataFrame,
    key: str,
    start: str,
    end: str,
    ties: Sequence[Column],
    limits: Limits = LIMITS,
) -> DataFrame:
    """Sets ``end`` to the day before the next version of the key starts, NULL for the last; cuts ``start`` to a day.

    A missing start comes first. ``ties`` are plain columns, ascending with missing values first.
    """
    followed = with_neighbours(df, key, [F.col(start), *ties], {"_next_start": (start, 1)}, limits, by=start)
    return followed.withColumns(
        {start: F.col(start).cast("date"), end: F.date_sub(F.col("_next_start").cast("date"), 1)}
    ).drop("_next_start")
