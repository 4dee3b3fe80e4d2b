"""Hot keys cut into ranges of an order column: rows stay where they are, only borders are worked out.

Borders are quantiles of the column over all rows of the key, held in one small table. A row finds its range by a binary
search among them, so the cut depends on the values alone and comes out the same whenever a task is run again.
"""

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.operators.skew import LIMITS, Limits, apart, beside, heavy_keys
from refinery.operators.storage import pin

_CLOSENESS = 20  # quantiles are off by a twentieth of a range at most
_LONGEST = 30  # a list that is searched has fewer than 2**30 values


def not_above(values: Column, value: Column, of=lambda item: item) -> Column:
    """How many items of the ascending list ``values`` are missing or at most ``value``: a binary search. None, if ``value`` is missing.

    ``of`` takes the number to compare out of an item.
    """
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(_LONGEST))])

    def further(at: Column, step: Column) -> Column:
        item = of(F.get(values, at + step - 1))
        return F.when((at + step <= F.size(values)) & value.isNotNull() & (item.isNull() | (item <= value)), at + step).otherwise(at)

    return F.coalesce(F.aggregate(steps, F.lit(0), further), F.lit(0))


def borders(df: DataFrame, key: str, by: str, limits: Limits = LIMITS) -> DataFrame:
    """For each hot key (``_heavy``, NULL too): ``_borders``, ascending and different, and ``_tied``.

    A range between two borders holds about ``rows_per_task`` rows or less. ``_tied`` says that one value of ``by`` (or its
    absence) alone holds more, so the ranges can't be even. Pinned; empty without hot keys. ``by`` is a number, date or time.
    """
    heavy = heavy_keys({key: df.select(key)}, limits)
    most = heavy.agg(F.max("n")).first()[0]
    parts = max(2, ceil((most or 0) / limits.rows_per_task))
    _, hot = apart(df.select(key, by), key, heavy, limits)
    quantiles = F.percentile_approx(by, [i / parts for i in range(1, parts)], max(10_000, _CLOSENESS * parts))
    found = hot.groupBy(F.col(key).alias("_heavy")).agg(quantiles.alias("_all"), F.count_if(F.col(by).isNull()).alias("_missing"))
    different = F.array_distinct(F.coalesce("_all", F.array().cast(found.schema["_all"].dataType)))
    tied = (F.size(different) < parts - 1) | (F.col("_missing") > limits.rows_per_task)
    return pin(found.select("_heavy", different.alias("_borders"), tied.alias("_tied")))


def with_range(df: DataFrame, key: str, by: str, cut: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Adds ``_range``, ``_borders`` and ``_tied``: ranges of a hot key from 0 on in the order of ``by``, missing values in the first.

    Other keys have range 0 and no borders.
    """
    found = df.join(beside(cut, limits), F.col(key).eqNullSafe(F.col("_heavy")), "left").drop("_heavy")
    return found.withColumn("_range", F.when(F.col("_borders").isNotNull(), not_above(F.col("_borders"), F.col(by))).otherwise(0))
