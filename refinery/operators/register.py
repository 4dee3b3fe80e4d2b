"""Surrogate keys that outlive a rebuild: a register of all members ever seen and their keys."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.operators.ordering import ascending, dense_key

COPY = "copy"


def _numbered(members: DataFrame, natural: Sequence[str]) -> DataFrame:
    """Members that share a natural key are told apart by their number in the order of their other columns."""
    order = ascending(members, *natural) or [F.lit(0)]
    return members.withColumn(COPY, F.row_number().over(Window.partitionBy(*natural).orderBy(*order)))


def _same(left: DataFrame, right: DataFrame, natural: Sequence[str]) -> Column:
    """The same member; a missing natural key is one too."""
    return reduce(Column.__and__, [left[column].eqNullSafe(right[column]) for column in [*natural, COPY]])


def grown(members: DataFrame, natural: Sequence[str], key: str, register: DataFrame | None) -> DataFrame:
    """The register with the members it did not have yet, numbered after the old ones in the order of their natural key.

    Its keys are 1..N without gaps and never change; a member that has gone keeps its own. Without a register all are new.
    """
    seen = _numbered(members, natural).select(*natural, COPY)
    order = [F.col(column).asc_nulls_first() for column in [*natural, COPY]]
    if register is None:
        return dense_key(seen, order, key, distinct=True)
    last = register.agg(F.max(key)).first()[0] or 0
    new = seen.join(register, _same(seen, register, natural), "left_anti")
    added = dense_key(new, order, key, distinct=True).withColumn(key, F.col(key) + last)
    return register.unionByName(added)


def keyed(members: DataFrame, natural: Sequence[str], key: str, register: DataFrame) -> DataFrame:
    """The members with their keys from a register that has them all."""
    numbered = _numbered(members, natural)
    return numbered.join(register, _same(numbered, register, natural)).select(*[numbered[c] for c in members.columns], register[key])
