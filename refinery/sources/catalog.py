"""Tables read by name, and DataFrames given a name for SQL."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from refinery.schemas import require


def read(spark: SparkSession, database: str, declared: dict, *names: str) -> dict[str, DataFrame]:
    """Catalog tables of a layer, checked against their declared schemas; all of them if none is named."""
    return {
        name: require(spark.table(f"{database}.{name}"), declared[name], f"{database}.{name}")
        for name in names or declared
    }


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Makes each table a view of this session, so that SQL can be written on it."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
