"""Parquet files and the external catalog tables over them."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery.functions.dates import in_months
from refinery.schemas import FACT_PARTITIONS, GOLD, ddl, mismatches, require


def write_files(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_months(df: DataFrame, date: str = "order_date") -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def write_by_month(df: DataFrame, path: str, only_months_present: bool = False) -> None:
    """Replaces the files, in one folder per year and month; rows without a date get a folder of their own.

    The rebalance gathers each month before the write, so a month is not written by every task, and Spark
    cuts a month with very many rows into several tasks at run time. ``only_months_present`` leaves the
    months that have no rows in ``df`` as they are.
    """
    gathered = df.hint("rebalance", *FACT_PARTITIONS)
    mode = "dynamic" if only_months_present else "static"
    gathered.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*FACT_PARTITIONS).parquet(path)


def ensure_database(spark: SparkSession, name: str, path: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`" + (f" LOCATION '{path}'" if path else ""))


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, as the file system that it is in names it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(there).toString().rstrip("/")


def ensure_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """Creates the table over the files if there is none; a table with other columns or files is an error, not ignored."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING PARQUET LOCATION '{path}'")
    wrong = mismatches(spark.table(name).schema, schema)
    if wrong:
        raise ValueError(f"table {name} exists with another schema: " + "; ".join(wrong))
    require_location(spark, name, path)
    spark.catalog.refreshTable(name)


def require_location(spark: SparkSession, name: str, path: str) -> None:
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    if _qualified(spark, location) != _qualified(spark, path):
        raise ValueError(f"table {name} exists over other files: {location}")


def replace_table(
    spark: SparkSession, name: str, schema: StructType, path: str, partitions: Sequence[str] = ()
) -> None:
    """Drops the table, not its files, and creates it over the files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING PARQUET {by} LOCATION '{path}'")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def refresh(df: DataFrame, database: str, name: str, schema: StructType, path: str) -> None:
    """Replaces the files of a table and creates the table if there is none."""
    write_files(require(df, schema, name), path)
    ensure_table(df.sparkSession, f"{database}.{name}", schema, path)


def write_dimension(df: DataFrame, name: str, path: str) -> None:
    write_files(require(df, GOLD[name], name), path)


def write_fact(df: DataFrame, name: str, path: str) -> None:
    write_by_month(require(with_months(df), GOLD[name], name), path)


def publish(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Points a table of the star schema at written files."""
    by = [field.name for field in GOLD[name] if field.name in FACT_PARTITIONS]
    replace_table(spark, f"{database}.{name}", GOLD[name], path, by)


def publish_dimension(df: DataFrame, database: str, name: str, path: str) -> None:
    write_dimension(df, name, path)
    publish(df.sparkSession, database, name, path)


def publish_fact(df: DataFrame, database: str, name: str, path: str) -> None:
    write_fact(df, name, path)
    publish(df.sparkSession, database, name, path)


def between_dates(fact: DataFrame, start: dt.date, end: dt.date, date: str = "order_date") -> DataFrame:
    """Rows with ``start <= date < end``, reading only the folders of those months; rows without a date are left out."""
    return fact.filter(in_months(start, end) & (F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(end)))
