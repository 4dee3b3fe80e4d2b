"""Reports on keys that are unique by convention only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Each key held by more than one row, with its number of rows; keys that are NULL do not join and are left out."""
    whole = df.dropna(subset=list(key))
    return whole.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
