"""Steps written down in the folder that the cluster shares, so that a lost executor costs a step and not the job."""

import gc
import time
from collections.abc import Iterable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.operators.storage import new_folder


SECONDS_BETWEEN = 5.0
_collected = 0.0
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str, instead_of: Iterable[DataFrame] = ()) -> DataFrame:
    """The rows as a written table: worked out once, read again by every later step.

    ``instead_of`` are stored tables that nothing reads any more once this one is there; they are removed.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    # No mark that the table is whole: a failed step is no table here, and the driver starts a process for each file that it makes.
    df.write.options(compression="zstd", **{"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}).parquet(path)
    for old in instead_of:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(old))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    _forget(spark)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def _forget(spark: SparkSession) -> None:
    """Has the driver forget finished steps, every few seconds at most.

    Spark removes a step's shuffle files and broadcasts when the driver collects the step's plan as garbage. Jobs of many small
    steps leave that to chance: plans pile up in the driver's memory, and files on the executors' disks.
    """
    global _collected
    if time.monotonic() - _collected >= SECONDS_BETWEEN:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _collected = time.monotonic()


def whole_row(df: DataFrame) -> Column:
    """All columns of a row in one, out of the way of the names that an operator uses itself."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])


def key_of(*columns: Column) -> Column:
    """128 bits that stand for some values; a missing value is different from any other, in whichever place."""
    told = [part for column in columns for part in (column.isNull(), column)]
    return F.struct(F.xxhash64(*told).alias("k1"), F.xxhash64(F.lit(1), *told).alias("k2"))
