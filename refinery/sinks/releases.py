"""Tables that change over together: run folders, and one log whose newest row says which run is read.

A run writes each of its tables to a folder of its own (``<root>/<table>/run=<run>``); nothing that is published is touched.
Publishing appends one row to the log, a single file that is there or not. The tables are read by name through views that look
the run up in that log, so all of them change over at that moment, and a run that fails at any point before it is never seen.
"""

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery.schemas import BIGINT, STRING, TIMESTAMP, require, table
from refinery.sinks import tables

RUN = "run"
LOG = "releases"
LOG_SCHEMA = table(number=BIGINT, run=STRING, published=TIMESTAMP)
KEPT_RUNS = 2
GRACE = dt.timedelta(days=1)


def new_run() -> str:
    return f"{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S}-{uuid.uuid4().hex}"


def folder(root: str, name: str, run: str) -> str:
    return f"{root.rstrip('/')}/{name}/{RUN}={run}"


def _runs_of(name: str) -> str:
    return f"{name}_{RUN}s"


def _log(spark: SparkSession, database: str, root: str) -> DataFrame:
    tables.ensure_table(spark, f"{database}.{LOG}", LOG_SCHEMA, f"{root.rstrip('/')}/{LOG}")
    return spark.table(f"{database}.{LOG}")


def publish(
    spark: SparkSession, database: str, root: str, run: str, schemas: Mapping[str, StructType],
    partitions: Mapping[str, Sequence[str]] = {}, keep: int = KEPT_RUNS, grace: dt.timedelta = GRACE,
) -> None:
    """Makes the run's folders what the tables ``schemas`` of the database are read from, then removes runs that nobody needs.

    ``partitions`` names the columns by which a table's folder is cut further. A folder that is missing or has other columns
    is an error, and the run is not published. Of two runs published at the same moment the one with the larger name is read.
    Other sessions that have read the log before call ``refresh``.
    """
    tables.ensure_database(spark, database, root)
    for name, schema in schemas.items():
        by = list(partitions.get(name, ()))
        # Spark takes the columns that folders are named by from the table, whatever it finds in the files.
        require(spark.read.schema(schema).parquet(folder(root, name, run)), schema, name)
        _register(spark, f"{database}.{_runs_of(name)}", schema, f"{root.rstrip('/')}/{name}", run, by)
    log = _log(spark, database, root)
    number = (log.agg(F.max("number")).first()[0] or 0) + 1
    row = spark.createDataFrame([(number, run, dt.datetime.now())], LOG_SCHEMA)
    for name, schema in schemas.items():
        _read_by_name(spark, database, name, schema)
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{LOG}")
    refresh(spark, database, schemas)
    reclaim(spark, database, root, schemas, keep, grace)


def _register(spark: SparkSession, name: str, schema: StructType, path: str, run: str, by: Sequence[str]) -> None:
    """One table over all runs; a run is a partition of it, and those of its own below."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    parted = ", ".join([RUN, *by])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {RUN} STRING) USING PARQUET PARTITIONED BY ({parted}) LOCATION '{path}'")
    have = {field.name: field.dataType.simpleString() for field in spark.table(name).schema if field.name != RUN}
    wrong = have.items() ^ {field.name: field.dataType.simpleString() for field in schema}.items()
    if wrong:
        raise ValueError(f"table {name} exists with another schema: {sorted(column for column, _ in wrong)}")
    tables.require_location(spark, name, path)
    if by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({RUN}='{run}')")


def _read_by_name(spark: SparkSession, database: str, name: str, schema: StructType) -> None:
    columns = ", ".join(f"`{field.name}`" for field in schema)
    newest = f"SELECT max(struct(number, run)).run FROM {database}.{LOG}"
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {database}.{_runs_of(name)} WHERE {RUN} = ({newest})")


def refresh(spark: SparkSession, database: str, names: Mapping[str, object] | Sequence[str]) -> None:
    """Has this session look for new runs."""
    spark.catalog.refreshTable(f"{database}.{LOG}")
    for name in names:
        spark.catalog.refreshTable(f"{database}.{_runs_of(name)}")


def current(spark: SparkSession, database: str) -> str | None:
    """The run that is read now."""
    return spark.table(f"{database}.{LOG}").agg(F.max(F.struct("number", "run"))["run"]).first()[0]


def reclaim(
    spark: SparkSession, database: str, root: str, names: Mapping[str, object] | Sequence[str], keep: int = KEPT_RUNS, grace: dt.timedelta = GRACE
) -> list[str]:
    """Removes run folders and names those runs.

    Kept are the newest ``keep`` published runs, and every run, published or not, whose folder was last changed less than
    ``grace`` ago: a reader may still be at work in one, a writer in another. The run that is read is never removed.
    """
    ranked = spark.table(f"{database}.{LOG}").orderBy(F.desc("number"), F.desc("run")).limit(max(1, keep))
    kept = {row[RUN] for row in ranked.select(RUN).collect()}  # ``keep`` rows
    before = dt.datetime.now().timestamp() - grace.total_seconds()
    removed = set()
    for name in names:
        base = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
        files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.listStatus(base) if files.exists(base) else []:
            folder_name = status.getPath().getName()
            run = folder_name.removeprefix(f"{RUN}=")
            if run == folder_name or run in kept or status.getModificationTime() / 1000 > before:
                continue
            spark.sql(f"ALTER TABLE {database}.{_runs_of(name)} DROP IF EXISTS PARTITION ({RUN}='{run}')")
            files.delete(status.getPath(), True)
            removed.add(run)
    return sorted(removed)
