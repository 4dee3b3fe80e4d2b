"""The three jobs, run in this order: ``land``, ``silver``, ``gold`` (``python -m refinery land --help``)."""

import argparse
import datetime as dt
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from refinery.plans import mart
from refinery.schemas import BRONZE, SILVER
from refinery.sources import catalog, delimited, relational


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="refinery", description=__doc__)
    parser.add_argument("--hive", action="store_true", help="keep the tables in the Hive catalog")
    jobs = parser.add_subparsers(dest="job", required=True)

    land = jobs.add_parser("land", help="copy the source tables to the raw folders")
    land.add_argument("--url", required=True, help="JDBC address of the source database")
    land.add_argument("--properties", type=Path, help="JSON file with user, password and driver options")
    land.add_argument("--ranges", type=Path, help='JSON file that cuts tables by ranges: {"crm_sales_details": {"column": "sls_ord_num", "bounds": [...]}}, or "columns" and "reads" to have even bounds found')
    land.add_argument("--raw", required=True, help="folder that holds one folder per raw table")
    land.add_argument("--format", default="parquet", choices=["csv", "parquet"])

    silver = jobs.add_parser("silver", help="clean the raw tables")
    silver.add_argument("--raw", required=True)
    silver.add_argument("--format", default="parquet", choices=["csv", "parquet"])
    silver.add_argument("--root", required=True, help="folder for the clean tables")
    silver.add_argument("--rejects", help="folder for the lines of text files that could not be read in full")
    silver.add_argument("--database", default="silver")
    silver.add_argument("--as-of", type=dt.date.fromisoformat, help="birth dates after this day are dropped (today)")

    gold = jobs.add_parser("gold", help="build the dimensions and the fact")
    gold.add_argument("--silver-database", default="silver")
    gold.add_argument("--root", required=True, help="folder for the star schema")
    gold.add_argument("--database", default="gold")
    gold.add_argument("--keep-keys", action="store_true", help="members keep the keys of earlier rebuilds, new ones are numbered after them")
    return parser.parse_args(argv)


def run(spark: SparkSession, chosen: argparse.Namespace) -> None:
    if chosen.job == "land":
        properties = json.loads(chosen.properties.read_text()) if chosen.properties else {}
        ranges = json.loads(chosen.ranges.read_text()) if chosen.ranges else {}
        sources = relational.with_ranges(relational.SOURCES, ranges)
        relational.land(spark, chosen.url, chosen.raw, properties, sources, chosen.format)
    elif chosen.job == "silver":
        if chosen.format == "csv":
            if chosen.rejects:
                delimited.write_rejects(spark, chosen.raw, chosen.rejects)
            raw = delimited.scan_bronze(spark, chosen.raw)
            for name, schema in BRONZE.items():
                _say(name, delimited.quality(spark, f"{chosen.raw}/{name}", schema))
        else:
            raw = {name: spark.read.schema(schema).parquet(f"{chosen.raw}/{name}") for name, schema in BRONZE.items()}
        mart.refresh_silver(spark, raw, chosen.root, chosen.database, chosen.as_of)
        _say("keys", mart.repeated(catalog.read(spark, chosen.database, SILVER)))
    else:
        mart.refresh_gold(spark, chosen.silver_database, chosen.root, chosen.database, chosen.keep_keys)


def _say(what: str, counts: DataFrame) -> None:
    """Prints a few rows of counts, a line each."""
    for row in counts.collect():
        print(what, json.dumps(row.asDict()))


def main() -> None:
    chosen = arguments()
    builder = SparkSession.builder.appName(f"refinery {chosen.job}")
    run((builder.enableHiveSupport() if chosen.hive else builder).getOrCreate(), chosen)


if __name__ == "__main__":
    main()
