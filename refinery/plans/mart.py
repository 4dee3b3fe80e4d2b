"""The two rebuilds, run one after the other: raw files -> clean tables, clean tables -> star schema."""

import datetime as dt
from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.operators import register
from refinery.operators.checks import repeated_keys
from refinery.plans import gold, silver
from refinery.plans.together import together
from refinery.schemas import FACT_PARTITIONS, GOLD, REGISTERS, SILVER, require
from refinery.sinks import releases, tables
from refinery.sources import catalog

KEYS = {
    "crm_cust_info": ["cst_id"],
    "crm_prd_info": ["prd_key", "prd_start_dt"],
    "crm_sales_details": ["sls_ord_num", "sls_prd_key"],
    "erp_loc_a101": ["cid"],
    "erp_cust_az12": ["cid"],
    "erp_px_cat_g1v2": ["id"],
}


def refresh_silver(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, database: str = "silver", as_of: dt.date | None = None
) -> None:
    """Cleans all six tables into folders of one run and has their names change over to it together.

    A run that fails leaves the tables as they were; ``releases`` says which older runs are removed.
    """
    run = releases.new_run()

    def write(name: str) -> None:
        rows = require(silver.build(name, raw[name], as_of), SILVER[name], name)
        tables.write_files(rows, releases.folder(root, name, run))

    together(spark, [partial(write, name) for name in SILVER])
    releases.publish(spark, database, root, run, SILVER)


def repeated(clean: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name``, ``repeated_keys`` and the ``rows_of_them`` of each clean table whose key should be unique."""
    def summary(name: str) -> DataFrame:
        found = repeated_keys(clean[name], *KEYS[name])
        return found.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_of_them")
        )

    return reduce(DataFrame.unionByName, map(summary, KEYS))


def refresh_gold(spark: SparkSession, silver_database: str, root: str, database: str = "gold", keep_keys: bool = False) -> None:
    """The fact comes last and reads the dimensions just written, so their keys always agree.

    All three are written to folders of this run and change over together (see ``releases``): readers see either all tables of
    the run before or all of this one. A run that fails leaves the published ones as they were.

    ``keep_keys`` numbers new members after those of earlier rebuilds, whose keys stay (see ``register``); the registers change
    over with the tables. Otherwise all members are numbered anew.
    """
    clean = catalog.read(spark, silver_database, SILVER)
    run = releases.new_run()
    schemas = GOLD | REGISTERS if keep_keys else GOLD
    paths = {name: releases.folder(root, name, run) for name in schemas}

    def customers() -> None:
        sources = clean["crm_cust_info"], clean["erp_cust_az12"], clean["erp_loc_a101"]
        rows = kept(gold.customer_members(*sources), "customer_keys") if keep_keys else gold.dim_customers(*sources)
        tables.write_dimension(rows, "dim_customers", paths["dim_customers"])

    def products() -> None:
        sources = clean["crm_prd_info"], clean["erp_px_cat_g1v2"]
        rows = kept(gold.product_members(*sources), "product_keys") if keep_keys else gold.dim_products(*sources)
        tables.write_dimension(rows, "dim_products", paths["dim_products"])

    def kept(members: DataFrame, name: str) -> DataFrame:
        natural, _, key = REGISTERS[name].names
        old = spark.table(f"{database}.{name}") if spark.catalog.tableExists(f"{database}.{name}") else None
        tables.write_files(require(register.grown(members, [natural], key, old), REGISTERS[name], name), paths[name])
        return register.keyed(members, [natural], key, spark.read.schema(REGISTERS[name]).parquet(paths[name]))

    together(spark, [customers, products])
    written = {name: spark.read.schema(GOLD[name]).parquet(paths[name]) for name in ("dim_customers", "dim_products")}
    fact = gold.fact_sales(clean["crm_sales_details"], written["dim_products"], written["dim_customers"])
    tables.write_fact(fact, "fact_sales", paths["fact_sales"])
    releases.publish(spark, database, root, run, schemas, {"fact_sales": FACT_PARTITIONS})
