"""Clean tables, one function per raw table."""

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import amounts, codes, dates, keys
from refinery.operators.ordering import close_versions, in_turn, latest_per_key
from refinery.operators.skew import LIMITS, Limits


def customers(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, "cst_id", "cst_create_date").withColumns({
        "cst_firstname": F.trim("cst_firstname"),
        "cst_lastname": F.trim("cst_lastname"),
        "cst_marital_status": codes.standard_code(F.col("cst_marital_status"), codes.MARITAL_STATUS),
        "cst_gndr": codes.standard_code(F.col("cst_gndr"), codes.CRM_GENDER),
    })


def products(raw: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Every version of every product, each ending the day before the next one of the same product starts."""
    full_key = F.col("prd_key")
    versions = raw.select(
        "prd_id",
        keys.category_of(full_key).alias("cat_id"),
        keys.product_of(full_key).alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        codes.standard_code(F.col("prd_line"), codes.PRODUCT_LINE).alias("prd_line"),
        "prd_start_dt",
    )
    ties = [F.col("prd_id").isNull(), F.col("prd_id"), *in_turn(versions, "prd_id", "prd_key", "prd_start_dt")]
    return close_versions(versions, "prd_key", "prd_start_dt", "prd_end_dt", ties, limits)


def sales(raw: DataFrame) -> DataFrame:
    amount, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    return raw.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *[dates.coded_date(F.col(day)).alias(day) for day in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        amounts.repaired_amount(amount, quantity, price).alias("sls_sales"),
        "sls_quantity",
        amounts.repaired_price(price, amount, quantity).alias("sls_price"),
    )


def locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        keys.without_hyphens(F.col("cid")).alias("cid"), codes.standard_country(F.col("cntry")).alias("cntry")
    )


def demographics(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return raw.select(
        keys.without_prefix(F.col("cid")).alias("cid"),
        dates.not_after(F.col("bdate"), as_of).alias("bdate"),
        codes.standard_code(F.col("gen"), codes.ERP_GENDER).alias("gen"),
    )


def categories(raw: DataFrame) -> DataFrame:
    """Taken over as they are."""
    return raw


def build(name: str, raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The clean table of that name from its raw table."""
    rules = {
        "crm_cust_info": customers,
        "crm_prd_info": products,
        "crm_sales_details": sales,
        "erp_loc_a101": locations,
        "erp_cust_az12": partial(demographics, as_of=as_of),
        "erp_px_cat_g1v2": categories,
    }
    return rules[name](raw)
