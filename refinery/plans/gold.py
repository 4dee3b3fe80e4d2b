"""The star schema: two dimensions and a fact, from clean tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.codes import first_known
from refinery.operators.ordering import ascending, dense_key
from refinery.operators.skew import LIMITS, Limits, left_join, small_tables


# Column of the star schema, and the clean column it holds.
CUSTOMER_COLUMNS = {
    "customer_id": "cst_id",
    "customer_number": "cst_key",
    "first_name": "cst_firstname",
    "last_name": "cst_lastname",
    "country": "cntry",
    "marital_status": "cst_marital_status",
    "gender": "known_gender",
    "birthdate": "bdate",
    "create_date": "cst_create_date",
}
PRODUCT_COLUMNS = {
    "product_id": "prd_id",
    "product_number": "prd_key",
    "product_name": "prd_nm",
    "category_id": "cat_id",
    "category": "cat",
    "subcategory": "subcat",
    "maintenance": "maintenance",
    "cost": "prd_cost",
    "product_line": "prd_line",
    "start_date": "prd_start_dt",
}
SALES_COLUMNS = {
    "order_number": "sls_ord_num",
    "product_key": "product_key",
    "customer_key": "customer_key",
    "order_date": "sls_order_dt",
    "shipping_date": "sls_ship_dt",
    "due_date": "sls_due_dt",
    "sales_amount": "sls_sales",
    "quantity": "sls_quantity",
    "price": "sls_price",
}


def _named(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(clean).alias(name) for name, clean in names.items()])


def customer_members(
    customers: DataFrame, demographics: DataFrame, locations: DataFrame, limits: Limits = LIMITS
) -> DataFrame:
    """Customers with what the ERP knows about them; a customer the ERP knows twice appears twice."""
    erp = {
        "demographics_cid": demographics.withColumnRenamed("cid", "demographics_cid"),
        "locations_cid": locations.withColumnRenamed("cid", "locations_cid"),
    }
    # cst_id is unique, so its hash cuts up any group of customers that share a key or have none.
    joined = left_join(customers, "cst_key", erp, F.xxhash64("cst_id"), limits)
    known_gender = first_known(F.col("cst_gndr"), F.col("gen"))
    return _named(joined.withColumn("known_gender", known_gender), CUSTOMER_COLUMNS)


def dim_customers(
    customers: DataFrame, demographics: DataFrame, locations: DataFrame, limits: Limits = LIMITS
) -> DataFrame:
    """``customer_members``, numbered anew in the order of ``customer_id``."""
    rows = customer_members(customers, demographics, locations, limits)
    return dense_key(rows, [F.col("customer_id").asc_nulls_first(), *ascending(rows, "customer_id")], "customer_key")


def product_members(versions: DataFrame, categories: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The open version of each product, with its category."""
    current = versions.filter(F.col("prd_end_dt").isNull())
    return _named(left_join(current, "cat_id", {"id": categories}, limits=limits), PRODUCT_COLUMNS)


def dim_products(versions: DataFrame, categories: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """``product_members``, numbered anew in the order of ``start_date`` and ``product_number``."""
    rows = product_members(versions, categories, limits)
    order = [F.col("start_date").asc_nulls_first(), F.col("product_number").asc_nulls_first()]
    return dense_key(rows, [*order, *ascending(rows, "start_date", "product_number")], "product_key")


def fact_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, limits: Limits = LIMITS
) -> DataFrame:
    """Every sale with the keys of its product and its customer, NULL where there is none.

    ``products`` and ``customers`` are the published dimensions: their keys are read, not numbered anew.
    """
    product_keys = products.select("product_number", "product_key")
    customer_keys = customers.select("customer_id", "customer_key")
    small = small_tables({"product_number": product_keys, "customer_id": customer_keys}, limits)
    keyed = left_join(sales, "sls_prd_key", {"product_number": product_keys}, limits=limits, small=small)
    keyed = left_join(keyed, "sls_cust_id", {"customer_id": customer_keys}, limits=limits, small=small)
    return _named(keyed, SALES_COLUMNS)
