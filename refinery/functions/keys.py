"""Keys that have to meet across source systems."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape of a CRM product key, "CC-CC-product", and the prefix on some ERP customer keys.
CATEGORY_CHARS = 5
PRODUCT_FROM = 7
CUSTOMER_PREFIX = "NAS"


def category_of(product_key: Column) -> Column:
    return F.replace(F.substring(product_key, 1, CATEGORY_CHARS), F.lit("-"), F.lit("_"))


def product_of(product_key: Column) -> Column:
    return F.substr(product_key, F.lit(PRODUCT_FROM))


def without_hyphens(key: Column) -> Column:
    return F.replace(key, F.lit("-"), F.lit(""))


def without_prefix(key: Column, prefix: str = CUSTOMER_PREFIX) -> Column:
    return F.when(key.startswith(prefix), F.substr(key, F.lit(len(prefix) + 1))).otherwise(key)
