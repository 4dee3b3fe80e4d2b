"""Reports on the star schema. Averages are quotients of exact sums, so they do not depend on the order of rows."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.operators.asof import as_of_join
from refinery.operators.ordering import in_turn, with_neighbours
from refinery.operators.selection import rows_at
from refinery.operators.skew import LIMITS, Limits, left_join, small_tables
from refinery.operators.storage import pin

SCORES = 5


def _first_rows(total: int) -> list[int]:
    """Places (from 1) at which the second and later of ``SCORES`` equal groups of ``total`` rows begin, empty groups left out."""
    size, longer = divmod(total, SCORES)
    starts = [size * group + min(group, longer) + 1 for group in range(1, SCORES)]
    return [start for start in starts if start <= total]


def rfm_segments(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Recency, frequency and monetary value of each customer, each scored 1 (low) to 5 in equal groups.

    Groups are ordered by the value (missing first), then by ``customer_key``. A customer is compared with the rows at which a
    group begins, four per value, which are found without sorting (``selection.rows_at``).
    """
    customers = pin(
        fact.filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            F.datediff(F.lit(as_of), F.max("order_date")).alias("recency_days"),
            F.count_distinct("order_number").alias("frequency"),
            F.sum("sales_amount").alias("monetary"),
        )
    )
    # What a score orders by, small values first.
    values = {"recency_score": -F.col("recency_days"), "frequency_score": F.col("frequency"), "monetary_score": F.col("monetary")}
    values = {name: value.cast("bigint") for name, value in values.items()}
    borders = rows_at(customers, values, "customer_key", _first_rows(customers.count()))

    def score(name: str, value: Column) -> Column:
        behind = F.lit(1)
        for other, other_key in borders[name].values():
            behind = behind + _not_before(value, other, other_key).cast("int")
        return behind

    scored = customers.withColumns({name: score(name, value) for name, value in values.items()})
    return scored.withColumn("segment", F.concat_ws("-", *values))


def _not_before(value: Column, other: int | None, other_key: int) -> Column:
    """Whether a customer comes at or after the one with ``other`` and ``other_key``; a missing value comes first."""
    same_or_later = F.col("customer_key") >= other_key
    if other is None:
        return value.isNotNull() | same_or_later
    return F.coalesce((value > other) | ((value == other) & same_or_later), F.lit(False))


def price_history(versions: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Each version of each product: when it held, its cost, and the change from the version before."""
    order = [F.col("prd_start_dt"), F.col("prd_id").isNull(), F.col("prd_id"), *in_turn(versions, "prd_key", "prd_start_dt", "prd_id")]
    return with_neighbours(versions, "prd_key", order, {"previous_cost": ("prd_cost", -1)}, limits, by="prd_start_dt").select(
        F.col("prd_key").alias("product_number"),
        F.col("prd_id").alias("product_id"),
        F.col("prd_start_dt").alias("start_date"),
        F.col("prd_end_dt").alias("end_date"),
        F.col("prd_cost").alias("cost"),
        "previous_cost",
        (F.col("prd_cost").cast("bigint") - F.col("previous_cost")).alias("cost_change"),
    )


# Column of the report, and the column of the clean product versions that it holds.
VERSION_COLUMNS = {
    "product_id": "prd_id",
    "version_start": "prd_start_dt",
    "version_end": "prd_end_dt",
    "unit_cost": "prd_cost",
}


def sales_as_of_versions(sales: DataFrame, versions: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Every clean sale with the product version of its order day, what it cost then and what was earned.

    Of versions that begin on the same day the one with the largest ``prd_id`` counts; a sale without a product key or a day, or
    before the first version, has none. The star schema shows the open version instead.
    """
    needed = sales.select("sls_ord_num", "sls_prd_key", "sls_order_dt", "sls_quantity", "sls_sales")
    met = as_of_join(
        needed, ("sls_prd_key", "sls_order_dt"), versions, ("prd_key", "prd_start_dt"), VERSION_COLUMNS, ties=["prd_id"], limits=limits
    )
    cost = F.col("unit_cost").cast("bigint") * F.col("sls_quantity")
    return met.select(
        F.col("sls_ord_num").alias("order_number"),
        F.col("sls_prd_key").alias("product_number"),
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_sales").alias("sales_amount"),
        *VERSION_COLUMNS,
        cost.alias("cost"),
        (F.col("sls_sales") - cost).alias("margin"),
    )


def sales_kpis(fact: DataFrame, *by: str | Column) -> DataFrame:
    """Orders, lines, units, amount, average price and lines without a known product or customer, per group."""
    return (
        fact.groupBy(*by)
        .agg(
            F.count_distinct("order_number").alias("orders"),
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("units"),
            F.sum("sales_amount").alias("sales_amount"),
            F.count_if(F.col("product_key").isNull()).alias("lines_without_product"),
            F.count_if(F.col("customer_key").isNull()).alias("lines_without_customer"),
        )
        .withColumn("average_price", F.col("sales_amount") / F.nullif("units", F.lit(0)))
    )


def kpis_by_month(fact: DataFrame) -> DataFrame:
    return sales_kpis(fact, "year", "month")


def kpis_by_country(fact: DataFrame, customers: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    countries = customers.select(F.col("customer_key").alias("known_customer"), "country")
    return sales_kpis(left_join(fact, "customer_key", {"known_customer": countries}, limits=limits), "country")


def kpis_by_category(fact: DataFrame, products: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    categories = products.select(F.col("product_key").alias("known_product"), "category")
    return sales_kpis(left_join(fact, "product_key", {"known_product": categories}, limits=limits), "category")


# The groupings of the cube, and the columns each groups by.
CUBE = {"month": ["year", "month"], "country": ["country"], "category": ["category"], "all": []}
_SPREAD = 256  # parts of the lines without an order number


def kpis_cube(fact: DataFrame, products: DataFrame, customers: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The figures of ``sales_kpis`` by month, by country, by category and over all, in one pass over the fact.

    The lines of an order are moved to one task, once, and added up there by all the columns that any grouping uses; only these
    rows are copied for each grouping, and orders are counted exactly in each. ``grouped_by`` names the grouping, columns of
    others are NULL.
    """
    countries = customers.select(F.col("customer_key").alias("known_customer"), "country")
    categories = products.select(F.col("product_key").alias("known_product"), "category")
    small = small_tables({"known_customer": countries, "known_product": categories}, limits)
    named = left_join(fact, "customer_key", {"known_customer": countries}, limits=limits, small=small)
    named = left_join(named, "product_key", {"known_product": categories}, limits=limits, small=small)
    columns = [column for of in CUBE.values() for column in of]
    # All lines of an order meet in one shuffle, and what follows is done where they are; lines without an order number,
    # which no count of orders holds, are spread by a hash.
    by_hash = F.pmod(F.xxhash64("product_key", "customer_key", "quantity", "sales_amount"), F.lit(_SPREAD))
    unnamed = F.when(F.col("order_number").isNull(), by_hash.cast("int")).otherwise(0)
    lines = named.select(
        *columns, "order_number", unnamed.alias("_spread"), "quantity", "sales_amount",
        F.col("product_key").isNull().alias("_no_product"), F.col("customer_key").isNull().alias("_no_customer"),
    ).repartition("order_number", "_spread")
    added = lines.groupBy(*columns, "order_number", "_spread").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("sales_amount").alias("sales_amount"),
        F.count_if("_no_product").alias("lines_without_product"),
        F.count_if("_no_customer").alias("lines_without_customer"),
    )
    sums = ["lines", "units", "sales_amount", "lines_without_product", "lines_without_customer"]
    types = {column: added.schema[column].dataType for column in columns}
    groupings = [
        F.struct(F.lit(name).alias("grouped_by"), *[(F.col(c) if c in of else F.lit(None).cast(types[c])).alias(c) for c in columns])
        for name, of in CUBE.items()
    ]
    copied = added.select("order_number", "_spread", *sums, F.explode(F.array(*groupings)).alias("_of"))
    copied = copied.select("order_number", "_spread", *sums, "_of.*")
    orders = copied.groupBy("grouped_by", *columns, "order_number", "_spread").agg(*[F.sum(column).alias(column) for column in sums])
    grouped = orders.groupBy("grouped_by", *columns).agg(F.count("order_number").alias("orders"), *[F.sum(column).alias(column) for column in sums])
    average = (F.col("sales_amount") / F.nullif("units", F.lit(0))).alias("average_price")
    return grouped.select("grouped_by", *columns, "orders", *sums, average)
