"""Column names and types of every table; one definition feeds the readers, the DDL and the checks."""

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

INT, BIGINT, DOUBLE = IntegerType(), LongType(), DoubleType()
STRING, DATE, TIMESTAMP = StringType(), DateType(), TimestampType()


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# Names, order and types are the contract with the source systems and the readers.
BRONZE = {
    "crm_cust_info": table(
        cst_id=INT, cst_key=STRING, cst_firstname=STRING, cst_lastname=STRING,
        cst_marital_status=STRING, cst_gndr=STRING, cst_create_date=DATE,
    ),
    "crm_prd_info": table(
        prd_id=INT, prd_key=STRING, prd_nm=STRING, prd_cost=INT, prd_line=STRING,
        prd_start_dt=TIMESTAMP, prd_end_dt=TIMESTAMP,
    ),
    "crm_sales_details": table(
        sls_ord_num=STRING, sls_prd_key=STRING, sls_cust_id=INT, sls_order_dt=INT, sls_ship_dt=INT,
        sls_due_dt=INT, sls_sales=INT, sls_quantity=INT, sls_price=INT,
    ),
    "erp_loc_a101": table(cid=STRING, cntry=STRING),
    "erp_cust_az12": table(cid=STRING, bdate=DATE, gen=STRING),
    "erp_px_cat_g1v2": table(id=STRING, cat=STRING, subcat=STRING, maintenance=STRING),
}

SILVER = BRONZE | {
    "crm_prd_info": table(
        prd_id=INT, cat_id=STRING, prd_key=STRING, prd_nm=STRING, prd_cost=INT, prd_line=STRING,
        prd_start_dt=DATE, prd_end_dt=DATE,
    ),
    "crm_sales_details": table(
        sls_ord_num=STRING, sls_prd_key=STRING, sls_cust_id=INT, sls_order_dt=DATE, sls_ship_dt=DATE,
        sls_due_dt=DATE, sls_sales=INT, sls_quantity=INT, sls_price=DOUBLE,
    ),
}

GOLD = {
    "dim_customers": table(
        customer_id=INT, customer_number=STRING, first_name=STRING, last_name=STRING, country=STRING,
        marital_status=STRING, gender=STRING, birthdate=DATE, create_date=DATE, customer_key=BIGINT,
    ),
    "dim_products": table(
        product_id=INT, product_number=STRING, product_name=STRING, category_id=STRING, category=STRING,
        subcategory=STRING, maintenance=STRING, cost=INT, product_line=STRING, start_date=DATE,
        product_key=BIGINT,
    ),
    "fact_sales": table(
        order_number=STRING, product_key=BIGINT, customer_key=BIGINT, order_date=DATE, shipping_date=DATE,
        due_date=DATE, sales_amount=INT, quantity=INT, price=DOUBLE, year=INT, month=INT,
    ),
}
# Registers of keys that members keep: the natural key, the number of the member among those that share it, and the key.
REGISTERS = {
    "customer_keys": table(customer_id=INT, copy=INT, customer_key=BIGINT),
    "product_keys": table(product_number=STRING, copy=INT, product_key=BIGINT),
}
FACT_PARTITIONS = ["year", "month"]


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def mismatches(actual: StructType, declared: StructType) -> list[str]:
    """Differences in name, order or type, as readable lines; empty if the two agree."""
    have = [(f.name, f.dataType.simpleString()) for f in actual]
    want = [(f.name, f.dataType.simpleString()) for f in declared]
    lines = [f"{w[0]}: declared {w[1]}, found {h[0]} {h[1]}" for h, w in zip(have, want) if h != w]
    lines += [f"{name}: declared {kind}, missing" for name, kind in want[len(have):]]
    return lines + [f"{name} {kind}: not declared" for name, kind in have[len(want):]]


def require(df: DataFrame, declared: StructType, name: str) -> DataFrame:
    """The same DataFrame, or an error if its columns are not the declared ones."""
    wrong = mismatches(df.schema, declared)
    if wrong:
        raise ValueError(f"{name} does not fit its declared schema: " + "; ".join(wrong))
    return df
