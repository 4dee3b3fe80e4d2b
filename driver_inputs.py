"""Raw CRM and ERP extracts derived from the given tables, with every kind of defect the rules repair.

They also hold what makes joins and orders hard: customers that share a key, ERP keys and categories that repeat, dates
that tie, versions without a start or with the same one, and one product under two categories.

One SQL text per table serves Spark and, as a common table expression, DuckDB. The two differ only in how
a row is repeated for its versions.
"""

from pyspark.sql import DataFrame, SparkSession

from refinery.schemas import BRONZE

RAW_SQL = {
    "crm_cust_info": """
        SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey AS INT) END AS cst_id,
               CASE WHEN c_custkey % 23 = 0 THEN 'AW00000023' ELSE concat('AW', lpad(CAST(c_custkey AS STRING), 8, '0')) END AS cst_key,
               concat('  ', c_mktsegment) AS cst_firstname,
               concat(c_name, ' ') AS cst_lastname,
               CASE c_custkey % 4 WHEN 0 THEN ' s' WHEN 1 THEN 'M' WHEN 2 THEN NULL ELSE 'x' END AS cst_marital_status,
               CASE (c_custkey + v) % 5 WHEN 0 THEN 'f ' WHEN 1 THEN 'M' WHEN 2 THEN NULL ELSE 'U' END AS cst_gndr,
               CASE WHEN c_custkey % 41 = 0 AND v = 1 THEN NULL
                    WHEN c_custkey % 10 = 0 THEN DATE '2020-06-01'
                    ELSE DATE '2020-01-01' + CAST(c_custkey % 365 + v AS INT) END AS cst_create_date
        FROM (SELECT *, {versions} AS v FROM {customer}) t""",
    "crm_prd_info": """
        SELECT CAST(p_partkey * 3 + v AS INT) AS prd_id,
               concat(CASE WHEN p_partkey % 19 = 0 AND v = 1 THEN 'ZZ-00' ELSE concat(substr(p_type, 1, 2), '-', lpad(substr(p_brand, 7), 2, '0')) END,
                      '-P-', lpad(CAST(p_partkey AS STRING), 6, '0')) AS prd_key,
               p_name AS prd_nm,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) + CAST(v AS INT) END AS prd_cost,
               CASE p_partkey % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN 'S' WHEN 3 THEN 't' WHEN 4 THEN NULL
                    ELSE 'Z' END AS prd_line,
               CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 8 = 0 THEN CAST(DATE '2012-02-29' AS TIMESTAMP)
                    ELSE CAST(DATE '2011-07-01' + CAST(v * 365 AS INT) AS TIMESTAMP) END AS prd_start_dt,
               CAST(DATE '2007-01-01' AS TIMESTAMP) AS prd_end_dt
        FROM (SELECT *, {versions} AS v FROM {part}) t""",
    "crm_sales_details": """
        SELECT concat('SO', CAST(l_orderkey AS STRING)) AS sls_ord_num,
               concat('P-', lpad(CAST(l_partkey AS STRING), 6, CASE WHEN l_partkey % 89 = 0 THEN 'X' ELSE '0' END)) AS sls_prd_key,
               CAST(o_custkey AS INT) AS sls_cust_id,
               CASE WHEN l_orderkey % 101 = 0 THEN 0 WHEN l_orderkey % 103 = 0 THEN 32154 WHEN l_orderkey % 107 = 0 THEN 20241399
                    ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) END AS sls_order_dt,
               CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) AS sls_ship_dt,
               CASE WHEN l_orderkey % 109 = 0 THEN NULL
                    ELSE CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) END AS sls_due_dt,
               CASE l_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -5 WHEN 3 THEN 7
                    ELSE CAST(l_quantity AS INT) * CAST(floor(l_extendedprice / l_quantity) AS INT) END AS sls_sales,
               CASE WHEN l_orderkey % 113 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS sls_quantity,
               CASE l_orderkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -CAST(floor(l_extendedprice / l_quantity) AS INT)
                    ELSE CAST(floor(l_extendedprice / l_quantity) AS INT) END AS sls_price
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "erp_loc_a101": """
        SELECT concat(CASE WHEN c_custkey % 29 = 0 THEN 'XW-' ELSE 'AW-' END, lpad(CAST(c_custkey AS STRING), 8, '0')) AS cid,
               CASE c_custkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN ' US' WHEN 2 THEN 'USA' WHEN 3 THEN '' WHEN 4 THEN '   '
                    WHEN 5 THEN NULL WHEN 6 THEN 'France ' ELSE 'de' END AS cntry
        FROM {customer}
        UNION ALL
        SELECT concat('AW-', lpad(CAST(c_custkey AS STRING), 8, '0')), CASE WHEN c_custkey % 2 = 0 THEN 'DE' ELSE 'Peru' END
        FROM {customer} WHERE c_custkey % 37 = 0 OR c_custkey = 23""",
    "erp_cust_az12": """
        SELECT concat(CASE WHEN c_custkey % 31 = 0 THEN 'XW' WHEN c_custkey % 2 = 0 THEN 'NASAW' ELSE 'AW' END,
                      lpad(CAST(c_custkey AS STRING), 8, '0')) AS cid,
               CASE WHEN c_custkey % 53 = 0 THEN DATE '9999-01-01' WHEN c_custkey % 59 = 0 THEN NULL
                    ELSE DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) END AS bdate,
               CASE c_custkey % 6 WHEN 0 THEN ' f' WHEN 1 THEN 'Male ' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'm' WHEN 4 THEN NULL
                    ELSE '' END AS gen
        FROM {customer}
        UNION ALL
        SELECT concat('NASAW', lpad(CAST(c_custkey AS STRING), 8, '0')), DATE '1960-05-05', 'Female'
        FROM {customer} WHERE c_custkey % 43 = 0 OR c_custkey = 23""",
    "erp_px_cat_g1v2": """
        SELECT DISTINCT
               concat(substr(p_type, 1, 2), CASE WHEN CAST(substr(p_brand, 7) AS INT) % 7 = 0 THEN '-' ELSE '_' END,
                      lpad(substr(p_brand, 7), 2, '0')) AS id,
               p_type AS cat,
               p_brand AS subcat,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance
        FROM {part}
        UNION ALL
        SELECT DISTINCT concat('ZZ_', lpad(substr(p_brand, 7), 2, '0')), concat('Maker ', substr(p_brand, 7, 1)), p_brand, 'No' FROM {part}
        UNION ALL
        SELECT DISTINCT 'ZZ_00', concat('Maker ', substr(p_brand, 7, 1)), 'spare', 'Yes' FROM {part}""",
}
MORE_VERSIONS = {
    "crm_cust_info": "CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END",
    "crm_prd_info": "p_partkey % 3",
}
GIVEN = ["customer", "part", "orders", "lineitem"]


def raw_sql(name: str, repeat: str) -> str:
    """The text of a table, given tables in braces; ``repeat`` turns a number of further versions into one row each."""
    return RAW_SQL[name].replace("{versions}", repeat.format(MORE_VERSIONS.get(name)))


def duckdb_sql(name: str) -> str:
    text = raw_sql(name, "unnest(range(0, CAST({} AS INT) + 1))")
    for table in GIVEN:
        text = text.replace(f"{{{table}}}", table)
    return text


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Raw extracts by name; all six if none is named."""
    texts = {name: raw_sql(name, "explode(sequence(0, CAST({} AS INT)))") for name in names or RAW_SQL}
    tables = {table: given(spark, sf_dir, table) for table in GIVEN if any(f"{{{table}}}" in t for t in texts.values())}
    found = {}
    for name, text in texts.items():
        read = {table: df for table, df in tables.items() if f"{{{table}}}" in text}
        found[name] = spark.sql(text, **read).to(BRONZE[name])
    return found
