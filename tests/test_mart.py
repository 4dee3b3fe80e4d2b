"""The layers from raw rows to reports, on a small made-up shop and on hot keys."""

import datetime as dt
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from refinery.__main__ import arguments, run
from refinery.operators.skew import Limits
from refinery.plans import gold, mart, reports, silver
from refinery.plans.together import together
from refinery.schemas import BRONZE, GOLD, SILVER, mismatches
from refinery.sinks import tables
from refinery.sources import delimited

D = dt.date
AS_OF = D(2025, 1, 1)
RAW = {
    "crm_cust_info": [
        (2, "AW2", " Ann ", "Lee ", "s", "f", D(2024, 1, 1)),
        (1, "AW1", "Old", "Name", "M", "M", D(2023, 1, 1)),
        (1, "AW1", "New", "Name", "M", None, D(2024, 1, 1)),
        (3, None, "No", "Key", None, "x", None),
        (None, "AW9", "No", "Id", "S", "F", D(2024, 1, 1)),
    ],
    "crm_prd_info": [
        (10, "AC-HE-P-1", "Helmet", None, "m", dt.datetime(2011, 7, 1), dt.datetime(2007, 1, 1)),
        (11, "AC-HE-P-1", "Helmet", 12, "m", dt.datetime(2012, 7, 1), None),
        (12, "ZZ-NO-P-2", "Thing", 5, None, dt.datetime(2011, 7, 1), None),
    ],
    "crm_sales_details": [
        ("SO1", "P-1", 1, 20240105, 20240107, 20240110, 24, 2, 12),
        ("SO1", "P-2", 1, 20240105, 20240107, 20240110, None, 3, -5),
        ("SO2", "P-9", 2, 0, 20240207, None, 10, 1, 10),
        ("SO3", "P-1", 99, 20240301, 20240302, 20240303, 12, 1, None),
        ("SO4", None, None, 20240301, 20240302, 20240303, 12, 1, 12),
    ],
    "erp_loc_a101": [("AW-1", "DE"), ("AW-2", " ")],
    "erp_cust_az12": [("NASAW1", D(1980, 1, 1), "Female"), ("AW2", D(2030, 1, 1), "Male")],
    "erp_px_cat_g1v2": [("AC_HE", "Accessories", "Helmets", "Yes")],
}


@pytest.fixture(scope="module")
def raw(spark):
    return {name: spark.createDataFrame(values, BRONZE[name]) for name, values in RAW.items()}


@pytest.fixture(scope="module")
def gold_database(spark, raw, tmp_path_factory):
    root = tmp_path_factory.mktemp("mart")
    for _ in range(2):  # a second rebuild replaces the first
        mart.refresh_silver(spark, raw, f"{root}/silver", "mart_silver", AS_OF)
        mart.refresh_gold(spark, "mart_silver", f"{root}/gold", "mart_gold")
    return "mart_gold"


def test_layers_have_the_declared_schemas(spark, raw, gold_database):
    for name, df in raw.items():
        assert not mismatches(silver.build(name, df, AS_OF).schema, SILVER[name])
    for name, schema in GOLD.items():
        assert not mismatches(spark.table(f"{gold_database}.{name}").schema, schema)


def test_dim_customers(spark, gold_database):
    assert rows(spark.table(f"{gold_database}.dim_customers")) == [
        (1, "AW1", "New", "Name", "Germany", "Married", "Female", D(1980, 1, 1), D(2024, 1, 1), 1),
        (2, "AW2", "Ann", "Lee", "n/a", "Single", "Female", None, D(2024, 1, 1), 2),
        (3, None, "No", "Key", None, "n/a", "n/a", None, None, 3),
    ]


def test_dim_products_holds_open_versions_only(spark, gold_database):
    assert rows(spark.table(f"{gold_database}.dim_products")) == [
        (11, "P-1", "Helmet", "AC_HE", "Accessories", "Helmets", "Yes", 12, "Mountain", D(2012, 7, 1), 2),
        (12, "P-2", "Thing", "ZZ_NO", None, None, None, 5, "n/a", D(2011, 7, 1), 1),
    ]


def test_fact_keeps_every_sale(spark, gold_database):
    columns = ["order_number", "product_key", "customer_key", "order_date", "sales_amount", "quantity", "price", "year", "month"]
    assert Counter(rows(spark.table(f"{gold_database}.fact_sales"), *columns)) == Counter([
        ("SO1", 2, 1, D(2024, 1, 5), 24, 2, 12.0, 2024, 1),
        ("SO1", 1, 1, D(2024, 1, 5), 15, 3, None, 2024, 1),
        ("SO2", None, 2, None, 10, 1, 10.0, None, None),
        ("SO3", 2, None, D(2024, 3, 1), 12, 1, 12.0, 2024, 3),
        ("SO4", None, None, D(2024, 3, 1), 12, 1, 12.0, 2024, 3),
    ])


def test_price_history(spark, raw):
    assert rows(reports.price_history(silver.products(raw["crm_prd_info"]))) == [
        ("P-1", 10, D(2011, 7, 1), D(2012, 6, 30), 0, None, None),
        ("P-1", 11, D(2012, 7, 1), None, 12, 0, 12),
        ("P-2", 12, D(2011, 7, 1), None, 5, None, None),
    ]


def test_kpis(spark, gold_database):
    fact, customers, products = (spark.table(f"{gold_database}.{name}") for name in ("fact_sales", "dim_customers", "dim_products"))
    columns = ["orders", "lines", "units", "sales_amount", "lines_without_product", "lines_without_customer", "average_price"]
    by_month = {(r.year, r.month): tuple(r[c] for c in columns) for r in reports.kpis_by_month(fact).collect()}
    assert by_month == {
        (2024, 1): (1, 2, 5, 39, 0, 0, 7.8),
        (None, None): (1, 1, 1, 10, 1, 0, 10.0),
        (2024, 3): (2, 2, 2, 24, 1, 2, 12.0),
    }
    assert {r.country: r.sales_amount for r in reports.kpis_by_country(fact, customers).collect()} == {
        "Germany": 39, "n/a": 10, None: 24}
    assert {r.category: r.lines for r in reports.kpis_by_category(fact, products).collect()} == {
        "Accessories": 2, None: 3}


@pytest.mark.parametrize("sales", [0, 3, 300])
def test_rfm_scores_are_ntiles(spark, sales):
    i = F.col("id")
    fact = spark.range(sales).select(
        F.concat(F.lit("SO"), (i % 170).cast("string")).alias("order_number"),
        F.when(i % 10 > 0, i % 23).alias("customer_key"),
        F.when(i % 7 > 0, F.date_add(F.lit(D(2020, 1, 1)), (i % 90).cast("int"))).alias("order_date"),
        (i % 40).cast("int").alias("sales_amount"),
    )
    base = fact.filter("customer_key IS NOT NULL").groupBy("customer_key").agg(
        F.datediff(F.lit(AS_OF), F.max("order_date")).alias("r"), F.count_distinct("order_number").alias("f"), F.sum("sales_amount").alias("m"))
    orders = {"r": F.col("r").desc_nulls_first(), "f": F.col("f"), "m": F.col("m")}
    for name, order in orders.items():
        base = base.withColumn(f"s{name}", F.ntile(5).over(Window.orderBy(order, "customer_key")))
    expected = base.withColumn("segment", F.concat_ws("-", "sr", "sf", "sm"))
    assert rows(reports.rfm_segments(fact, AS_OF)) == rows(expected)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 10])
def test_dimensions_and_fact_with_hot_keys(spark, tmp_path, rows_per_task):
    """A third of the customers share a key, a third of the ERP rows are copies, a third of the sales are one customer's."""
    i = F.col("id")

    def stored(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    key = F.when(i % 3 == 0, "AW0").when(i % 11 == 0, None).otherwise(F.concat(F.lit("AW"), i.cast("string")))
    customers = stored("c", spark.range(60).select(
        i.cast("int").alias("cst_id"), key.alias("cst_key"), F.lit("a").alias("cst_firstname"), F.lit("b").alias("cst_lastname"),
        F.lit("n/a").alias("cst_marital_status"), F.lit("n/a").alias("cst_gndr"), F.lit(AS_OF).alias("cst_create_date")))
    erp_key = F.when(i % 3 == 0, "AW0").when(i % 13 == 0, None).otherwise(F.concat(F.lit("AW"), (i % 40).cast("string")))
    demographics = stored("d", spark.range(0, 45, 1, 4).select(erp_key.alias("cid"), F.lit(AS_OF).alias("bdate"), F.lit("Male").alias("gen")))
    locations = stored("l", spark.range(0, 30, 1, 4).select(
        F.when(i % 3 == 0, "AW1").otherwise(F.concat(F.lit("AW"), (i % 25).cast("string"))).alias("cid"), (i % 4).cast("string").alias("cntry")))
    dim = gold.dim_customers(customers, demographics, locations, Limits(rows_per_task, 0))
    plain = customers.alias("c").join(demographics.alias("d"), F.col("c.cst_key") == F.col("d.cid"), "left") \
        .join(locations.alias("l"), F.col("c.cst_key") == F.col("l.cid"), "left")
    assert rows(dim.select("customer_id", "birthdate", "country")) == rows(plain.select("c.cst_id", "d.bdate", "l.cntry"))
    n = dim.count()
    assert n > 300 and rows(dim.select("customer_key")) == sorted([(k,) for k in range(1, n + 1)], key=lambda r: str(r[0]))

    products = spark.range(20).select(F.concat(F.lit("P"), (i % 15).cast("string")).alias("product_number"), i.alias("product_key"))
    keys = stored("k", spark.range(50).select((i % 40).cast("int").alias("customer_id"), i.alias("customer_key")))
    sales = spark.range(0, 300, 1, 4).select(
        i.cast("string").alias("sls_ord_num"), F.concat(F.lit("P"), (i % 17).cast("string")).alias("sls_prd_key"),
        F.when(i % 3 == 0, 1).when(i % 5 == 0, None).otherwise(i % 45).cast("int").alias("sls_cust_id"),
        *[F.lit(AS_OF).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        F.lit(1).alias("sls_sales"), F.lit(1).alias("sls_quantity"), F.lit(1.0).alias("sls_price"))
    products = stored("p", products)
    fact = gold.fact_sales(sales, products, keys, Limits(rows_per_task, 0))
    expected = sales.join(products, F.col("sls_prd_key") == F.col("product_number"), "left") \
        .join(keys, F.col("sls_cust_id") == F.col("customer_id"), "left")
    assert rows(fact, "order_number", "product_key", "customer_key") == rows(expected, "sls_ord_num", "product_key", "customer_key")


def test_versions_of_a_hot_product(spark):
    i = F.col("id")
    versions = spark.range(0, 900, 1, 4).select(
        i.cast("int").alias("prd_id"), F.when(i % 3 == 0, "AC-HE-P-0").otherwise(F.concat(F.lit("AC-HE-P-"), (i % 50).cast("string"))).alias("prd_key"),
        F.lit("n").alias("prd_nm"), i.cast("int").alias("prd_cost"), F.lit("m").alias("prd_line"),
        F.when(i % 4 > 0, F.timestamp_seconds(i % 30 * 40_000)).alias("prd_start_dt"))
    limits = Limits(), Limits(20)
    near = [rows(reports.price_history(silver.products(versions, limit), limit)) for limit in limits]
    assert near[0] == near[1]


def test_fact_scan_reads_only_the_columns_asked_for(spark, gold_database, plan):
    text = plan(reports.kpis_by_month(spark.table(f"{gold_database}.fact_sales")))
    schema = text[text.index("ReadSchema"):].splitlines()[0]
    assert "price:" not in schema and "due_date" not in schema


def test_open_version_filter_reaches_the_scan(spark, gold_database):
    versions = spark.table("mart_silver.crm_prd_info")
    text = versions.filter(F.col("prd_end_dt").isNull())._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(prd_end_dt)]" in text
    assert tables.with_months(spark.createDataFrame([(None,)], "order_date date")).first().year is None


def test_a_failed_rebuild_leaves_the_published_mart(spark, raw, gold_database, tmp_path, monkeypatch):
    before = {name: rows(spark.table(f"{gold_database}.{name}")) for name in GOLD}
    fewer = raw | {"crm_cust_info": raw["crm_cust_info"].filter("cst_id = 2")}
    mart.refresh_silver(spark, fewer, f"{tmp_path}/silver", "mart_fewer", AS_OF)

    def fails(*_):
        raise ValueError("no")

    root = str(tmp_path / "gold")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_fact", fails)
        with pytest.raises(ValueError, match="no"):
            mart.refresh_gold(spark, "mart_fewer", root, gold_database)
    assert {name: rows(spark.table(f"{gold_database}.{name}")) for name in GOLD} == before


def test_repeated_keys_of_the_clean_tables(spark, raw):
    twice = raw | {"erp_loc_a101": raw["erp_loc_a101"].union(raw["erp_loc_a101"])}
    clean = {name: silver.build(name, df, AS_OF) for name, df in twice.items()}
    found = {row.table_name: (row.repeated_keys, row.rows_of_them) for row in mart.repeated(clean).collect()}
    assert found == {name: (2, 4) if name == "erp_loc_a101" else (0, 0) for name in SILVER}


def test_jobs_from_the_command_line(spark, raw, tmp_path, capsys):
    for name, df in raw.items():
        delimited.write(df, f"{tmp_path}/raw/{name}")
        df.write.parquet(f"{tmp_path}/raw_parquet/{name}")
    found = []
    for kind, folder in (("csv", "raw"), ("parquet", "raw_parquet")):
        run(spark, arguments(["silver", "--raw", f"{tmp_path}/{folder}", "--format", kind, "--root", f"{tmp_path}/{kind}/silver",
                              "--database", f"job_silver_{kind}", "--as-of", "2025-01-01"]))
        run(spark, arguments(["gold", "--silver-database", f"job_silver_{kind}", "--root", f"{tmp_path}/{kind}/gold",
                              "--database", f"job_gold_{kind}"]))
        found.append([rows(spark.table(f"job_gold_{kind}.{name}")) for name in GOLD])
    assert found[0] == found[1]
    assert [len(table) for table in found[0]] == [3, 2, 5]
    said = capsys.readouterr().out
    assert 'crm_sales_details {"lines_read": 5, "lines_rejected": 0' in said
    assert 'keys {"table_name": "erp_loc_a101", "repeated_keys": 0, "rows_of_them": 0}' in said


def test_steps_run_together_and_report_failure(spark):
    assert together(spark, [lambda n=n: spark.range(n).count() for n in range(4)]) == [0, 1, 2, 3]
    done = []

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        together(spark, [fails, lambda: done.append(spark.range(3).count())])
    assert done == [3]
