"""Delimited scan, table reads over JDBC (without a database) and reads by name."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from refinery.schemas import BRONZE, DATE, INT, STRING, mismatches, table
from refinery.sources import catalog, delimited, relational

SCHEMA = table(i=INT, t=STRING, d=DATE)
LINES = """null,null,null
3,,
5,  x  ,2024-01-02 00:00:00.0
7,   ,2024-01-05
abc,z,2024-01-04,extra
4,"",2024-13-45
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "part-0").write_text(LINES)
    return str(tmp_path)


def test_scan_rule_table(spark, folder):
    found = {(row.i, row.t, row.d) for row in delimited.scan(spark, folder, SCHEMA).collect()}
    assert found == {
        (None, None, None),
        (3, None, None),
        (5, "  x  ", dt.date(2024, 1, 2)),
        (7, "   ", dt.date(2024, 1, 5)),
        (None, "z", dt.date(2024, 1, 4)),
        (4, "", None),
    }


def test_scan_can_keep_the_word_null(spark, folder):
    found = delimited.scan(spark, folder, SCHEMA, null_text=None)
    assert found.filter("t = 'null'").count() == 1


def test_rejected_lines_are_counted_and_kept(spark, folder):
    assert tuple(delimited.quality(spark, folder, SCHEMA).first()) == (6, 2, 2, 2, 3)
    kept = delimited.scan(spark, folder, SCHEMA, keep_rejected=True)
    kept = kept.filter(F.col(delimited.REJECTED).isNotNull()).select("d", delimited.REJECTED)
    assert {row[1] for row in kept.collect()} == {"abc,z,2024-01-04,extra", '4,"",2024-13-45'}


def test_written_files_scan_to_the_same_rows(spark, tmp_path):
    values = [(1, " a,b ", dt.date(2024, 1, 1)), (None, None, None), (2, 'say "x"', None), (3, "", dt.date(1900, 1, 1))]
    df = spark.createDataFrame(values, SCHEMA)
    delimited.write(df, f"{tmp_path}/t")
    assert rows(delimited.scan(spark, f"{tmp_path}/t", SCHEMA)) == rows(df)


@pytest.mark.parametrize("digits", [1, 2])
def test_last_digit_conditions_take_each_row_once(spark, digits):
    keys = [f"AW{n:05d}" for n in range(120)] + [None, "", "x", "9", "a%", "SO1x"]
    df = spark.createDataFrame([(key,) for key in keys], "cid string")
    conditions = relational.last_digit_conditions("cid", digits)
    assert len(conditions) == 10**digits + 1
    times = sum(F.when(F.expr(condition), 1).otherwise(0) for condition in conditions)
    assert df.select(times.alias("n")).filter("n <> 1").isEmpty()


class Reader:
    """Stands in for ``spark.read``: notes the call, answers from a table."""

    def __init__(self, answers):
        self.answers, self.calls = answers, []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self.answers(table)


class Session:
    def __init__(self, answers):
        self.read = Reader(answers)


def test_read_cuts_a_numeric_column_between_its_bounds(spark):
    session = Session(lambda text: spark.sql("SELECT 5 AS lo, 95 AS hi") if "MIN(" in text else spark.range(3))
    source = relational.Source("SELECT * FROM crm.prd_info", split_on="prd_id", reads=4)
    relational.read(session, "jdbc:x", source, {"user": "u"})
    (_, bounds, _), (url, text, options) = session.read.calls
    assert url == "jdbc:x" and text == "(SELECT * FROM crm.prd_info) t" and text in bounds
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("prd_id", "5", "95", 4)
    assert options["properties"] == {"fetchsize": "10000", "user": "u"}


def test_read_of_an_empty_table_asks_for_no_ranges(spark):
    session = Session(lambda text: spark.sql("SELECT CAST(NULL AS INT) AS lo, CAST(NULL AS INT) AS hi"))
    relational.read(session, "jdbc:x", relational.Source("q", split_on="a", reads=4), {})
    assert "column" not in session.read.calls[-1][2]


def test_read_passes_conditions(spark):
    session = Session(lambda text: spark.range(1))
    relational.read(session, "jdbc:x", relational.SOURCES["erp_loc_a101"], {})
    assert len(session.read.calls[0][2]["predicates"]) == 11


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_land_replaces_every_raw_table(spark, tmp_path, file_format):
    def answer(text):
        name = next(name for name in BRONZE if name.split("_", 1)[1] in text)
        # wider types than declared, as a database may have them
        row = {f.name: F.lit(None if f.name.endswith("dt") else 7).cast("bigint" if f.dataType == INT else f.dataType)
               for f in BRONZE[name] if f.dataType.typeName() not in ("date", "timestamp")}
        times = {f.name: F.lit(dt.datetime(2024, 1, 2)).cast(f.dataType) for f in BRONZE[name] if f.name not in row}
        return spark.range(2).select(*[value.alias(key) for key, value in (times | row).items()])

    for _ in range(2):
        relational.land(Landing(spark, answer), "jdbc:x", str(tmp_path), {}, file_format=file_format)
    for name, schema in BRONZE.items():
        if file_format == "csv":
            landed = delimited.scan(spark, f"{tmp_path}/{name}", schema)
        else:
            landed = spark.read.parquet(f"{tmp_path}/{name}")
        assert landed.count() == 2 and not mismatches(landed.schema, schema)


class Landing(Session):
    def __init__(self, spark, answers):
        super().__init__(answers)
        self.spark = spark


def test_all_six_tables_have_a_source():
    assert relational.SOURCES.keys() == BRONZE.keys()
    assert all(source.query.startswith("SELECT * FROM ") for source in relational.SOURCES.values())


def test_catalog_read_checks_the_schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sources_test")
    spark.range(1).write.mode("overwrite").saveAsTable("sources_test.t")
    with pytest.raises(ValueError, match="id: declared int, found id bigint"):
        catalog.read(spark, "sources_test", {"t": table(id=INT)})


def test_views_answer_sql(spark):
    catalog.register_views({"t": spark.range(3)}, prefix="bronze_")
    assert spark.sql("SELECT sum(id) FROM bronze_t").first()[0] == 3


ODD_TEXTS = [(1, "a\nb"), (2, "null"), (3, "ok"), (4, "c\r\nd"), (5, 'q"u,o\\te'), (6, ""), (7, " x ")]


def test_landing_keeps_every_value(spark, tmp_path):
    rows = spark.createDataFrame([(i, t, None, None) for i, t in ODD_TEXTS], BRONZE["erp_px_cat_g1v2"].simpleString().replace("id:string", "id:int")[7:-1])
    relational.land(Landing(spark, lambda text: rows), "jdbc:x", str(tmp_path), {}, {"erp_px_cat_g1v2": relational.SOURCES["erp_px_cat_g1v2"]})
    assert {(int(row[0]), row[1]) for row in spark.read.parquet(f"{tmp_path}/erp_px_cat_g1v2").collect()} == set(ODD_TEXTS)


@pytest.mark.parametrize("text", ["a\nb", "null", "c\rd"])
def test_lines_that_would_not_come_back_are_refused(spark, tmp_path, text):
    with pytest.raises(Exception, match="line break"):
        delimited.write(spark.createDataFrame([(1, text)], "i int, t string"), str(tmp_path / "t"))


def test_other_texts_come_back(spark, tmp_path):
    rows = spark.createDataFrame([row for row in ODD_TEXTS if row[0] in (3, 5, 6, 7)], "i int, t string")
    delimited.write(rows, str(tmp_path / "t"))
    assert {tuple(row) for row in delimited.scan(spark, str(tmp_path / "t"), rows.schema).collect()} == {tuple(row) for row in rows.collect()}


@pytest.mark.parametrize("column, bounds", [("k", ["b", "d'e", "m"]), ("n", [0, 10]), ("n", [5])])
def test_each_row_meets_one_range(spark, column, bounds):
    df = spark.createDataFrame([("a", -1), ("b", 0), ("c", 4), ("d'e", 5), ("m", 10), ("z", None), (None, 99)], "k string, n int")
    met = [F.coalesce(F.expr(condition), F.lit(False)).cast("int") for condition in relational.range_conditions(column, bounds)]
    assert len(met) == len(bounds) + 1
    assert {row[0] for row in df.select(sum(met[1:], met[0])).collect()} == {1}


def test_ranges_replace_the_cut_of_a_table():
    ranges = {"crm_sales_details": {"column": "sls_ord_num", "bounds": ["SO3"]}}
    cut = relational.with_ranges(relational.SOURCES, ranges)
    assert cut["crm_sales_details"].conditions == ["sls_ord_num < 'SO3' OR sls_ord_num IS NULL", "sls_ord_num >= 'SO3'"]
    assert cut["erp_loc_a101"] is relational.SOURCES["erp_loc_a101"]
    for wrong in ({"nothing": {"column": "a", "bounds": [1]}}, {"erp_loc_a101": {"column": "cid", "bounds": ["b", "a"]}}):
        with pytest.raises(ValueError):
            relational.with_ranges(relational.SOURCES, wrong)


def test_rejected_lines_are_kept_with_file_and_reason(spark, tmp_path):
    schema = table(id=INT, t=STRING, d=DATE)
    lines = ['1,a,2020-01-01', 'x,b,2020-01-01', '2,"b,c",2020-01-02', '3,"q,\\"r",', '4,d', '5,e,2020-01-01,more', '6,f,never', 'null,null,null', 'x,b,2020-01-01', '7,,']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.csv").write_text("\n".join(lines) + "\n")
    found = delimited.rejects(spark, str(tmp_path / "in"), schema).collect()
    assert sorted((row.line, row.reason) for row in found) == sorted([
        ("x,b,2020-01-01", "id is no int"), ("x,b,2020-01-01", "id is no int"), ("4,d", "2 fields in place of 3"),
        ("5,e,2020-01-01,more", "4 fields in place of 3"), ("6,f,never", "d is no date"),
    ])
    assert {row.file.rsplit("/", 1)[-1] for row in found} == {"part.csv"}
    assert len(found) == delimited.quality(spark, str(tmp_path / "in"), schema).first().lines_rejected


def cut_rows(spark, rows, columns, reads):
    """Rows of each part that is planned for a table which the stand-in reader answers SQL from."""
    rows.createOrReplaceTempView("to_be_cut")
    session = Session(lambda text: spark.sql(f"SELECT * FROM {text}"))
    conditions = relational.planned_conditions(session, "jdbc:x", "SELECT * FROM to_be_cut", {}, columns, reads)
    asked = [call[1] for call in session.read.calls]
    return [spark.sql(f"SELECT * FROM to_be_cut WHERE {condition}").count() for condition in conditions], conditions, asked


def test_parts_are_even_with_half_the_rows_on_one_value(spark):
    value = F.when(F.col("id") % 2 == 0, 77).when(F.col("id") % 11 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)))
    rows = spark.range(20_000).select(value.cast("int").alias("v"), F.concat(F.lit("it's "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("t"))
    alone, _, _ = cut_rows(spark, rows, ["v"], 10)
    assert sum(alone) == 20_000 and sorted(alone)[-1] >= 10_000 and sorted(alone)[-2] <= 2_200
    sizes, conditions, asked = cut_rows(spark, rows, ["v", "t"], 10)
    assert sum(sizes) == 20_000 and max(sizes) <= 2_200 and len(sizes) <= 20
    assert all(spark.sql(f"SELECT * FROM {text}").count() <= 10 for text in asked)
    met = spark.table("to_be_cut").select(sum(F.coalesce(F.expr(c).cast("int"), F.lit(0)) for c in conditions).alias("n"))
    assert met.filter("n <> 1").isEmpty()


@pytest.mark.parametrize("kind", ["date", "string", "decimal(12,2)", "timestamp"])
def test_parts_by_other_types(spark, kind):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 400).cast("int"))
    value = {"date": day, "string": F.sha2(F.col("id").cast("string"), 256), "decimal(12,2)": F.col("id") / 7, "timestamp": day.cast("timestamp")}[kind]
    sizes, _, _ = cut_rows(spark, spark.range(4_000).select(value.cast(kind).alias("v")), ["v"], 8)
    assert sum(sizes) == 4_000 and max(sizes) <= 520 and 8 <= len(sizes) <= 9


def test_parts_of_few_or_no_rows(spark):
    assert cut_rows(spark, spark.range(0).select(F.col("id").alias("v")), ["v"], 4)[0] == []
    assert sum(cut_rows(spark, spark.range(3).select(F.lit(None).cast("int").alias("v")), ["v"], 4)[0]) == 3
    assert sum(cut_rows(spark, spark.range(3).select(F.col("id").alias("v")), ["v"], 4)[0]) == 3
    session = Session(lambda text: spark.range(5).selectExpr("5 AS n", "5 AS k") if "COUNT(v)" in text else spark.createDataFrame([(2, 1)], "v int, n int"))
    source = relational.with_ranges({"t": relational.Source("q")}, {"t": {"columns": ["v"], "reads": 2}})["t"]
    relational.read(session, "jdbc:x", source, {})
    assert session.read.calls[-1][2]["predicates"] == ["v <= 2", "v > 2"]
