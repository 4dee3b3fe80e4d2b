"""Full copies of relational tables, read in parallel, into the raw landing folders."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from refinery.schemas import BRONZE
from refinery.sources import delimited

FETCH_ROWS = 10_000  # rows per round trip; some drivers load the whole result at once if it is not set


@dataclass(frozen=True)
class Source:
    """A table of the source database, as a query, and how to cut it into parallel reads.

    ``split_on`` is a numeric or date column cut into ``reads`` equal ranges between its smallest and largest
    value, or ``conditions`` are SQL conditions of which each row meets exactly one. ``even_on`` names columns by which
    about ``reads`` even parts are planned when the table is read (``planned_conditions``). With none of these, one
    connection reads everything: for small tables only.
    """

    query: str
    split_on: str | None = None
    reads: int = 1
    conditions: Sequence[str] = field(default_factory=tuple)
    even_on: Sequence[str] = field(default_factory=tuple)


def last_digit_conditions(column: str, digits: int = 1) -> list[str]:
    """Conditions that cut a text key by its last digits; the last one takes all other rows, NULL keys too."""
    likes = [f"{column} LIKE '%{number:0{digits}d}'" for number in range(10**digits)]
    return [*likes, f"{column} IS NULL OR NOT ({' OR '.join(likes)})"]


def range_conditions(column: str, bounds: Sequence[str | int]) -> list[str]:
    """Conditions that cut a column at ascending bounds, one read more than bounds; the first also takes NULL.

    Each can use an index on the column, so the table is read once in all. A value that a great many rows share stays in
    one read: cut by another column then.
    """
    if list(bounds) != sorted(set(bounds)) or not bounds:
        raise ValueError(f"bounds of {column} have to be different and ascending")
    written = list(map(literal, bounds))
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(written, written[1:])]
    return [f"{column} < {written[0]} OR {column} IS NULL", *between, f"{column} >= {written[-1]}"]


def literal(value: object) -> str:
    """A value as SQL writes it; days and times in ISO form, which databases read."""
    if isinstance(value, int | float | Decimal):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def planned_conditions(spark: SparkSession, url: str, query: str, properties: Mapping[str, str], columns: Sequence[str], reads: int) -> list[str]:
    """Conditions that cut a query into about ``reads`` even parts by the first of ``columns``; each row meets exactly one.

    The database counts its rows per value and adds the counts up in order; only the values at which a part is full come back,
    so there are at most ``reads`` of them whatever the column holds. A value (or its absence) that fills a part by itself is
    read apart, and cut by the next of ``columns`` if there is one. Two queries per column, both answered by an index on it.
    """
    column, others = columns[0], columns[1:]
    rows = f"(SELECT {column} AS v FROM ({query}) t)"
    total, known = spark.read.jdbc(url, f"(SELECT COUNT(*) AS n, COUNT(v) AS k FROM {rows} c) e", properties=properties).first()
    if not total or reads < 2:
        return []
    size = -(-int(total) // reads)
    counts = f"(SELECT v, COUNT(*) AS n FROM {rows} c WHERE v IS NOT NULL GROUP BY v)"
    sums = f"(SELECT v, n, SUM(n) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS upto FROM {counts} h)"
    full = f"FLOOR(upto / {size}.0) > FLOOR((upto - n) / {size}.0)"
    found = spark.read.jdbc(url, f"(SELECT v, n FROM {sums} s WHERE {full}) e", properties=properties).collect()

    def apart(one: str, rows_of_it: int) -> list[str]:
        if not others or rows_of_it < 2 * size:
            return [one]
        parts = planned_conditions(spark, url, f"SELECT * FROM ({query}) o WHERE {one}", properties, others, -(-rows_of_it // size))
        return [f"{one} AND ({part})" for part in parts] or [one]

    conditions, low = [], None
    for value, n in sorted((row[0], int(row[1])) for row in found):
        above = "" if low is None else f"{column} > {literal(low)} AND "
        if n >= size:
            conditions += [f"{above}{column} < {literal(value)}", *apart(f"{column} = {literal(value)}", n)]
        else:
            conditions.append(f"{above}{column} <= {literal(value)}")
        low = value
    conditions.append(f"{column} > {literal(low)}" if low is not None else f"{column} IS NOT NULL")
    return conditions + (apart(f"{column} IS NULL", int(total) - int(known)) if known < total else [])


def with_ranges(sources: Mapping[str, Source], ranges: Mapping[str, Mapping]) -> dict[str, Source]:
    """``sources`` with some cut by ranges instead: ``{table: {"column": name, "bounds": [...]}}``, or ``{table: {"columns": [...],
    "reads": n}}`` to have the bounds found (``planned_conditions``)."""
    unknown = ranges.keys() - sources.keys()
    if unknown:
        raise ValueError(f"ranges of unknown tables: {sorted(unknown)}")
    cut = {
        name: Source(sources[name].query, conditions=range_conditions(**of))
        if "bounds" in of
        else Source(sources[name].query, even_on=tuple(of["columns"]), reads=of["reads"])
        for name, of in ranges.items()
    }
    return {**sources, **cut}


# Without ranges each part below is a full scan on the database's side, as an ending can't use an index: for a first copy,
# or a small database. The source tables. Order numbers and customer keys end in running digits, so cutting by the
# last digits gives even parts and also cuts a customer or a day that has very many sales.
SOURCES = {
    "crm_cust_info": Source("SELECT * FROM crm.cust_info", conditions=last_digit_conditions("cst_key")),
    "crm_prd_info": Source("SELECT * FROM crm.prd_info", split_on="prd_id", reads=10),
    "crm_sales_details": Source(
        "SELECT * FROM crm.sales_details", conditions=last_digit_conditions("sls_ord_num", digits=2)
    ),
    "erp_loc_a101": Source("SELECT * FROM erp.loc_a101", conditions=last_digit_conditions("cid")),
    "erp_cust_az12": Source("SELECT * FROM erp.cust_az12", conditions=last_digit_conditions("cid")),
    "erp_px_cat_g1v2": Source("SELECT * FROM erp.px_cat_g1v2"),
}


def read(spark: SparkSession, url: str, source: Source, properties: Mapping[str, str]) -> DataFrame:
    properties = {"fetchsize": str(FETCH_ROWS), **properties}
    rows = f"({source.query}) t"
    conditions = list(source.conditions)
    if source.even_on:
        conditions = planned_conditions(spark, url, source.query, properties, source.even_on, source.reads)
    if conditions:
        return spark.read.jdbc(url, rows, predicates=conditions, properties=properties)
    if source.split_on is None:
        return spark.read.jdbc(url, rows, properties=properties)
    ends = f"(SELECT MIN({source.split_on}) AS lo, MAX({source.split_on}) AS hi FROM {rows}) e"
    bounds = spark.read.jdbc(url, ends, properties=properties).first()
    low, high = bounds[0], bounds[1]
    if low is None or low == high:
        return spark.read.jdbc(url, rows, properties=properties)
    return spark.read.jdbc(
        url, rows, column=source.split_on, lowerBound=str(low), upperBound=str(high),
        numPartitions=source.reads, properties=properties,
    )


def typed(df: DataFrame, name: str) -> DataFrame:
    """The declared columns and types of a raw table, whatever near types the database uses."""
    return df.select(*[df[column.name].cast(column.dataType) for column in BRONZE[name]])


def land(
    spark: SparkSession,
    url: str,
    root: str,
    properties: Mapping[str, str],
    sources: Mapping[str, Source] = SOURCES,
    file_format: str = "parquet",
) -> None:
    """Replaces each raw table's folder by a full copy of its source: ``parquet`` keeps every value, ``csv`` refuses those it can't."""
    for name, source in sources.items():
        rows = typed(read(spark, url, source, properties), name)
        if file_format == "csv":
            delimited.write(rows, f"{root}/{name}")
        else:
            rows.write.mode("overwrite").format(file_format).save(f"{root}/{name}")
