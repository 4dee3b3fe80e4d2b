"""Raw delimited files: no header, a fixed schema, ``null`` for a missing value."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from refinery.schemas import BRONZE

# How the extracts are written.
DELIMITER = ","
NULL_TEXT = "null"
REJECTED = "_rejected_line"


def scan(
    spark: SparkSession, path: str, schema: StructType, null_text: str | None = NULL_TEXT, keep_rejected: bool = False
) -> DataFrame:
    """Rows of the files under ``path``; a field that does not fit its type becomes NULL.

    ``keep_rejected`` adds the text of each line with such a field, or with too many or too few, as
    ``_rejected_line`` (NULL for a good line). ``null_text=None`` reads ``null`` in a string column as that word.
    """
    reader = spark.read.option("delimiter", DELIMITER).option("mode", "PERMISSIVE")
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    if keep_rejected:
        schema = StructType([*schema.fields, StructField(REJECTED, StringType())])
        # Without pruning every field of a line is checked, whichever columns are asked for.
        reader = reader.option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", False)
    return reader.schema(schema).csv(path)


# A quoted field, as the reader takes it: a backslash keeps the character after it.
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def rejects(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``file``, ``line`` and ``reason`` of every line that ``scan`` loses something of; a line that repeats comes as often.

    The reason is the number of fields where that is wrong, else the first field that does not fit its type. Only the rejected
    lines are looked at a second time, in the task that read them.
    """
    read = scan(spark, path, schema, keep_rejected=True).select("*", F.col("_metadata.file_path").alias("_file"))
    texts = StructType([StructField(field.name, StringType()) for field in schema])
    bad = read.filter(F.col(REJECTED).isNotNull()).withColumn("_texts", F.from_csv(REJECTED, texts.simpleString()[7:-1].replace(":", " "), {"nullValue": NULL_TEXT, "delimiter": DELIMITER}))
    fields = F.size(F.split(F.regexp_replace(REJECTED, _QUOTED, ""), DELIMITER, -1))
    count = F.when(fields != len(schema), F.format_string(f"%d fields in place of {len(schema)}", fields))
    lost = [
        F.when(F.col(field.name).isNull() & F.col("_texts")[field.name].isNotNull(), f"{field.name} is no {field.dataType.simpleString()}")
        for field in schema
    ]
    reason = F.coalesce(count, *lost, F.lit("the line can't be read"))
    return bad.select(F.col("_file").alias("file"), F.col(REJECTED).alias("line"), reason.alias("reason"))


def write_rejects(spark: SparkSession, root: str, target: str) -> None:
    """Keeps the rejected lines of all raw tables under ``target``, one folder per table, in place of those of an earlier scan."""
    for name, schema in BRONZE.items():
        rejects(spark, f"{root}/{name}", schema).write.mode("overwrite").parquet(f"{target}/table_name={name}")


def quality(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row: lines read, lines with a field that was lost, and the missing values of each column."""
    missing = [F.count_if(F.col(field.name).isNull()).alias(f"{field.name}_missing") for field in schema]
    return scan(spark, path, schema, keep_rejected=True).agg(
        F.count(F.lit(1)).alias("lines_read"), F.count(REJECTED).alias("lines_rejected"), *missing
    )


def write(df: DataFrame, path: str) -> None:
    """Replaces the files under ``path``, in the form that ``scan`` reads.

    A text that would not come back is an error: one with a line break, or the word that stands for a missing value.
    """
    lost = F.lit("a text with a line break, or the word for a missing value, can't be written as a delimited line")

    def whole(name: str) -> Column:
        value = F.col(name)
        return F.when(value.contains("\n") | value.contains("\r") | (value == NULL_TEXT), F.raise_error(lost)).otherwise(value).alias(name)

    texts = {field.name for field in df.schema if isinstance(field.dataType, StringType)}
    df.select(*[whole(name) if name in texts else F.col(name) for name in df.columns]).write.mode("overwrite").options(
        delimiter=DELIMITER, nullValue=NULL_TEXT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def scan_bronze(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All raw tables, one folder per table."""
    return {name: scan(spark, f"{root}/{name}", schema) for name, schema in BRONZE.items()}
