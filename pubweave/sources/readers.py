"""Reading article collections and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pubweave.schema import ARTICLE
from pubweave.sources.writers import CSV_OPTIONS
from pubweave.storage import path_exists


def read_articles(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType = ARTICLE,
    multi_line: bool = False,
    missing_ok: bool = True,
) -> DataFrame:
    """A stored article set with its declared schema; an absent path is an empty set.

    ``format='json'`` reads one object per line. ``multi_line`` reads files that each hold one
    JSON array or one object; such a file cannot be split, so keep large data in lines.
    """
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if format == "json":
        reader = reader.option("multiLine", multi_line)
    # The folders of an appended set are named by a copy of a column.
    return reader.format(format).load(path).select(*schema.names)


def read_collection(
    spark: SparkSession,
    format: str,
    options: dict[str, str],
    schema: T.StructType,
) -> DataFrame:
    """A collection behind any Spark data source, such as a document store.

    Address and credentials are the caller's ``options``. A ``_id`` column is read as text.
    """
    df = spark.read.format(format).schema(schema).options(**options).load()
    return df.withColumn("_id", F.col("_id").cast("string")) if "_id" in df.columns else df


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result table written with a header row. Cells may hold line feeds, so a file is one split.

    A cell of nothing is missing, one of two quotes is an empty text. The reader tells them apart by
    what it puts in place of nothing, a letter that no text has.
    """
    options = CSV_OPTIONS | {
        "nullValue": "\u0000",
        "emptyValue": "",
        "multiLine": "true",
        "lineSep": "\n",
    }
    return spark.read.schema(schema).options(**options).csv(path)


def _json_cell(name: str) -> Column:
    """``"name": value`` where a digits-only text is a number, any other text a string."""
    value = F.coalesce(F.col(f"`{name}`"), F.lit(""))
    quoted = F.regexp_extract(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", 1)
    number = F.regexp_replace(value, "^0+(?=[0-9])", "")
    label = F.regexp_extract(F.to_json(F.array(F.lit(name))), r"(?s)^\[(.*)\]$", 1)
    cell = F.when(value.rlike("^[0-9]+$"), number).otherwise(quoted)
    return F.concat(label, F.lit(":"), cell)


def csv_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Each CSV row as one JSON object in column ``value``; cells of digits become numbers."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    table = read_table_csv(spark, path, text)
    body = F.concat_ws(",", *[_json_cell(c) for c in columns])
    return table.select(F.concat(F.lit("{"), body, F.lit("}")).alias("value"))
