"""Readers for the four raw sources, the source gate and the column contract."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from auric.sources import schemas


class MissingSourcesError(RuntimeError):
    pass


class MissingColumnsError(RuntimeError):
    pass


def _csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """All columns of the files' own header, as text, and the line itself in
    CORRUPT_ROW where it does not fit the header.

    A row with fewer or more fields than the header, or with a quote that is not
    closed or stands inside a field, is not cut to size in silence: it keeps the
    whole line, for the quarantine. ``enforceSchema=False`` compares every
    file's header with the first one's: files that order their columns
    differently fail instead of being mixed.
    """
    header = spark.read.csv(path, header=True, enforceSchema=False, inferSchema=False, **options).schema
    fields = [StructField(f.name, StringType(), True) for f in header.fields]
    rows = spark.read.csv(path, schema=StructType([*fields, StructField(schemas.CORRUPT_ROW, StringType(), True)]),
                          header=True, enforceSchema=False, mode="PERMISSIVE",
                          columnNameOfCorruptRecord=schemas.CORRUPT_ROW, **options)
    # An unclosed quote swallows separators up to the line's end or leaves the
    # quote sign in the value; what was read of such a row stands for the line.
    stray = reduce(or_, (F.contains(F.col(f"`{f.name}`"), F.lit('"')) for f in fields))
    as_read = F.to_json(F.struct(*(F.col(f"`{f.name}`") for f in fields)))
    return rows.withColumn(schemas.CORRUPT_ROW, F.coalesce(
        F.col(schemas.CORRUPT_ROW), F.when(F.coalesce(stray, F.lit(False)), as_read)))


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Comma separated, header row."""
    return _csv(spark, path, sep=",")


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon separated, header row."""
    return _csv(spark, path, sep=";")


def read_loyalty_segments(spark: SparkSession, path: str) -> DataFrame:
    """Comma separated, header row; blank cells stay blank strings."""
    return _csv(spark, path, sep=",", ignoreLeadingWhiteSpace=True,
                ignoreTrailingWhiteSpace=True, emptyValue="")


def parse_orders(documents: DataFrame) -> DataFrame:
    """Order documents from text: the fields the cleaning reads beside the
    whole document, so no other field is lost. A document that is no valid
    JSON object has its text in CORRUPT and NULL fields."""
    schema = StructType([*schemas.SALES_ORDERS_JSON.fields,
                         StructField(schemas.CORRUPT, StringType(), True)])
    parsed = F.from_json(schemas.RAW, schema, {"mode": "PERMISSIVE",
                                               "columnNameOfCorruptRecord": schemas.CORRUPT})
    return documents.withColumn("_p", parsed).select(
        "_p.*", *[c for c in documents.columns])


def read_sales_orders(spark: SparkSession, path: str) -> DataFrame:
    """Folder of JSON order documents, one a line, one relation; every document
    is kept whole."""
    text = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return parse_orders(text.select(F.col("value").alias(schemas.RAW),
                                    F.col("_metadata.file_path").alias("_file")))


READERS = {
    "customers": read_customers,
    "products": read_products,
    "loyalty_segments": read_loyalty_segments,
    "sales_orders": read_sales_orders,
}


def check_sources(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Fail early, naming every source whose path cannot be resolved.

    A schema-only read per path: resolving a file source checks that the
    path exists (for any scheme the cluster can read) without scanning
    data.
    """
    from pyspark.errors import AnalysisException

    missing = []
    for name, path in paths.items():
        try:
            spark.read.format("text").load(path).schema
        except AnalysisException:
            missing.append(f"{name} ({path})")
    if missing:
        raise MissingSourcesError("source paths missing: " + ", ".join(missing))


def read_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One raw source, with the columns its cleaning requires checked on what
    the files really hold."""
    return require_columns(READERS[name](spark, path), schemas.REQUIRED[name], path)


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(
            f"required columns {missing} missing from {table}; available: {df.columns}")
    return df
