"""File scans: Parquet tables and headerless delimited text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}.parquet") for name in names}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, crlf: bool = False) -> DataFrame:
    """Positional, headerless, comma-separated UTF-8 with optional double quotes.

    ``crlf=True`` reads files whose rows end in CR LF: rows are cut at the line
    feed, the last column is taken as text, freed of the carriage return and
    only then cast, so a typed last column does not fail on the stray byte.
    """
    options = {"sep": ",", "quote": '"', "escape": '"', "header": "false", "encoding": "UTF-8", "mode": "FAILFAST"}
    if not crlf:
        return spark.read.schema(schema).options(**options).csv(path)
    last = schema.fields[-1]
    raw_schema = T.StructType([*schema.fields[:-1], T.StructField(last.name, T.StringType(), True)])
    raw = spark.read.schema(raw_schema).options(**options).option("lineSep", "\n").csv(path)
    bare = F.regexp_replace(F.col(last.name), "\\r$", "")
    if not isinstance(last.dataType, T.StringType):
        bare = F.when(bare == "", None).otherwise(bare)
    return raw.withColumn(last.name, bare.cast(last.dataType))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table; Parquet answers from row-group metadata."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
