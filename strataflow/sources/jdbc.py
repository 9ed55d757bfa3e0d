"""Extract from an operational database over JDBC."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from strataflow import schemas


def jdbc_options(
    url: str,
    table: str,
    part_col: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options; with a key and its bounds the scan becomes ``partitions`` range queries."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        **extra,
    }
    if partitions > 1:
        if part_col is None or bounds is None:
            raise ValueError("a parallel extract needs part_col and bounds")
        low, high = bounds
        options.update(
            partitionColumn=part_col, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def extract_all(
    spark: SparkSession,
    url: str,
    bounds: Mapping[str, tuple[int, int]],
    partitions: int = 32,
    whole: Collection[str] = (),
    **extra: str,
) -> dict[str, DataFrame]:
    """The six operational tables as lazy frames, each read by ranges of its key.

    A table without bounds would pass through one task, so it raises unless ``whole`` names it as small enough for that.
    """
    unbounded = [table for table in schemas.KEYS if table not in bounds and table not in whole]
    if unbounded:
        raise ValueError(f"no key bounds for {', '.join(unbounded)}")
    frames = {}
    for table, keys in schemas.KEYS.items():
        split = {"part_col": keys[0], "bounds": bounds[table], "partitions": partitions} if table in bounds else {}
        frames[table] = read_jdbc(spark, url, table, **split, **extra)
    return frames
