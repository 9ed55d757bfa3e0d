"""Storage and throughput reports over written tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions import clock_hms, safe_ratio
from strataflow.sinks.tables import filter_range


def data_files(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """(path, length) of the data files below ``path``; lists files, reads none."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .load(path).select("path", "length")
    )


def table_bytes(spark: SparkSession, path: str) -> DataFrame:
    return data_files(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def layout_savings(spark: SparkSession, compact: str, plain: str, measured: int = 0) -> DataFrame:
    """One row: bytes of both layouts and the percentage the compact one saves.

    ``measured`` are the bytes of parts of the plain one that have been measured before and are gone.
    """
    sizes = data_files(spark, compact).withColumn("_compact", F.lit(True)).unionByName(
        data_files(spark, plain).withColumn("_compact", F.lit(False))
    ).agg(
        F.sum(F.when(F.col("_compact"), F.col("length"))).alias("compact_bytes"),
        F.sum(F.when(~F.col("_compact"), F.col("length"))).alias("plain_bytes"),
    )
    if measured:
        sizes = sizes.withColumn("plain_bytes", F.coalesce("plain_bytes", F.lit(0)) + F.lit(measured).cast("long"))
    saved = safe_ratio(F.col("plain_bytes") - F.col("compact_bytes"), F.col("plain_bytes"), 100)
    return sizes.withColumn("savings_pct", F.round(saved, 1))


def partition_sizes(spark: SparkSession, path: str, part: str = "ym") -> DataFrame:
    """Files, bytes and rows per partition, largest first.  Rows come from file footers."""
    value = F.regexp_extract("path", f"{part}=([^/]+)", 1)
    files = data_files(spark, path).groupBy(value.alias(part)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    rows = spark.read.parquet(path).groupBy(F.col(part).cast("string").alias(part)).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return files.join(rows, part, "left").orderBy(F.desc("bytes"), part)


def partition_rows(df: DataFrame, part: str) -> DataFrame:
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("row_count"))


def partitions_touched(df: DataFrame, ts: str, low: datetime, high: datetime, part: str = "ym") -> DataFrame:
    """Partitions and rows a time range reads, next to those of the whole table."""
    def measured(frame: DataFrame, scope: str) -> DataFrame:
        per_part = frame.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
        return per_part.agg(
            F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count")
        ).select(F.lit(scope).alias("scope"), "partitions", "row_count")

    return measured(filter_range(df, ts, low, high, part), "range").unionByName(measured(df, "full"))


def rows_scanned(df: DataFrame) -> tuple[int, int]:
    """Runs a query that filters one table; the rows it gives and the rows its scan has read to find them.

    Row groups and pages that statistics or Bloom filters rule out are not read and don't count.
    """
    found = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return found, sum(int(leaves.apply(n).metrics().apply("numOutputRows").value()) for n in range(leaves.size()))


def etl_throughput(log: DataFrame) -> DataFrame:
    """Rows per second and seconds of each logged step; 0 where no time was measured."""
    millis = F.col("duration_ms").cast("decimal(18,0)")
    rows = F.col("rows_processed").cast("decimal(18,0)")

    def timed(value, digits: int):
        return F.when(millis > 0, F.round(value, digits)).otherwise(F.lit(0)).cast("double")

    return log.select(
        "step",
        F.col("rows_processed").alias("rows"),
        "duration_ms",
        timed(F.try_divide(rows * 1000, millis), 0).alias("rows_per_sec"),
        timed(millis / F.lit(1000).cast("decimal(4,0)"), 2).alias("duration_sec"),
        clock_hms("duration_ms").alias("duration"),
    )
