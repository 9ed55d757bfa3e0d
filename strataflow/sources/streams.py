"""Streaming scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Files landing under ``path`` (a folder or a glob) as an unbounded table."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


LOT_ROWS = 250_000


def arriving_in_lots(spark: SparkSession, lots: Sequence[DataFrame], path: str) -> DataFrame:
    """Frames of one schema as a stream of files under ``path``, one frame per batch.

    Each is written as the same number of files, of at most about ``LOT_ROWS`` rows, and a batch takes that many files: the number of batches
    is that of the frames however large they are, and a batch is read by as many tasks as it has files.
    """
    sizes = [lot.count() for lot in lots]
    files = max(1, -(-max(sizes) // LOT_ROWS))
    for lot, rows in zip(lots, sizes):
        if files > 1 and rows >= files * files:
            lot.repartition(files).write.mode("append").parquet(path)
            continue
        lot.coalesce(1).write.mode("append").parquet(path)
        # So few rows are one file; empty ones beside it keep the batches where they are.
        for _ in range(files - 1):
            lot.limit(0).coalesce(1).write.mode("append").parquet(path)
    return read_file_stream(spark, path, lots[0].schema, max_files=files)


def read_bus_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType, **options: str) -> DataFrame:
    """JSON records of a Kafka topic, parsed to ``schema`` (needs the Kafka connector on the classpath)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return parse_records(raw, schema)


def parse_records(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The fields of JSON records and ``malformed``: the whole text of a record that does not fit, else NULL.

    Nothing is dropped: a malformed record is a row whose text can be counted, stored and read again.
    """
    text = F.col(value).cast("string")
    wanted = T.StructType([*schema.fields, T.StructField("malformed", T.StringType())])
    parsed = F.from_json(text, wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})
    rows = raw.select(text.alias("_text"), parsed.alias("record"))
    broken = F.when(F.col("record").isNull(), F.col("_text")).otherwise(F.col("malformed"))
    return rows.select("_text", "record", "record.*").select(*schema.names, broken.alias("malformed"))
