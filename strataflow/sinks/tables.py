"""Table writes: partition layouts, verified loads and aggregate refresh."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataflow.functions import wall
from strataflow.sinks.folders import _remove, swap


def stamp_sync_time(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Landing projection plus the load time."""
    return df.select(*columns).withColumn("sync_time", F.current_timestamp())


def with_month(df: DataFrame, ts: str, name: str = "ym") -> DataFrame:
    """Month partition key as an integer such as 202411."""
    return df.withColumn(name, F.year(ts) * 100 + F.month(ts))


def with_key_range(df: DataFrame, key: str, step: int, first: int = 1, name: str = "key_range") -> DataFrame:
    """Integer range partition key: 0 for [first, first+step), 1 for the next range, and so on."""
    offset = (F.col(key) - F.lit(first)).cast("long")
    # Whole-number division of an exact multiple: a double would round keys above 2^53.
    whole = F.call_function("div", offset - F.pmod(offset, F.lit(step).cast("long")), F.lit(step).cast("long"))
    return df.withColumn(name, whole)


def filter_range(df: DataFrame, ts: str, low: datetime, high: datetime, part: str = "ym") -> DataFrame:
    """Rows with ``low <= ts < high`` plus the month predicate that lets the scan skip partitions.

    A filter on the timestamp alone never prunes a derived partition column.
    """
    last = high - timedelta(microseconds=1)
    first_month, last_month = low.year * 100 + low.month, last.year * 100 + last.month
    return df.where(
        (F.col(part) >= first_month) & (F.col(part) <= last_month)
        & (F.col(ts) >= wall(low)) & (F.col(ts) < wall(high))
    )


def out_of_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows a layout bounded to [low, high) would reject, NULL keys included."""
    low, high = (wall(b) if isinstance(b, datetime) else F.lit(b) for b in (low, high))
    inside = (F.col(col) >= low) & (F.col(col) < high)
    return df.where(~F.coalesce(inside, F.lit(False)))


def assert_in_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """The frame itself if every row fits a layout bounded to [low, high); raises otherwise."""
    rejected = out_of_range(df, col, low, high).count()
    if rejected:
        raise ValueError(f"{rejected} rows have {col} outside [{low}, {high})")
    return df


def load_verified(
    df: DataFrame,
    path: str,
    part: str | None = None,
    sort: Sequence[str | Column] = (),
    codec: str = "zstd",
    distribute: Sequence[str] = (),
    lookup: Mapping[str, int] | None = None,
    row_group_bytes: int | None = None,
) -> int:
    """Replace the table at ``path``; return its row count or raise if rows went missing.

    ``distribute`` names the distribution key of an unpartitioned table, ``sort``
    the order inside each file, which makes its min/max statistics selective.
    ``lookup`` names columns that single values are looked up by, with the number of
    different values expected in a file: each row group gets a Bloom filter of
    them, which tells most row groups without the value although the column is not
    sorted.  ``row_group_bytes`` sizes the row groups, the least that a scan skips.

    Partitioned tables are written through a REBALANCE on the partition key:
    adaptive execution splits a month that holds far more rows than the others
    into several tasks and merges the small ones, so there is neither one huge
    writer nor a file per task and month.  The input is counted inside the
    write itself, in the stage that writes, where re-run tasks count once.

    The rows are written beside the table and counted there; only a complete copy takes its place, so a load that fails
    leaves the old table as it was, and a table may be loaded from itself.
    """
    spark = df.sparkSession
    counted, aside = Observation(), f"{path.rstrip('/')}.loading-{uuid.uuid4().hex}"
    spread = [part] if part else list(distribute)
    shaped = df.hint("rebalance", *spread) if spread else df
    shaped = shaped.observe(counted, F.count(F.lit(1)).alias("rows"))
    if part or sort:
        shaped = shaped.sortWithinPartitions(*([part] if part else []), *sort)
    writer = shaped.write.mode("overwrite").option("compression", codec)
    for column, values in (lookup or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    try:
        (writer.partitionBy(part) if part else writer).parquet(aside)
        submitted = int(counted.get["rows"])
        loaded = spark.read.schema(df.schema).parquet(aside).count()
        if loaded != submitted:
            raise RuntimeError(f"{path}: wrote {submitted} rows, table holds {loaded}")
        swap(spark, aside, path)
    except BaseException:
        _remove(spark, aside)
        raise
    return loaded


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: Sequence[str] = (), path: str | None = None) -> None:
    """Catalog table bucketed by ``key``, at ``path`` or in the warehouse folder: two such tables join on it without a shuffle.

    A bucket is one task, which cannot be split, so this suits keys that spread
    evenly; ``load_verified`` tables keep adaptive skew handling.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def refresh(spark: SparkSession, aggregates: Mapping[str, DataFrame], root: str, parallel: int = 4) -> dict[str, int]:
    """Recompute and replace the named tables; they are independent, so their jobs overlap."""
    return load_many({name: (frame, f"{root}/{name}", {}) for name, frame in aggregates.items()}, parallel)


def load_many(tables: Mapping[str, tuple[DataFrame, str, Mapping]], parallel: int = 4) -> dict[str, int]:
    """``load_verified`` for several independent tables at once: name -> (frame, path, options)."""
    def one(item: tuple[str, tuple[DataFrame, str, Mapping]]) -> tuple[str, int]:
        name, (frame, path, options) = item
        return name, load_verified(frame, path, **options)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(pool.map(one, tables.items()))
