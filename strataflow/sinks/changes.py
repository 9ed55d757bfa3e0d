"""Merge of an ordered feed of inserts, updates and deletes into a stored table.

A record carries the key, the values, an operation and a sequence number that orders the records of its key.  The stored row of a key
is its newest record, and a deleted key leaves a tombstone, so records may come late, twice or in any order: older ones change nothing.

A batch goes through three steps, each of which can be run again.  First its images are stored: the rows it takes away (sign -1) and those
it puts in their place (sign +1), found by reading the keys of the table.  Then the partitions that hold an image are rewritten, others are not read.  Last
the batch is entered in the log.  A replay finds the log entry and does nothing, or finds the images and goes on from them; whoever
maintains aggregates of the table adds up the images of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataflow.session import settle
from strataflow.sinks.folders import _exists, _remove
from strataflow.sinks.upsert import _matching

SEQ, GONE, SIGN, BATCH = "_seq", "_gone", "_sign", "batch_no"
INSERT, UPDATE, DELETE = "I", "U", "D"


@dataclass(frozen=True)
class Feed:
    """A maintained table: where it is, its key, its partition column, and the feed's columns for order and operation.

    ``settled`` says that a key never changes its partition; only the partitions of a batch's own records are then searched for its keys.
    """

    path: str
    keys: tuple[str, ...]
    part: str
    seq: str = "seq"
    op: str = "op"
    sort: tuple[str, ...] = ()
    settled: bool = False

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def log(self) -> str:
        return f"{self.path}/log"

    def images(self, batch_no: int) -> str:
        return f"{self.path}/images/{BATCH}={batch_no}"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet or no file in it."""
    if not _exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as empty:
        if empty.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def in_partitions(part: str, values: Sequence) -> Column:
    """Rows of the named partitions as literals, which the scan prunes by; None is the partition without a value."""
    named = F.col(part).isin([v for v in values if v is not None])
    return (named | F.col(part).isNull()) if None in values else named


def partition_values(rows: DataFrame, part: str) -> list:
    """The partitions that ``rows`` lie in: at most as many as the table has."""
    return [r[0] for r in rows.select(part).distinct().collect()]


def replace_partitions(spark: SparkSession, path: str, merged: DataFrame, values: Sequence, part: str, sort: Sequence[str] = ()) -> None:
    """Puts ``merged``, which must not read the table itself, in the place of the partitions ``values``; partitions without rows are removed last."""
    base = _read(spark, path)
    if base is not None:
        left = set(partition_values(merged, part))
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("folder")
        lost = [v for v in values if v not in left]
        emptied = base.select("*", "_metadata").where(in_partitions(part, lost))
        stale = [r.folder for r in emptied.select(folder).distinct().collect()] if lost else []
    writer = merged.hint("rebalance", part).sortWithinPartitions(part, *sort).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    for name in stale if base is not None else ():
        _remove(spark, name)


def _newest(changes: DataFrame, feed: Feed) -> DataFrame:
    """One record per key: the greatest by sequence, combined before the shuffle; records that agree in it are told apart by their values."""
    gone = (F.col(feed.op) == DELETE).alias(GONE)
    values = [c for c in changes.columns if c not in (*feed.keys, feed.seq, feed.op)]
    top = changes.groupBy(*feed.keys).agg(F.max(F.struct(F.col(feed.seq).alias(SEQ), gone, *values)).alias("_row"))
    return top.select(*feed.keys, *[F.col(f"_row.{c}").alias(c) for c in (*values, SEQ, GONE)])


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _images(spark: SparkSession, feed: Feed, changes: DataFrame) -> DataFrame:
    """Rows that a batch takes away and rows and tombstones that it puts in, with their sign."""
    fresh = settle(_newest(changes, feed), "feed-newest")
    base = _read(spark, feed.rows)
    if base is None:
        return fresh.withColumn(SIGN, F.lit(1))
    if feed.settled:
        base = base.where(in_partitions(feed.part, partition_values(fresh, feed.part)))
    # Keys, sequence and partition alone are read of the whole table; the images' other columns only where a key is found.
    keys = fresh.select(*feed.keys)
    held = settle(_matching(base.select(*feed.keys, SEQ, feed.part), keys, feed.keys), "feed-held")
    both = fresh.alias("f").join(held.alias("h"), _same(feed.keys, "f", "h"), "left")
    newer = both.where(F.col(f"h.{SEQ}").isNull() | (F.col(f"f.{SEQ}") > F.col(f"h.{SEQ}")))
    # A tombstone stays where its row was.
    place = F.when(F.col(f"f.{GONE}") & F.col(f"h.{SEQ}").isNotNull(), F.col(f"h.{feed.part}")).otherwise(F.col(f"f.{feed.part}"))
    added = newer.select(*[place.alias(c) if c == feed.part else F.col(f"f.{c}").alias(c) for c in base.columns])
    homes = held.where(in_partitions(feed.part, partition_values(held, feed.part)))
    rows = base.where(in_partitions(feed.part, partition_values(homes, feed.part)))
    taken = _matching(rows, newer.select(*[F.col(f"f.{k}").alias(k) for k in feed.keys]), feed.keys)
    return added.withColumn(SIGN, F.lit(1)).unionByName(taken.withColumn(SIGN, F.lit(-1)))


def applied(spark: SparkSession, feed: Feed) -> DataFrame | None:
    """The log: one row per batch with its records, the keys it inserted, updated and deleted, and the partitions it rewrote."""
    return _read(spark, feed.log)


def images(spark: SparkSession, feed: Feed, batch_no: int) -> DataFrame:
    """The signed rows of a batch, tombstones left out; none for a batch without effect."""
    return spark.read.parquet(feed.images(batch_no)).where(~F.col(GONE))


def apply_changes(spark: SparkSession, feed: Feed, changes: DataFrame, batch_no: int) -> bool:
    """Merges a batch of records; False if the log has the batch already.

    ``changes`` holds the table's columns, the sequence and the operation; a delete needs the key and the sequence only.  Deletes of unknown keys leave a
    tombstone in the partition they name, and nothing else.
    """
    log = applied(spark, feed)
    if log is not None and log.where(F.col(BATCH) == batch_no).count():
        return False
    if _read(spark, feed.images(batch_no)) is None:
        _images(spark, feed, changes).write.mode("overwrite").parquet(feed.images(batch_no))
    signed = spark.read.parquet(feed.images(batch_no))
    added = signed.where(F.col(SIGN) == 1).drop(SIGN)
    values = partition_values(signed, feed.part)
    if values:
        base = _read(spark, feed.rows)
        merged = added
        if base is not None:
            left = _matching(base.where(in_partitions(feed.part, values)), added.select(*feed.keys), feed.keys, "left_anti")
            merged = left.select(*added.columns).unionByName(added)
        replace_partitions(spark, feed.rows, settle(merged, "feed-merged"), values, feed.part, (*feed.sort, *feed.keys))
    # Old and new image of a key side by side, one row per key.
    counted = signed.groupBy(*feed.keys).agg(
        F.count_if((F.col(SIGN) == -1) & ~F.col(GONE)).alias("old"), F.count_if((F.col(SIGN) == 1) & ~F.col(GONE)).alias("new"))
    entry = counted.agg(
        F.count_if(F.expr("old = 0 AND new = 1")).alias("inserted"), F.count_if(F.expr("old = 1 AND new = 1")).alias("updated"),
        F.count_if(F.expr("old = 1 AND new = 0")).alias("deleted"))
    records = changes.agg(F.count(F.lit(1))).scalar()
    entry.select(F.lit(batch_no).cast("long").alias(BATCH), records.alias("records"), "*", F.lit(len(values)).alias("partitions")) \
        .write.mode("append").parquet(feed.log)
    return True


def current(spark: SparkSession, feed: Feed) -> DataFrame:
    """The table without tombstones, in its own columns."""
    return spark.read.parquet(feed.rows).where(~F.col(GONE)).drop(SEQ, GONE)


def forget(spark: SparkSession, feed: Feed, before: int, upto_batch: int) -> None:
    """Drops tombstones with a sequence below ``before``, below which no record can come any more, and the images of batches up to ``upto_batch``."""
    base = spark.read.parquet(feed.rows)
    old = F.col(GONE) & (F.col(SEQ) < before)
    values = partition_values(base.where(old), feed.part)
    if values:
        replace_partitions(spark, feed.rows, settle(base.where(in_partitions(feed.part, values)).where(~old), "feed-left"), values, feed.part, (*feed.sort, *feed.keys))
    for row in applied(spark, feed).where(F.col(BATCH) <= upto_batch).select(BATCH).collect():
        _remove(spark, feed.images(row[0]))


def change_stream(
    stream: DataFrame, feed: Feed, checkpoint: str, then: Callable[[SparkSession, int], None] | None = None, every: str | None = None,
) -> StreamingQuery:
    """Applies a stream of records batch by batch; ``then`` runs after each one, again after a failure, and is given the batch's number."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch.sparkSession, feed, batch, batch_id)
        if then is not None:
            then(batch.sparkSession, batch_id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
