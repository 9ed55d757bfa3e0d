"""Continuous aggregates with Structured Streaming.

Every micro-batch is reduced to partial aggregates by the same wall-clock buckets as a batch job, and stored in a folder
of its own; reading the table merges the partials.  Counts, sums and session intervals merge in any order, so no row is
ever late: there is no watermark, nothing is dropped, and rows without a time keep their NULL bucket.  Wall clocks are
never cast through a zone.  Writing a batch replaces its own folder, so a batch that is replayed after a failure
leaves the table as if it had run once.  ``compact`` folds the folders so far into one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions import safe_ratio, time_bucket
from strataflow.functions.timing import width_seconds
from strataflow.operators.ordered import preceding_max, running_total


@dataclass(frozen=True)
class Continuous:
    """A stream with the three steps that maintain its table."""

    stream: DataFrame
    partial: Callable[[DataFrame], DataFrame]  # rows of a batch -> partial aggregates
    merge: Callable[[DataFrame], DataFrame]  # partials of any batches -> partials
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows


def _summed(keys: list[str], sums: list[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda partials: partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def minute_gmv_stream(events: DataFrame, ts: str, amount: str) -> Continuous:
    """Orders and amount per minute."""
    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(time_bucket("1 minute", ts).alias("bucket_time")).agg(
            F.count(F.lit(1)).alias("minute_order_count"), F.sum(amount).alias("minute_gmv"))

    return Continuous(events, partial, _summed(["bucket_time"], ["minute_order_count", "minute_gmv"]))


def bucket_stats_stream(events: DataFrame, ts: str, amount: str, units: str, width: str = "5 minutes") -> Continuous:
    """Count, two sums and a mean per tumbling bucket."""
    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(time_bucket(width, ts).alias("bucket_time")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(units).alias("units"), F.sum(amount).alias("revenue"), F.count(amount).alias("_n"))

    def finish(rows: DataFrame) -> DataFrame:
        return rows.select("bucket_time", "n", "units", "revenue", safe_ratio(F.col("revenue"), F.col("_n")).alias("avg_amount"))

    return Continuous(events, partial, _summed(["bucket_time"], ["n", "units", "revenue", "_n"]), finish)


def _later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def sliding_stats_stream(events: DataFrame, ts: str, width: str = "1 hour", slide: str = "5 minutes") -> Continuous:
    """Rows per overlapping window; rows are counted per slide before the counts are copied to its windows."""
    step, overlaps = width_seconds(slide), width_seconds(width) // width_seconds(slide)

    def partial(rows: DataFrame) -> DataFrame:
        slides = rows.groupBy(time_bucket(slide, ts).alias("_slide")).agg(F.count(F.lit(1)).alias("n"))
        copies = F.when(F.col("_slide").isNull(), 0).otherwise(overlaps - 1)
        back = slides.select("_slide", "n", F.explode(F.sequence(F.lit(0), copies)).alias("_back"))
        return back.groupBy(_later(F.col("_slide"), -F.col("_back") * step).alias("window_start")).agg(F.sum("n").alias("n"))

    def finish(rows: DataFrame) -> DataFrame:
        return rows.select("window_start", _later(F.col("window_start"), F.lit(step * overlaps)).alias("window_end"), "n")

    return Continuous(events, partial, _summed(["window_start"], ["n"]), finish)


def session_stream(events: DataFrame, ts: str, key: str, gap: str = "30 minutes") -> Continuous:
    """Activity sessions per key, closed by ``gap`` of silence.

    A batch is reduced to its sessions; sessions of different batches that overlap or touch are one.  Rows
    without a time are counted in a session without bounds.  Merging orders sessions, not rows, in chunks of a range partitioning over
    keys and times: a key that holds most sessions is spread over several tasks.
    """
    def partial(rows: DataFrame) -> DataFrame:
        timed = rows.where(F.col(ts).isNotNull()).groupBy(F.col(key), F.session_window(ts, gap).alias("_w")).agg(
            F.count(F.lit(1)).alias("n")).select(key, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), "n")
        untimed = rows.where(F.col(ts).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return timed.unionByName(untimed, allowMissingColumns=True)

    def merge(partials: DataFrame) -> DataFrame:
        # Stretches that agree are one, so that the order is total.
        span = ["session_start", "session_end"]
        timed = partials.where(F.col("session_start").isNotNull()).groupBy(key, *span).agg(F.sum("n").alias("n"))
        reached = preceding_max(timed, span, "session_end", [key], "_reached")
        fresh = reached.withColumn("_fresh", F.coalesce((F.col("session_start") > F.col("_reached")).cast("long"), F.lit(1)))
        merged = running_total(fresh, span, {"_fresh": "_no"}, [key]).groupBy(key, "_no").agg(
            F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n").alias("n")).drop("_no")
        untimed = partials.where(F.col("session_start").isNull()).groupBy(key).agg(F.sum("n").alias("n"))
        return merged.unionByName(untimed, allowMissingColumns=True)

    return Continuous(events, partial, merge)


def recent_buckets(buckets: DataFrame, events: DataFrame, ts: str, bucket: str = "bucket_time", span: str = "1 HOUR") -> DataFrame:
    """Buckets that start within ``span`` of the newest event."""
    newest = events.agg(F.max(ts).alias("_newest")).scalar()
    return buckets.where(F.col(bucket) >= newest - F.expr(f"INTERVAL {span}"))


def drain_to_table(table: Continuous, path: str, checkpoint: str, every: str | None = None):
    """Maintain the table at ``path``; without ``every``, consume what is there now and stop."""
    def store(batch: DataFrame, batch_id: int) -> None:
        table.partial(batch).write.mode("overwrite").parquet(f"{path}/batches/batch_no={batch_id}")

    writer = table.stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _stored(spark: SparkSession, path: str, number: str) -> DataFrame | None:
    """The numbered folders under ``path``, or None before the first one."""
    try:
        return spark.read.option("basePath", path).parquet(f"{path}/{number}=*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _partials(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Everything stored, each batch once, and the number of the newest batch."""
    batches, folded = _stored(spark, f"{path}/batches", "batch_no"), _stored(spark, f"{path}/folded", "upto")
    newest = batches.agg(F.max("batch_no")).first()[0]
    newest = -1 if newest is None else newest
    if folded is None:
        return batches.drop("batch_no"), newest
    upto = folded.agg(F.max("upto")).first()[0]
    rest = batches.where(F.col("batch_no") > upto).drop("batch_no")
    return folded.where(F.col("upto") == upto).drop("upto").unionByName(rest), max(newest, upto)


def current_rows(spark: SparkSession, path: str, table: Continuous) -> DataFrame:
    """The table as of the batches stored so far."""
    return table.finish(table.merge(_partials(spark, path)[0]))


def compact(spark: SparkSession, path: str, table: Continuous) -> int:
    """Fold all batches so far into one folder; the number of the last one.

    Readers use the newest fold and the batches after it, so older folders may be deleted afterwards.
    Run it from one place at a time, while the stream goes on or stands still.
    """
    partials, newest = _partials(spark, path)
    # Sums of sums have wider types; the stored columns keep those of the batches.
    kept = [F.col(f.name).cast(f.dataType) for f in _stored(spark, f"{path}/batches", "batch_no").drop("batch_no").schema]
    table.merge(partials).select(*kept).write.mode("overwrite").parquet(f"{path}/folded/upto={newest}")
    return newest
