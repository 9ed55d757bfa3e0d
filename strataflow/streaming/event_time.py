"""Aggregates, sessions and deduplication with event-time state.

Where ``continuous`` merges partial results and counts every row however late, the streams here keep their open windows, sessions and keys in
the state store and drop them once the watermark has passed: state is bounded by the delay, and a row that comes later than that is dropped.
Append mode hands out a window once, when nothing can change it any more; update mode hands out what a batch has changed.

Watermarks need instants.  A wall clock becomes the instant at which UTC shows it and is turned back afterwards, so the session's zone
and its summer time have no say in buckets or gaps.  Rows without a time belong to no window and are left out.

A batch is stored in a folder named by its number, which a replay writes again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions import safe_ratio, wall
from strataflow.functions.timing import epoch_micros, width_seconds

_AT = "_at"
BATCH = "batch_no"


def instant(ts: Column | str) -> Column:
    """The instant at which clocks in UTC show the wall clock ``ts``."""
    return F.timestamp_micros(epoch_micros(ts))


def clock(at: Column | str) -> Column:
    """The wall clock that UTC shows at an instant; the inverse of ``instant``."""
    micros = F.unix_micros(F.col(at) if isinstance(at, str) else at)
    return F.timestamp_add("MICROSECOND", micros, wall(datetime(1970, 1, 1)))


def timed(events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows with a time and the watermark ``delay`` behind the newest of them."""
    return events.where(F.col(ts).isNotNull()).withColumn(_AT, instant(ts)).withWatermark(_AT, delay)


def windowed(
    events: DataFrame, ts: str, width: str, delay: str, measures: Sequence[Column], keys: Sequence[str] = (),
    slide: str | None = None, start: str = "bucket_time",
) -> DataFrame:
    """``measures`` per window of ``width`` and ``keys``; windows overlap where ``slide`` is shorter than ``width``.

    A window that starts every ``slide`` is one state entry per slide and key, at most (delay + width) / slide of them open at a time.
    """
    for span in (width, slide or width):
        width_seconds(span)  # whole seconds, so that a window is the same stretch of every day
    grouped = timed(events, ts, delay).groupBy(F.window(_AT, width, slide or width).alias("_w"), *keys).agg(*measures)
    measured = grouped.columns[1 + len(keys):]
    return grouped.select(clock(F.col("_w.start")).alias(start), *keys, *measured)


def minute_orders(events: DataFrame, ts: str, amount: str, delay: str) -> DataFrame:
    """Orders and amount per minute."""
    return windowed(events, ts, "1 minute", delay, [F.count(F.lit(1)).alias("minute_order_count"), F.sum(amount).alias("minute_gmv")])


def bucket_stats(events: DataFrame, ts: str, amount: str, units: str, delay: str, width: str = "5 minutes") -> DataFrame:
    """Count, two sums and a mean per bucket."""
    rows = windowed(events, ts, width, delay, [
        F.count(F.lit(1)).alias("n"), F.sum(units).alias("units"), F.sum(amount).alias("revenue"), F.count(amount).alias("_n")])
    return rows.select("bucket_time", "n", "units", "revenue", safe_ratio(F.col("revenue"), F.col("_n")).alias("avg_amount"))


def sessions(events: DataFrame, ts: str, key: str, gap: str, delay: str) -> DataFrame:
    """Sessions per key, handed out once the watermark has passed their end: append mode.

    A batch merges its own rows into sessions before they meet the state, so a key that holds most rows is a few sessions by then.
    """
    grouped = timed(events, ts, delay).groupBy(F.col(key), F.session_window(_AT, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(key, clock(F.col("_w.start")).alias("session_start"), clock(F.col("_w.end")).alias("session_end"), "n")


def deduplicated(events: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first row of every key; repeats are dropped until the watermark is ``delay`` past the first one, and are rows of their own after that.

    Two repeats of which each is within ``delay`` of the first are always caught, whatever the batches they come in.  The state holds the keys of the
    last two delays or so, never all that were seen.
    """
    return timed(events, ts, delay).dropDuplicatesWithinWatermark(list(keys)).drop(_AT)


def store_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Write each batch of the stream into its own folder; without ``every``, take what is there now and stop."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def emitted(spark: SparkSession, path: str) -> DataFrame:
    """Everything an append stream has stored."""
    return spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*").drop(BATCH)


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """What an update stream has stored last for every key."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*")
    values = [c for c in rows.columns if c not in keys and c != BATCH]
    newest = rows.groupBy(*keys).agg(F.max(F.struct(BATCH, *values)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def state_rows(query: StreamingQuery) -> list[int]:
    """Entries in the state store after each batch."""
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
