"""Running totals kept up to date with a stream: totals of days are the state that carries over.

A batch adds its rows to the minutes of their days and to the totals of these days; both are stored as sums in partitions of a day and of a year.
What a day's first minute continues from is the sum of the days before it, taken from one row per day when the table is read.  So a batch
rewrites the days it has rows of and no others, and a late row moves every later day without touching it.  Batches may come in any
order; a replayed one finds its number in the partitions and adds nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions import time_bucket
from strataflow.operators.ordered import running_total
from strataflow.plans.incremental import Increment, refresh_changed
from strataflow.sinks.changes import SIGN

_DAY = "_part"


def _sums(amount: str) -> dict[str, tuple[Column, str]]:
    return {"minute_gmv": (F.coalesce(F.col(amount), F.lit(0)), "decimal(38,2)"), "_known": (F.col(amount).isNotNull().cast("int"), "long")}


def minutes_of(ts: str, amount: str) -> Increment:
    """Sums per minute, a partition per day."""
    return Increment("minutes", {"bucket_time": time_bucket("1 minute", ts)}, _sums(amount), F.to_date("bucket_time"), lambda rows: rows)


def days_of(ts: str, amount: str) -> Increment:
    """Sums per day, a partition per year."""
    return Increment("days", {"day": F.to_date(ts)}, _sums(amount), F.year("day"), lambda rows: rows)


def add_batch(spark: SparkSession, root: str, batch: DataFrame, ts: str, amount: str, batch_no: int) -> int:
    """Adds a batch of rows; the number of days written.  Rows without a time have no place in the series and are left out."""
    rows = batch.where(F.col(ts).isNotNull()).withColumn(SIGN, F.lit(1))
    written = refresh_changed(spark, root, minutes_of(ts, amount), rows, batch_no)
    refresh_changed(spark, root, days_of(ts, amount), rows, batch_no)
    return written


def running_rows(spark: SparkSession, root: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """(bucket_time, minute_gmv, running_gmv, minute_order_count, running_order_count) of all days, or of those from ``first`` to ``last``.

    Only the wanted days' minutes are read, and one row for each day there is.  A day has at most 1,440 minutes, so a window within it is bounded.
    """
    days = spark.read.parquet(f"{root}/days").where("_rows > 0")
    opened = running_total(days, ["day"], {"minute_gmv": "_gmv", "_known": "_seen", "_rows": "_orders"}, chunk=F.col(_DAY)).select(
        "day", (F.col("_gmv") - F.col("minute_gmv")).alias("_gmv"), (F.col("_seen") - F.col("_known")).alias("_seen"), (F.col("_orders") - F.col("_rows")).alias("_orders"))
    minutes = spark.read.parquet(f"{root}/minutes").where("_rows > 0")
    if first is not None:
        minutes = minutes.where(F.col(_DAY) >= F.lit(first))
    if last is not None:
        minutes = minutes.where(F.col(_DAY) <= F.lit(last))
    inside = Window.partitionBy(_DAY).orderBy("bucket_time").rowsBetween(Window.unboundedPreceding, 0)
    so_far = minutes.withColumns({
        "_day_gmv": F.sum("minute_gmv").over(inside), "_day_seen": F.sum("_known").over(inside), "_day_orders": F.sum("_rows").over(inside)})
    carried = so_far.join(opened, F.col(_DAY) == F.col("day"))
    return carried.select(
        "bucket_time", F.when(F.col("_known") > 0, F.col("minute_gmv")).alias("minute_gmv"),
        F.when(F.col("_seen") + F.col("_day_seen") > 0, F.col("_gmv") + F.col("_day_gmv")).alias("running_gmv"),
        F.col("_rows").alias("minute_order_count"), (F.col("_orders") + F.col("_day_orders")).alias("running_order_count"))


def drain_running(stream: DataFrame, root: str, checkpoint: str, ts: str, amount: str, every: str | None = None) -> tuple[StreamingQuery, list[int]]:
    """Maintains the series under ``root``; the query and the number of days each batch has written."""
    written: list[int] = []

    def add(batch: DataFrame, batch_id: int) -> None:
        written.append(add_batch(batch.sparkSession, root, batch, ts, amount, batch_id))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    if every is not None:
        return writer.trigger(processingTime=every).start(), written
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query, written
