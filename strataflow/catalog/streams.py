"""Continuous aggregates over the event table read as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.plans import metrics
from strataflow.session import scratch_path
from strataflow.sources import arriving_in_lots
from strataflow.streaming import (
    Continuous,
    bucket_stats_stream,
    compact,
    current_rows,
    drain_to_table,
    minute_gmv_stream,
    recent_buckets,
    session_stream,
    sliding_stats_stream,
)
from strataflow.streaming.running import drain_running, running_rows


def _events(c: Canon) -> DataFrame:
    return c.raw("events").select("event_id", "ts", "user_id", F.col("value").cast("decimal(10,2)").alias("amount"))


def _arriving(c: Canon, lots: int = 6) -> DataFrame:
    """The event table in lots that arrive one per batch, each holding rows of all times."""
    parts = [_events(c).where(F.pmod(F.xxhash64("event_id"), F.lit(lots)) == part) for part in range(lots)]
    return arriving_in_lots(c.spark, parts, scratch_path(c.spark, "arriving"))


def _drained(c: Canon, table: Continuous, label: str, fold: bool = False) -> DataFrame:
    """Run the stream over everything present and return the table it maintains."""
    path = scratch_path(c.spark, label)
    drain_to_table(table, path, scratch_path(c.spark, f"{label}-checkpoint"))
    if fold:
        compact(c.spark, path, table)
    return current_rows(c.spark, path, table)


@query("stream_minute_gmv", """
SELECT bucket_time, minute_order_count, CAST(minute_gmv AS DOUBLE) AS minute_gmv FROM activity_minute""")
def _(c: Canon) -> DataFrame:
    return shown(_drained(c, minute_gmv_stream(_arriving(c), "ts", "amount"), "minute-gmv"))


_FIVE = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket_time, COUNT(*) AS n, CAST(SUM(user_id) AS BIGINT) AS units,
       CAST(SUM(amount) AS DOUBLE) AS revenue, (CAST(SUM(amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) AS avg_amount
FROM activity GROUP BY 1"""


@query("stream_5m_stats", _FIVE)
def _(c: Canon) -> DataFrame:
    stream = bucket_stats_stream(_arriving(c), "ts", "amount", "user_id")
    return shown(_drained(c, stream, "five-minutes", fold=True))


@query("stream_recent", f"""
SELECT * FROM ({_FIVE}) WHERE bucket_time >= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""")
def _(c: Canon) -> DataFrame:
    """The last hour of the continuous aggregate, counted back from the newest event."""
    stream = bucket_stats_stream(_arriving(c), "ts", "amount", "user_id")
    buckets = _drained(c, stream, "recent")
    return shown(recent_buckets(buckets, c.raw("events"), "ts"))


@query("stream_sliding", """
SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, COUNT(*) AS n
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * k) AS s FROM events CROSS JOIN generate_series(0, 11) AS g(k))
GROUP BY s""")
def _(c: Canon) -> DataFrame:
    return _drained(c, sliding_stats_stream(_arriving(c), "ts"), "sliding")


@query("stream_session", """
, marked AS (SELECT user_id, ts, CASE WHEN ts <= LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
                                 THEN 0 ELSE 1 END AS fresh FROM events),
numbered AS (SELECT user_id, ts, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS n
FROM numbered GROUP BY user_id, s""")
def _(c: Canon) -> DataFrame:
    """Sessions of each batch, merged across batches."""
    return _drained(c, session_stream(_arriving(c), "ts", "user_id"), "session")


@query("stream_running_total", "SELECT * FROM activity_running")
def _(c: Canon) -> DataFrame:
    """A stream cannot hold an ordered running sum; it is taken over the minute table the stream maintains."""
    minutes = _drained(c, minute_gmv_stream(_arriving(c), "ts", "amount"), "running")
    return shown(metrics.gmv_running_total(minutes))


@query("stream_out_of_order", "SELECT COUNT(*) AS rows_in, COUNT(*) AS rows_out, 0 AS rows_lost FROM events")
def _(c: Canon) -> DataFrame:
    """Every row of many batches out of time order is in the maintained table."""
    minutes = _drained(c, minute_gmv_stream(_arriving(c), "ts", "amount"), "unordered")
    counted = minutes.agg(F.sum("minute_order_count").alias("rows_out"))
    return counted.select(
        F.lit(_events(c).count()).alias("rows_in"), "rows_out", (F.lit(_events(c).count()) - F.col("rows_out")).cast("int").alias("rows_lost"))


@query("stream_equals_batch", "SELECT COUNT(*) AS minutes, 0 AS different FROM activity_minute")
def _(c: Canon) -> DataFrame:
    """The maintained minute table against the same aggregate taken in one batch."""
    stream = _drained(c, minute_gmv_stream(_arriving(c), "ts", "amount"), "twin", fold=True).withColumnsRenamed(
        {"bucket_time": "_time", "minute_order_count": "_count", "minute_gmv": "_gmv"})
    both = c.activity_minutes().join(stream, F.col("bucket_time").eqNullSafe(F.col("_time")), "full")
    same = F.col("minute_order_count").eqNullSafe(F.col("_count")) & F.col("minute_gmv").eqNullSafe(F.col("_gmv"))
    return both.agg(F.count(F.lit(1)).alias("minutes"), F.count_if(~same).cast("int").alias("different"))


@query("stream_running_carried", "SELECT * FROM activity_running")
def _(c: Canon) -> DataFrame:
    """The running total from carried day totals, over batches without order."""
    root = scratch_path(c.spark, "running")
    drain_running(_arriving(c, 3), root, scratch_path(c.spark, "running-checkpoint"), "ts", "amount")
    return shown(running_rows(c.spark, root))


_LATE = "event_id % 97 = 0 AND day(ts) <= 5"


@query("stream_running_late", f"""
, placed AS (SELECT ts, CASE WHEN {_LATE} THEN 3 ELSE least((day(ts) - 1) // 10, 2) END AS batch FROM activity),
written AS (SELECT CAST(batch AS INTEGER) AS batch, COUNT(DISTINCT CAST(ts AS DATE)) AS days_written FROM placed GROUP BY batch)
SELECT batch, days_written, (SELECT CAST(SUM(amount) AS DOUBLE) FROM activity) AS total FROM written""")
def _(c: Canon) -> DataFrame:
    """Three batches of ten days each and one of rows that come late: the days each one writes are its own, and the last total has everything."""
    root = scratch_path(c.spark, "running")
    place = F.when(F.expr(_LATE), 3).otherwise(F.least(F.floor((F.day("ts") - 1) / 10), F.lit(2)))
    stream = arriving_in_lots(c.spark, [_events(c).where(place == number) for number in range(4)], scratch_path(c.spark, "by-day"))
    _, written = drain_running(stream, root, scratch_path(c.spark, "cp"), "ts", "amount")
    rows = c.spark.createDataFrame(list(enumerate(written)), "batch int, days_written long")
    return shown(rows.withColumn("total", running_rows(c.spark, root).agg(F.max_by("running_gmv", "bucket_time")).scalar()))
