"""Event-time state over the event table as it arrives in eight stretches, some rows one stretch late and some far too late."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.functions import epoch_micros, wall
from strataflow.session import scratch_path
from strataflow.sources import arriving_in_lots
from strataflow.streaming import bucket_stats, deduplicated, emitted, latest, minute_orders, sessions, store_batches

FIRST, STRETCH_HOURS, STRETCHES = datetime(2024, 1, 1), 90, 8
# Two stretches and an hour: a row that is one stretch late is in time, wherever the batches are cut.
DELAY = "181 hours"


def _stretch() -> Column:
    return F.floor((epoch_micros("ts") - epoch_micros(wall(FIRST))) / (STRETCH_HOURS * 3_600_000_000)).cast("int")


def _arrival() -> Column:
    """Events of one user in five come a stretch late; every eleventh event of the first three stretches comes with the last, long after its window."""
    own = _stretch()
    late = F.when(F.col("user_id") % 5 == 0, F.least(own + 1, F.lit(STRETCHES - 1))).otherwise(own)
    return F.when((F.col("event_id") % 11 == 0) & (own < 3), STRETCHES - 1).otherwise(late)


def _arriving(c: Canon, rows: DataFrame) -> DataFrame:
    """The rows as a stream, stretch after stretch."""
    stretches = [rows.where(F.col("arrival") == at).drop("arrival") for at in range(STRETCHES)]
    return arriving_in_lots(c.spark, stretches, scratch_path(c.spark, "stretches"))


def _events(c: Canon) -> DataFrame:
    rows = c.activity().select("event_id", "ts", "user_id", "amount")
    return rows.withColumn("arrival", _arrival())


def _stored(c: Canon, stream: DataFrame, label: str, mode: str, read: Callable[..., DataFrame], *keys) -> DataFrame:
    path = scratch_path(c.spark, label)
    store_batches(stream, path, scratch_path(c.spark, f"{label}-checkpoint"), mode)
    return read(c.spark, path, *keys)


_IN_TIME = """
, stretched AS (SELECT *, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) // 324000000000 AS stretch FROM activity),
in_time AS (SELECT * FROM stretched WHERE NOT (event_id % 11 = 0 AND stretch < 3)),
passed AS (SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 181 HOUR AS mark FROM activity)"""


@query("stream_event_minutes", _IN_TIME + """
SELECT bucket_time, minute_order_count, CAST(minute_gmv AS DOUBLE) AS minute_gmv FROM (
  SELECT date_trunc('minute', ts) AS bucket_time, COUNT(*) AS minute_order_count, SUM(amount) AS minute_gmv FROM in_time GROUP BY 1)
WHERE bucket_time + INTERVAL 1 MINUTE <= (SELECT mark FROM passed)""")
def _(c: Canon) -> DataFrame:
    """Minutes that the watermark has closed, each handed out once."""
    stream = minute_orders(_arriving(c, _events(c)), "ts", "amount", DELAY)
    return shown(_stored(c, stream, "event-minutes", "append", emitted))


@query("stream_event_5m", _IN_TIME + """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket_time, COUNT(*) AS n, CAST(SUM(user_id) AS BIGINT) AS units,
       CAST(SUM(amount) AS DOUBLE) AS revenue, (CAST(SUM(amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) AS avg_amount
FROM in_time GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    """The newest state of every five minutes, open ones too."""
    stream = bucket_stats(_arriving(c, _events(c)), "ts", "amount", "user_id", DELAY)
    return shown(_stored(c, stream, "event-5m", "update", latest, ["bucket_time"]))


@query("stream_event_dropped", _IN_TIME + """
SELECT (SELECT COUNT(*) FROM activity) AS rows_in, COUNT(*) AS rows_counted, (SELECT COUNT(*) FROM activity) - COUNT(*) AS rows_dropped FROM in_time""")
def _(c: Canon) -> DataFrame:
    """Rows that came after their window had been closed are in no window."""
    events = _events(c)
    stream = minute_orders(_arriving(c, events), "ts", "amount", DELAY)
    counted = _stored(c, stream, "event-dropped", "update", latest, ["bucket_time"]).agg(F.sum("minute_order_count").alias("rows_counted"))
    came = events.agg(F.count(F.lit(1))).scalar()
    return counted.select(came.alias("rows_in"), "rows_counted", (came - F.col("rows_counted")).alias("rows_dropped"))


@query("stream_event_sessions", _IN_TIME + """
, marked AS (SELECT user_id, ts, CASE WHEN ts <= LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
                                 THEN 0 ELSE 1 END AS fresh FROM in_time),
numbered AS (SELECT user_id, ts, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT * FROM (SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS n FROM numbered GROUP BY user_id, s)
WHERE session_end <= (SELECT mark FROM passed)""")
def _(c: Canon) -> DataFrame:
    """Sessions that the watermark has closed."""
    return _stored(c, sessions(_arriving(c, _events(c)), "ts", "user_id", "30 minutes", DELAY), "event-sessions", "append", emitted)


@query("stream_dedup", """
, stretched AS (SELECT *, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) // 324000000000 AS stretch FROM activity)
SELECT event_id, ts, CAST(amount AS DOUBLE) AS amount FROM activity
UNION ALL SELECT event_id, ts + INTERVAL 630 HOUR, CAST(amount AS DOUBLE) FROM stretched WHERE event_id % 3 = 0 AND stretch = 0""")
def _(c: Canon) -> DataFrame:
    """Every other event is sent again a stretch later and dropped; a third of the first ones is sent anew seven stretches on, when its key is forgotten."""
    rows = c.activity().select("event_id", "ts", "amount").withColumn("arrival", _stretch())
    again = rows.where((F.col("event_id") % 2 == 0) & (F.col("arrival") < STRETCHES - 1)).withColumn("arrival", F.col("arrival") + 1)
    anew = rows.where((F.col("event_id") % 3 == 0) & (F.col("arrival") == 0)).withColumn(
        "ts", F.timestamp_add("HOUR", F.lit((STRETCHES - 1) * STRETCH_HOURS), F.col("ts"))).withColumn("arrival", F.lit(STRETCHES - 1))
    stream = deduplicated(_arriving(c, rows.unionByName(again).unionByName(anew)), ["event_id"], "ts", DELAY)
    return shown(_stored(c, stream, "event-dedup", "append", emitted))
