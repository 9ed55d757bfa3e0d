"""Distinct counts from stored bitmaps and sketches, exact cut points, and interval joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.catalog.streams import _arriving, _drained
from strataflow.functions import time_bucket
from strataflow.operators.intervals import interval_join
from strataflow.operators.selection import percentiles, with_tile
from strataflow.plans import distinct
from strataflow.plans.aggregates import valid_orders


def _buyer_days(c: Canon) -> DataFrame:
    """Bitmaps of the paying users of each day, by dense numbers of a dictionary."""
    orders = valid_orders(c.order_core(), c.cfg)
    numbers = distinct.dense_numbers(c.users(), "user_id")
    return distinct.stored_bitmaps(orders.join(numbers, "user_id"), ["order_date"], "key_no", "buyer-days")


@query("distinct_buyers_month", """
SELECT CAST(year(order_date) * 100 + month(order_date) AS INTEGER) AS ym, COUNT(DISTINCT user_id) AS paying_users FROM valid GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    days = _buyer_days(c)
    return distinct.distinct_counts(days, [(F.year("order_date") * 100 + F.month("order_date")).alias("ym")], "paying_users")


@query("distinct_buyers_7d", """
, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS last_day FROM orders)
SELECT last_day - 6 AS first_day, last_day, (SELECT COUNT(DISTINCT user_id) FROM valid WHERE order_date BETWEEN last_day - 6 AND last_day) AS paying_users FROM days""")
def _(c: Canon) -> DataFrame:
    """Different buyers of the seven days up to every day with orders."""
    days = c.order_core().select(F.col("order_date").alias("last_day")).distinct()
    ranges = days.select(F.date_sub("last_day", 6).alias("first_day"), "last_day")
    return distinct.distinct_in_ranges(_buyer_days(c), "order_date", ranges, "paying_users")


@query("distinct_orders_status", "SELECT status, order_count FROM dws_funnel")
def _(c: Canon) -> DataFrame:
    """Orders per reached status from daily bitmaps of their ids."""
    events = c.status_events().withColumn("event_date", F.to_date("event_time"))
    days = distinct.stored_bitmaps(events, ["event_date", F.col("to_status").alias("status")], "order_id", "status-days")
    return distinct.distinct_counts(days, ["status"], "order_count")


@query("stream_distinct_users", "SELECT date_trunc('day', ts) AS day, COUNT(DISTINCT user_id) AS users FROM activity GROUP BY 1")
def _(c: Canon) -> DataFrame:
    """Exact distinct users per day, which a stream's own aggregation refuses to count."""
    stream = distinct.distinct_stream(_arriving(c), [time_bucket("1 day", "ts").alias("day")], "user_id", "users")
    return _drained(c, stream, "distinct-users", fold=True)


@query("sketch_orders_status", "SELECT status, order_count, TRUE AS days_within_bound, TRUE AS whole_within_bound FROM dws_funnel")
def _(c: Canon) -> DataFrame:
    """Estimates from united daily sketches and from one sketch of everything, next to the exact count."""
    events = c.event_fact().withColumnRenamed("to_status", "status")
    days = distinct.merged_sketches(distinct.sketches(events, ["event_date", "status"], "order_id"), ["status"])
    both = distinct.estimates(days, "_days").join(distinct.estimates(distinct.sketches(events, ["status"], "order_id"), "_whole"), "status")
    near = lambda name: F.abs(F.col(name) - F.col("order_count")) <= F.col("order_count") * distinct.ERROR_BOUND
    return both.join(c.funnel(), "status").select(
        "status", "order_count", near("_days").alias("days_within_bound"), near("_whole").alias("whole_within_bound"))


@query("stream_sketch_users", "SELECT date_trunc('day', ts) AS day, COUNT(DISTINCT user_id) AS users, TRUE AS within_bound FROM activity GROUP BY 1")
def _(c: Canon) -> DataFrame:
    """Users per day by sketches of a stream's batches."""
    day = time_bucket("1 day", "ts").alias("day")
    stream = _drained(c, distinct.sketch_stream(_arriving(c), [day], "user_id", "estimate"), "sketch-users", fold=True)
    exact = c.activity().groupBy(day).agg(F.count_distinct("user_id").alias("users"))
    return stream.join(exact, "day").select("day", "users", (F.abs(F.col("estimate") - F.col("users")) <= F.col("users") * distinct.ERROR_BOUND).alias("within_bound"))


# Cut points

@query("user_segment_selection", """
SELECT CASE tile WHEN 3 THEN 'high' WHEN 2 THEN 'mid' ELSE 'low' END AS segment, COUNT(*) AS user_count, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(MIN(total_spent) AS DOUBLE) AS least, CAST(MAX(total_spent) AS DOUBLE) AS most
FROM (SELECT *, NTILE(3) OVER (ORDER BY total_spent, user_id) AS tile FROM dws_user) GROUP BY tile""")
def _(c: Canon) -> DataFrame:
    """Exact terciles of spending by cut points instead of a sort."""
    tiled = with_tile(c.user_stats(), "total_spent", "user_id", 3)
    segment = F.when(F.col("tile") == 3, "high").when(F.col("tile") == 2, "mid").otherwise("low")
    return shown(tiled.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("user_count"), F.sum("total_orders").alias("total_orders"), F.min("total_spent").alias("least"), F.max("total_spent").alias("most")))


_PARTS = (1, 25, 50, 75, 90, 99, 100)


@query("amount_percentiles", f"""
, ranked AS (SELECT total_amount, ROW_NUMBER() OVER (ORDER BY total_amount) AS place, COUNT(*) OVER () AS n FROM f_order)
SELECT CAST(p AS INTEGER) AS percent, CAST(total_amount AS DOUBLE) AS total_amount
FROM (VALUES {', '.join(f'({p})' for p in _PARTS)}) AS t(p) JOIN ranked ON place = greatest((n * p + 99) // 100, 1)""")
def _(c: Canon) -> DataFrame:
    rows = c.order_core()
    return shown(c.spark.createDataFrame(list(zip(_PARTS, percentiles(rows, "total_amount", _PARTS))), "percent int, total_amount decimal(12,2)"))


@query("price_percentiles_by_units", f"""
, summed AS (SELECT unit_price, SUM(SUM(qty)) OVER (ORDER BY unit_price) AS upto, SUM(SUM(qty)) OVER () AS total FROM c_items GROUP BY unit_price)
SELECT CAST(p AS INTEGER) AS percent, CAST(MIN(unit_price) AS DOUBLE) AS unit_price
FROM (VALUES {', '.join(f'({p})' for p in _PARTS)}) AS t(p) JOIN summed ON upto * 100 >= total * p GROUP BY p""")
def _(c: Canon) -> DataFrame:
    """Prices below which a share of all units sold lies: lines weighted by their quantity."""
    found = percentiles(c.items(), "unit_price", _PARTS, weight=F.col("qty").cast("long"))
    return shown(c.spark.createDataFrame(list(zip(_PARTS, found)), "percent int, unit_price decimal(10,2)"))


# Intervals

@query("promo_by_time_range", """
, years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
sales AS (
  SELECT 1 AS sale_id, make_timestamp(y, 11, 1, 8, 0, 0) AS sale_start, make_timestamp(y, 11, 10, 22, 30, 0) AS sale_end FROM years
  UNION ALL SELECT 2, make_timestamp(y, 11, 11, 0, 0, 0), make_timestamp(y, 11, 12, 0, 0, 0) FROM years
  UNION ALL SELECT 3, make_timestamp(y, 11, 5, 12, 0, 0), make_timestamp(y, 11, 20, 12, 0, 0) FROM years
  UNION ALL SELECT 4, make_timestamp(y, 6, 18, 20, 0, 0), make_timestamp(y, 6, 18, 20, 0, 0) FROM years
  UNION ALL SELECT 5, make_timestamp(y, 6, 18, 20, 0, 0), make_timestamp(y, 6, 1, 20, 0, 0) FROM years
  UNION ALL SELECT 6, NULL, TIMESTAMP '1993-02-03 04:05:06' UNION ALL SELECT 7, TIMESTAMP '1997-08-09 10:11:12', NULL)
SELECT CAST(sale_id AS INTEGER) AS sale_id, COUNT(*) AS orders, CAST(SUM(total_amount) AS DOUBLE) AS gmv
FROM f_order LEFT JOIN sales ON order_time >= COALESCE(sale_start, TIMESTAMP '1900-01-01') AND order_time < COALESCE(sale_end, TIMESTAMP '2200-01-01')
GROUP BY sale_id""")
def _(c: Canon) -> DataFrame:
    """Sales with hours: overlapping, open, empty and turned ones; orders in none are a group of their own."""
    years = c.raw("orders").select(F.year("o_orderdate").alias("y")).distinct()

    def sale(number: int, start: tuple[int, ...], end: tuple[int, ...]):
        at = lambda t: F.make_timestamp_ntz(F.col("y"), *[F.lit(v) for v in t], F.lit(0).cast("decimal(16,6)"))
        return F.struct(F.lit(number).alias("sale_id"), at(start).alias("sale_start"), at(end).alias("sale_end"))

    yearly = years.select(F.inline(F.array(
        sale(1, (11, 1, 8, 0), (11, 10, 22, 30)), sale(2, (11, 11, 0, 0), (11, 12, 0, 0)), sale(3, (11, 5, 12, 0), (11, 20, 12, 0)),
        sale(4, (6, 18, 20, 0), (6, 18, 20, 0)), sale(5, (6, 18, 20, 0), (6, 1, 20, 0)))))
    open_ended = c.spark.sql(
        "SELECT 6 AS sale_id, CAST(NULL AS TIMESTAMP_NTZ) AS sale_start, TIMESTAMP_NTZ '1993-02-03 04:05:06' AS sale_end "
        "UNION ALL SELECT 7, TIMESTAMP_NTZ '1997-08-09 10:11:12', NULL")
    joined = interval_join(c.order_core(), "order_time", yearly.unionByName(open_ended), "sale_start", "sale_end", "left")
    return shown(joined.groupBy("sale_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("gmv")))


@query("payments_in_windows", """
, windows AS (SELECT order_id AS window_id, order_date AS opens, order_date + to_hours(CAST(order_id % 97 AS BIGINT)) AS closes FROM c_orders WHERE order_id % 100 < 3)
SELECT window_id, COUNT(*) AS payments, CAST(SUM(amount) AS DOUBLE) AS amount FROM windows JOIN c_payments ON pay_date >= opens AND pay_date < closes GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    """Payments that came while a window of up to four days was open, for windows opened by one order in thirty."""
    key = F.col("order_id")
    windows = c.orders().where(key % 100 < 3).select(
        key.alias("window_id"), F.col("order_date").alias("opens"), F.timestamp_add("HOUR", key % 97, F.col("order_date")).alias("closes"))
    held = interval_join(c.payments().select("pay_date", "amount"), "pay_date", windows, "opens", "closes", totals={"payments": None, "amount": "amount"})
    return shown(held.groupBy("window_id").agg(F.sum("payments").alias("payments"), F.sum("amount").alias("amount")))
