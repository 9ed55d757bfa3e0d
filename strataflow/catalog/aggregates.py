"""Plain aggregates and the seven pre-aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.functions import epoch_micros, time_bucket
from strataflow.plans import aggregates
from strataflow.plans.metrics import top_by

_AVG = "(CAST({total} AS DOUBLE) / CAST({count} AS DOUBLE))"


@query("total_amount_sum", """
SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount, COUNT(*) AS order_count FROM orders""")
def _(c: Canon) -> DataFrame:
    return shown(c.raw("orders").agg(
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total_amount"), F.count(F.lit(1)).alias("order_count")))


@query("amount_by_status", """
SELECT status, COUNT(*) AS order_count, CAST(SUM(total_amount) AS DOUBLE) AS total_amount FROM c_orders GROUP BY status""")
def _(c: Canon) -> DataFrame:
    return shown(c.orders().groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("total_amount")))


@query("top_orders", """
SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount FROM c_orders ORDER BY total_amount DESC, order_id LIMIT 10""")
def _(c: Canon) -> DataFrame:
    return shown(top_by(c.orders().select("order_id", "total_amount"), ["total_amount"], 10, "order_id"))


@query("daily_gmv", f"""
SELECT dt, order_count, CAST(gmv AS DOUBLE) AS gmv, {_AVG.format(total='gmv', count='order_count')} AS avg_order_amount
FROM dws_daily""")
def _(c: Canon) -> DataFrame:
    return shown(c.daily())


@query("minute_traffic", f"""
SELECT bucket_time, minute_order_count, CAST(minute_gmv AS DOUBLE) AS minute_gmv,
       {_AVG.format(total='minute_gmv', count='minute_order_count')} AS avg_order_amount FROM dws_minute""")
def _(c: Canon) -> DataFrame:
    return shown(c.minutes())


@query("product_daily_sales", """
SELECT order_date, sku_id, CAST(total_qty AS BIGINT) AS total_qty, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM dws_product""")
def _(c: Canon) -> DataFrame:
    return shown(c.product_days())


@query("user_purchase_stats", """
SELECT user_id, total_orders, CAST(total_spent AS DOUBLE) AS total_spent FROM dws_user""")
def _(c: Canon) -> DataFrame:
    return shown(c.user_stats())


@query("status_funnel", "SELECT status, order_count FROM dws_funnel")
def _(c: Canon) -> DataFrame:
    return c.funnel()


_LATENCY_SQL = """
SELECT ROUND(paid_to_shipped_hours, 6) AS paid_to_shipped_hours,
       ROUND(shipped_to_completed_hours, 6) AS shipped_to_completed_hours FROM dws_latency"""


@query("fulfilment_latency", _LATENCY_SQL)
def _(c: Canon) -> DataFrame:
    return shown(c.latency(), "paid_to_shipped_hours", "shipped_to_completed_hours")


@query("fulfilment_latency_selfjoin", _LATENCY_SQL)
def _(c: Canon) -> DataFrame:
    joined = aggregates.fulfilment_latency_joined(c.status_events())
    return shown(joined, "paid_to_shipped_hours", "shipped_to_completed_hours")


@query("promo_daily_compare", """
SELECT period, days, order_cnt, CAST(gmv AS DOUBLE) AS gmv, (daily_avg_gmv) AS daily_avg_gmv,
       (avg_order_value) AS avg_order_value FROM dws_promo""")
def _(c: Canon) -> DataFrame:
    return shown(c.promo_compare())


@query("bucket_15m", """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket_time, COUNT(*) AS n,
       (CAST(SUM(amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) AS avg_amount,
       (CAST(SUM(date_diff('microsecond', time_bucket(INTERVAL 15 MINUTE, ts), ts)) AS DOUBLE)
             / CAST(COUNT(*) AS DOUBLE) / 6.0e7) AS avg_offset_minutes
FROM activity GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    bucketed = c.activity().withColumn("bucket_time", time_bucket("15 minutes", "ts"))
    totals = bucketed.groupBy("bucket_time").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("_amount"),
        F.sum(epoch_micros("ts") - epoch_micros("bucket_time")).alias("_offset"))
    return shown(totals.select(
        "bucket_time", "n",
        (F.col("_amount").cast("double") / F.col("n")).alias("avg_amount"),
        (F.col("_offset").cast("double") / F.col("n") / 6.0e7).alias("avg_offset_minutes"),
    ))


@query("bucket_7d", """
SELECT time_bucket(INTERVAL 7 DAY, order_date) AS week_start, COUNT(*) AS order_count FROM c_orders GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    """Weeks that start on Monday: the origin decides."""
    week = time_bucket("7 days", "order_date", origin=datetime(2000, 1, 3))
    return c.orders().groupBy(week.alias("week_start")).agg(F.count(F.lit(1)).alias("order_count"))


@query("product_daily_sales_joined", """
SELECT order_date, sku_id, CAST(total_qty AS BIGINT) AS total_qty, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM dws_product""")
def _(c: Canon) -> DataFrame:
    """The status taken from the order fact by a fact-to-fact join, as when both are stored tables."""
    return shown(aggregates.product_daily_sales(c.detail_lines().drop("status"), c.order_core(), c.cfg))
