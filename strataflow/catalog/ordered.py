"""Order-dependent queries: running totals, lags, moving averages, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.functions import epoch_micros
from strataflow.operators.ordered import lagged, moving_average, ordinals, running_total
from strataflow.operators.quality import running_violations
from strataflow.plans import metrics


@query("running_total_all_days", "SELECT * FROM activity_running")
def _(c: Canon) -> DataFrame:
    return shown(metrics.gmv_running_total(c.activity_minutes()))


@query("running_total_rows", """
SELECT event_id, ts, CAST(SUM(amount) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_amount
FROM activity""")
def _(c: Canon) -> DataFrame:
    """Over single rows instead of minutes: chunks come from range partitioning."""
    return shown(running_total(c.activity(), ["ts", "event_id"], {"amount": "running_amount"}).select(
        "event_id", "ts", "running_amount"))


@query("running_total_violations", """
SELECT COUNT(*) AS violations FROM (
  SELECT running_gmv, LAG(running_gmv) OVER (ORDER BY bucket_time) AS before FROM activity_running) WHERE running_gmv < before""")
def _(c: Canon) -> DataFrame:
    running = metrics.gmv_running_total(c.activity_minutes())
    return running_violations(running).agg(F.count(F.lit(1)).alias("violations"))


@query("minute_change", """
SELECT bucket_time, minute_order_count, LAG(minute_order_count) OVER (ORDER BY bucket_time) AS previous FROM activity_minute""")
def _(c: Canon) -> DataFrame:
    minutes = c.activity_minutes().select("bucket_time", "minute_order_count")
    return lagged(minutes, ["bucket_time"], "minute_order_count", chunk=F.to_date("bucket_time"))


@query("rolling_avg", """
SELECT event_id, user_id, ts, (CAST(SUM(amount) OVER w AS DOUBLE) / CAST(COUNT(amount) OVER w AS DOUBLE)) AS moving_avg
FROM activity WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def _(c: Canon) -> DataFrame:
    rows = c.activity().select("event_id", "user_id", "ts", "amount")
    averaged = moving_average(rows, ["ts", "event_id"], "amount", 10, keys=["user_id"])
    return shown(averaged.drop("amount"))


@query("cumulative_daily_revenue", """
SELECT dt, order_count, CAST(gmv AS DOUBLE) AS gmv, CAST(SUM(gmv) OVER (ORDER BY dt) AS DOUBLE) AS cumulative_gmv
FROM dws_daily""")
def _(c: Canon) -> DataFrame:
    """A year has at most 366 days, so the year is the chunk."""
    daily = c.daily().select("dt", "order_count", "gmv")
    return shown(running_total(daily, ["dt"], {"gmv": "cumulative_gmv"}, chunk=F.year("dt")))


_RANKED = """
, product AS (SELECT p.category, d.sku_id, SUM(d.total_revenue) AS total_revenue
              FROM dws_product d JOIN c_products p ON d.sku_id = p.product_id GROUP BY p.category, d.sku_id)
"""


@query("rank_products_in_category", _RANKED + """
SELECT category, sku_id, CAST(total_revenue AS DOUBLE) AS total_revenue,
       ROW_NUMBER() OVER (PARTITION BY category ORDER BY total_revenue DESC, sku_id) AS row_no,
       RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC) AS rank_no FROM product""")
def _(c: Canon) -> DataFrame:
    return shown(metrics.rank_products_in_category(c.product_days(), c.products()))


@query("next_event_of_user", """
SELECT event_id, user_id, ts, LEAD(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event_id FROM activity""")
def _(c: Canon) -> DataFrame:
    """LEAD: the row after this one is the row before it on the reversed axis."""
    rows = c.activity().select(
        "event_id", "user_id", "ts", (-epoch_micros("ts")).alias("_back"), (-F.col("event_id")).alias("_back_id"))
    return lagged(rows, ["_back", "_back_id"], "event_id", keys=["user_id"], name="next_event_id").drop(
        "_back", "_back_id")


@query("ordered_with_gaps", """
, gaps AS (SELECT event_id, user_id, CASE WHEN event_id % 5 < 2 THEN NULL ELSE amount END AS amount FROM activity)
SELECT event_id, user_id, CAST(SUM(amount) OVER w AS DOUBLE) AS running_amount,
       RANK() OVER (ORDER BY user_id) AS rank_no
FROM gaps WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def _(c: Canon) -> DataFrame:
    """Sums that start with missing values, and ranks whose ties run over many chunks."""
    amount = F.when(F.col("event_id") % 5 >= 2, F.col("amount")).alias("amount")
    rows = c.activity().select("event_id", "user_id", amount)
    summed = running_total(rows, ["event_id"], {"amount": "running_amount"}, keys=["user_id"], pieces=16)
    ranked = ordinals(summed, ["user_id", "event_id"], rank=True, pieces=16)
    return shown(ranked.select("event_id", "user_id", "running_amount", F.col("rank_no").cast("long").alias("rank_no")))
