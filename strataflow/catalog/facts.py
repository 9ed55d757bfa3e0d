"""Fact tables and the joins behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.operators import quality
from strataflow.plans import dims, facts, metrics


@query("order_fact", """
, paid AS (SELECT order_id, MIN(pay_date) AS pay_time FROM c_payments GROUP BY order_id),
closed AS (SELECT order_id, MIN(event_time) FILTER (WHERE to_status = 'cancelled') AS cancel_time,
                  MIN(event_time) FILTER (WHERE to_status = 'completed') AS finish_time FROM c_events GROUP BY order_id)
SELECT order_id, user_id, order_date, order_time, region_id, promo_id, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(0 AS DOUBLE) AS freight_amount, CAST(COALESCE(discount_amount, 0) AS DOUBLE) AS discount_amount, pay_time,
       cancel_time, finish_time, source_type, status
FROM f_order LEFT JOIN paid USING (order_id) LEFT JOIN closed USING (order_id) LEFT JOIN f_discount USING (order_id)""")
def _(c: Canon) -> DataFrame:
    """All orders cost at least the free-freight limit here; freight_bounds covers the other branch."""
    return shown(c.order_fact())


@query("order_detail_fact", """
SELECT order_id, user_id, sku_id, order_date, order_time, region_id, promo_id, sku_num,
       CAST(original_price AS DOUBLE) AS original_price, CAST(final_price AS DOUBLE) AS final_price,
       CAST(line_amount AS DOUBLE) AS line_amount, source_type FROM f_detail""")
def _(c: Canon) -> DataFrame:
    return shown(facts.order_detail_fact(c.items(), c.orders(), c.users(), c.region(), c.promotions()))


@query("status_event_fact", """
SELECT event_id, order_id, user_id, from_status, to_status, event_time, event_date, operator_type FROM f_event""")
def _(c: Canon) -> DataFrame:
    return c.event_fact()


@query("order_discount", "SELECT order_id, CAST(discount_amount AS DOUBLE) AS discount_amount FROM f_discount")
def _(c: Canon) -> DataFrame:
    return shown(facts.order_discount(c.items(), c.orders(), c.promotions()))


@query("region_match_rate", """
SELECT CAST(COUNT(*) FILTER (WHERE region_id <> 0) AS BIGINT) AS matched, COUNT(*) AS orders,
       (CAST(COUNT(*) FILTER (WHERE region_id <> 0) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE)) AS match_pct FROM f_order""")
def _(c: Canon) -> DataFrame:
    return shown(quality.region_match(c.placed_orders()))


@query("promo_by_date_range", """
, periods AS (
  SELECT p.promo_id, make_date(y, 11, p.d1) AS start_date, make_date(y, 11, p.d2) AS end_date, p.rate
  FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
  CROSS JOIN (VALUES (1, 1, 10, 0.10), (2, 11, 11, 0.25), (3, 12, 14, 0.15)) AS p(promo_id, d1, d2, rate))
SELECT f.order_id, f.order_date, p.promo_id AS range_promo_id, CAST(p.rate AS DOUBLE) AS discount_rate
FROM f_order f LEFT JOIN periods p ON f.order_date BETWEEN p.start_date AND p.end_date""")
def _(c: Canon) -> DataFrame:
    return shown(metrics.promo_by_date_range(
        c.order_core().select("order_id", "order_date"), c.promotion_periods()
    ).select("order_id", "order_date", "range_promo_id", "discount_rate"))


@query("daily_buyers_by_calendar", """
SELECT order_date AS date_key, COUNT(DISTINCT user_id) AS paying_users, COUNT(order_id) AS orders,
       CAST(SUM(total_amount) AS DOUBLE) AS gmv FROM f_order GROUP BY order_date""")
def _(c: Canon) -> DataFrame:
    core = c.order_core()
    bounds = core.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    return shown(metrics.daily_buyers_by_calendar(core, dims.dim_date(bounds, "first_day", "last_day")))
