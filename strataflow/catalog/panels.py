"""Dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.plans import metrics, panels

# The part types stand in for the product categories of the pie chart.
_CATEGORIES = {"ECONOMY": "economy", "STANDARD": "standard", "PROMO": "promo", "SMALL": "small", "MEDIUM": "medium"}


@query("panel_daily", "SELECT dt AS time, CAST(gmv AS DOUBLE) AS gmv, order_count FROM dws_daily ORDER BY 1")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_daily(c.daily()))


@query("panel_top_products", """
SELECT product_name, category, CAST(SUM(total_qty) AS BIGINT) AS total_qty, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue
FROM dws_product JOIN c_products ON sku_id = product_id GROUP BY sku_id, product_name, category
ORDER BY SUM(total_revenue) DESC, sku_id LIMIT 10""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_top_products(c.product_days(), c.products(), c.cfg))


@query("panel_category_pivot", """
, cat AS (SELECT p.category, SUM(d.total_revenue) AS revenue
          FROM dws_product d JOIN c_products p ON d.sku_id = p.product_id GROUP BY p.category)
SELECT """ + ", ".join(
    f"CAST(SUM(revenue) FILTER (WHERE category = '{v}') AS DOUBLE) AS {n}" for v, n in _CATEGORIES.items()) + " FROM cat")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_category_pivot(metrics.category_revenue(c.product_days(), c.products()), _CATEGORIES))


@query("panel_repurchase", """
SELECT (CAST(COUNT(*) FILTER (WHERE total_orders > 1) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE)) AS repurchase_rate
FROM dws_user""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_repurchase(c.user_stats()))


@query("panel_region", """
SELECT r.province, CAST(SUM(f.total_amount) AS DOUBLE) AS gmv
FROM f_order f JOIN c_region r ON f.region_id = r.region_id GROUP BY r.province ORDER BY gmv DESC""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_region(metrics.gmv_by_region(c.placed_orders(), c.region())))


@query("panel_running_gmv", "SELECT bucket_time AS time, running_gmv, minute_gmv FROM focus_running ORDER BY 1")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_running_gmv(c.activity_minutes(), c.cfg.focus_day))


@query("panel_running_orders", """
SELECT bucket_time AS time, running_order_count, minute_order_count FROM focus_running ORDER BY 1""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_running_orders(c.activity_minutes(), c.cfg.focus_day))


@query("panel_funnel", "SELECT status, order_count FROM dws_funnel")
def _(c: Canon) -> DataFrame:
    return panels.panel_funnel(c.funnel(), c.cfg)


@query("panel_promo_pivot", """
SELECT (MAX(daily_avg_gmv) FILTER (WHERE period = 'normal')) AS normal_daily_avg_gmv,
       (MAX(daily_avg_gmv) FILTER (WHERE period = 'promo')) AS promo_daily_avg_gmv FROM dws_promo""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_promo_pivot(c.promo_compare()))


@query("panel_segment_pivot", """
, seg AS (SELECT CASE WHEN total_spent >= 3000000 THEN 'high' WHEN total_spent >= 1500000 THEN 'mid' ELSE 'low' END AS segment
          FROM dws_user)
SELECT COUNT(*) FILTER (WHERE segment = 'low') AS low_value_users, COUNT(*) FILTER (WHERE segment = 'mid') AS mid_value_users,
       COUNT(*) FILTER (WHERE segment = 'high') AS high_value_users FROM seg""")
def _(c: Canon) -> DataFrame:
    return panels.panel_segment_pivot(metrics.user_segment(c.user_stats(), c.cfg))


@query("panel_minute_traffic", "SELECT bucket_time AS time, minute_order_count FROM focus_running ORDER BY 1")
def _(c: Canon) -> DataFrame:
    return panels.panel_minute_traffic(c.activity_minutes(), c.cfg.focus_day)


@query("panel_latency", """
SELECT CAST(ROUND(CAST(paid_to_shipped_hours AS DECIMAL(20,6)), 1) AS DOUBLE) AS paid_to_shipped,
       CAST(ROUND(CAST(shipped_to_completed_hours AS DECIMAL(20,6)), 1) AS DOUBLE) AS shipped_to_completed FROM dws_latency""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_latency(c.latency()))


@query("panel_peaks", """
SELECT bucket_time, minute_order_count, CAST(minute_gmv AS DOUBLE) AS minute_gmv FROM dws_minute
ORDER BY minute_order_count DESC, minute_gmv DESC, bucket_time LIMIT 20""")
def _(c: Canon) -> DataFrame:
    return shown(panels.panel_peaks(c.minutes(), c.cfg))


@query("panel_bands", """
, r AS (SELECT COUNT(*) FILTER (WHERE total_orders > 1) * 100.0 / COUNT(*) AS v FROM dws_user)
SELECT 'repurchase_rate' AS panel, CASE WHEN v >= 50 THEN 'green' WHEN v >= 30 THEN 'yellow' WHEN v >= 0 THEN 'red' END AS band FROM r
UNION ALL
SELECT 'paid_to_shipped_hours', CASE WHEN paid_to_shipped_hours >= 96 THEN 'red' WHEN paid_to_shipped_hours >= 48 THEN 'yellow'
       WHEN paid_to_shipped_hours >= 0 THEN 'green' END FROM dws_latency
UNION ALL
SELECT 'shipped_to_completed_hours', CASE WHEN shipped_to_completed_hours >= 96 THEN 'red'
       WHEN shipped_to_completed_hours >= 48 THEN 'yellow' WHEN shipped_to_completed_hours >= 0 THEN 'green' END FROM dws_latency""")
def _(c: Canon) -> DataFrame:
    return panels.panel_bands(c.user_stats(), c.latency(), c.cfg)
