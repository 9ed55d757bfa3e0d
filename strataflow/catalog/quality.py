"""Data-quality checks, one query each, and the suite's summary."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import CONFIG, Canon
from strataflow.catalog.registry import query, shown
from strataflow.functions import safe_ratio
from strataflow.operators import quality as q
from strataflow.operators.quality import Check
from strataflow.plans import metrics

Frame = Callable[[Canon], DataFrame]

# What each check looks at, in suite order; checks of one frame share its single pass.
_CHECKS: list[tuple[Frame, Callable[[], Check], str, str]] = []


def check(name: str, frame: Frame, make: Callable[[], Check], observed_sql: str, verdict_sql: str) -> None:
    """Register a check as a query returning check_name, observed and passed.

    ``observed_sql`` yields one value named v, ``verdict_sql`` judges it.
    """
    _CHECKS.append((frame, make, observed_sql, verdict_sql))
    query(name, f"""
SELECT '{name}' AS check_name, ROUND(CAST(v AS DOUBLE), 9) AS observed, COALESCE({verdict_sql}, FALSE) AS passed
FROM ({observed_sql})""")(lambda c: _presented(q.evaluate(frame(c), [make()])))


def _presented(results: DataFrame) -> DataFrame:
    return results.withColumn("observed", F.round("observed", 9))


# Frames under check

def _daily(c: Canon) -> DataFrame:
    return c.daily()


def _top(c: Canon) -> DataFrame:
    return metrics.top_products(c.product_days(), c.products(), c.cfg)


def _shares(c: Canon) -> DataFrame:
    return metrics.category_share(c.product_days(), c.products())


def _repurchase(c: Canon) -> DataFrame:
    return metrics.user_repurchase(c.user_stats())


def _regions(c: Canon) -> DataFrame:
    return metrics.gmv_by_region(c.placed_orders(), c.region())


def _periods(c: Canon) -> DataFrame:
    return c.promo_compare()


def _segments(c: Canon) -> DataFrame:
    return metrics.user_segment(c.user_stats(), c.cfg)


def _order_sizes(c: Canon) -> DataFrame:
    return q.child_ratio(c.order_core(), c.raw("orders"))


def _item_ratio(c: Canon) -> DataFrame:
    return q.child_ratio(c.raw("lineitem"), c.raw("orders"))


def _event_ratio(c: Canon) -> DataFrame:
    return q.child_ratio(c.status_events(), c.raw("orders"))


def _event_days(c: Canon) -> DataFrame:
    return c.activity().select(F.to_date("ts").alias("day"))


def _burst(c: Canon) -> DataFrame:
    return q.burst_ratio(_event_days(c), "day", c.cfg.focus_day)


def _line_keys(c: Canon) -> DataFrame:
    return c.raw("lineitem").select(F.col("l_orderkey").alias("order_id"))


def _items_per_order(c: Canon) -> DataFrame:
    return q.items_per_order(_line_keys(c))


def _products(c: Canon) -> DataFrame:
    return c.products()


def _rebuilt_mismatches(c: Canon) -> DataFrame:
    """Headers rebuilt as the sum of their lines, those of every hundredth order a little too high, compared with the lines."""
    planted = F.when(F.col("order_id") % 100 == 0, F.lit(Decimal("0.06"))).otherwise(F.lit(Decimal("0.05")))
    headers = c.detail_lines().groupBy("order_id").agg(F.sum("line_amount").alias("_total")).select(
        "order_id", (F.col("_total") + planted).alias("total_amount"))
    return q.reconcile_amounts(headers, c.detail_lines(), c.cfg)


def _minutes(c: Canon) -> DataFrame:
    return c.minutes()


def _running(c: Canon) -> DataFrame:
    return metrics.gmv_running_total(c.activity_minutes(), c.cfg.focus_day)


def _running_falls(c: Canon) -> DataFrame:
    return q.running_violations(_running(c))


def _orders(c: Canon) -> DataFrame:
    return c.order_core()


def _leak(c: Canon) -> DataFrame:
    return q.cancelled_in_gmv(c.daily(), c.order_core(), c.cfg)


def _order_keys(c: Canon) -> DataFrame:
    return c.order_core().groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))


def _placed(c: Canon) -> DataFrame:
    return q.region_match(c.placed_orders())


def _orphans(c: Canon) -> DataFrame:
    return q.orphan_items(_line_keys(c), c.order_core())


# Checks

check("dq_daily_rows", _daily, lambda: q.expect(
    "dq_daily_rows", F.count(F.lit(1)) - (F.datediff(F.max("dt"), F.min("dt")) + 1), lambda v: v == 0
), "SELECT COUNT(*) - (date_diff('day', MIN(dt), MAX(dt)) + 1) AS v FROM dws_daily", "v = 0")

check("dq_peak_ratio", _daily, lambda: q.expect(
    "dq_peak_ratio", F.try_divide(F.max("gmv").cast("double"), safe_ratio(F.sum("gmv"), F.count("gmv"))), lambda v: v > 2
), "SELECT CAST(MAX(gmv) AS DOUBLE) / (CAST(SUM(gmv) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) AS v FROM dws_daily", "v > 2")

check("dq_topn", _top, lambda: q.expect_count("dq_topn", CONFIG.top_products), """
SELECT COUNT(*) AS v FROM (
  SELECT sku_id, RANK() OVER (ORDER BY SUM(total_revenue) DESC, sku_id) AS place FROM dws_product GROUP BY sku_id) JOIN c_products ON sku_id = product_id
WHERE place <= 10""", "v = 10")

check("dq_pct_sum", _shares, lambda: q.expect_sum("dq_pct_sum", F.col("pct"), 100, 0.2), """
SELECT SUM(pct) AS v FROM (
  SELECT p.category, CAST(SUM(d.total_revenue) AS DOUBLE) * 100.0 / CAST((SELECT SUM(total_revenue) FROM dws_product) AS DOUBLE) AS pct
  FROM dws_product d JOIN c_products p ON d.sku_id = p.product_id GROUP BY p.category)""", "abs(v - 100) < 0.2")

check("dq_rate", _repurchase, lambda: q.expect_min("dq_rate", F.min("repurchase_rate"), CONFIG.min_repurchase_rate), """
SELECT CAST(COUNT(*) FILTER (WHERE total_orders > 1) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS v FROM dws_user""", "v >= 30")

check("dq_regions", _regions, lambda: q.expect_min_count("dq_regions", 5), """
SELECT COUNT(DISTINCT r.province) AS v FROM f_order JOIN c_region r USING (region_id)""", "v >= 5")

check("dq_periods", _periods, lambda: q.expect("dq_periods", F.count_if(F.col("gmv") > 0), lambda v: v == 2),
      "SELECT COUNT(*) AS v FROM dws_promo WHERE gmv > 0", "v = 2")

check("dq_segments", _segments, lambda: q.expect_count("dq_segments", 3), """
SELECT COUNT(DISTINCT CASE WHEN total_spent >= 3000000 THEN 'high' WHEN total_spent >= 1500000 THEN 'mid' ELSE 'low' END) AS v
FROM dws_user""", "v = 3")

check("dq_orders", _order_sizes, lambda: q.expect("dq_orders", F.max(F.col("children") - F.col("parents")), lambda v: v == 0),
      "SELECT (SELECT COUNT(*) FROM f_order) - (SELECT COUNT(*) FROM orders) AS v", "v = 0")

check("dq_item_ratio", _item_ratio, lambda: q.expect_between("dq_item_ratio", F.max("ratio"), CONFIG.min_item_ratio, CONFIG.max_item_ratio), """
SELECT CAST((SELECT COUNT(*) FROM lineitem) AS DOUBLE) / CAST((SELECT COUNT(*) FROM orders) AS DOUBLE) AS v""", "v BETWEEN 2 AND 5")

_BURST = """
SELECT CAST(SUM(n) FILTER (WHERE day = DATE '2024-01-15') AS DOUBLE) AS f,
       CAST(SUM(n) FILTER (WHERE day <> DATE '2024-01-15') AS DOUBLE) AS rest,
       CAST(COUNT(*) FILTER (WHERE day <> DATE '2024-01-15') AS DOUBLE) AS days
FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1)"""

check("dq_burst", _burst, lambda: q.expect_min("dq_burst", F.max("burst_ratio"), CONFIG.min_burst_ratio),
      f"SELECT f * days / rest AS v FROM ({_BURST})", "v >= 50")

check("dq_events_ge_orders", _event_ratio, lambda: q.expect_min("dq_events_ge_orders", F.max("ratio"), 1), """
SELECT CAST((SELECT COUNT(*) FROM c_events) AS DOUBLE) / CAST((SELECT COUNT(*) FROM orders) AS DOUBLE) AS v""", "v >= 1")

check("dq_item_count_varies", _items_per_order, lambda: q.expect("dq_item_count_varies", F.max("item_count") - F.min("item_count"), lambda v: v > 0),
      "SELECT MAX(n) - MIN(n) AS v FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)", "v > 0")

check("dq_product_dim", _products, lambda: q.expect_no_violation(
    "dq_product_dim", F.col("product_name").isNull() | F.col("category").isNull() | (F.col("price") <= 0)
), "SELECT COUNT(*) AS v FROM c_products WHERE product_name IS NULL OR category IS NULL OR price <= 0", "v = 0")

check("dq_reconcile_rebuilt", _rebuilt_mismatches, lambda: q.expect_count("dq_reconcile_rebuilt", 0), """
SELECT COUNT(DISTINCT l_orderkey) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 100 = 0""", "v = 0")

check("dq_minutes", _minutes, lambda: q.expect_min_count("dq_minutes", 1), "SELECT COUNT(*) AS v FROM dws_minute", "v >= 1")

check("dq_peak_minute", _minutes, lambda: q.expect(
    "dq_peak_minute", F.max("minute_order_count") - F.avg("minute_order_count"), lambda v: v > 0
), "SELECT MAX(minute_order_count) - AVG(minute_order_count) AS v FROM dws_minute", "v > 0")

check("dq_running", _running, lambda: q.expect_min_count("dq_running", 1), "SELECT COUNT(*) AS v FROM focus_running", "v >= 1")

check("dq_running_monotonic", _running_falls, lambda: q.expect_count("dq_running_monotonic", 0), """
SELECT COUNT(*) AS v FROM (SELECT running_gmv, LAG(running_gmv) OVER (ORDER BY bucket_time) AS before FROM focus_running)
WHERE running_gmv < before""", "v = 0")

check("dq_date_aligned", _orders, lambda: q.expect_no_violation("dq_date_aligned", F.col("order_date") != F.to_date("order_time")),
      "SELECT COUNT(*) AS v FROM f_order WHERE order_date <> CAST(order_time AS DATE)", "v = 0")

check("dq_cancelled_in_gmv", _leak, lambda: q.expect("dq_cancelled_in_gmv", F.max("leak"), lambda v: v == 0), """
SELECT (SELECT SUM(gmv) FROM dws_daily) - (SELECT SUM(total_amount) FROM f_order WHERE status <> 'cancelled') AS v""", "v = 0")

check("dq_order_unique", _order_keys, lambda: q.expect_no_violation("dq_order_unique", F.col("n") > 1),
      "SELECT COUNT(*) AS v FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)", "v = 0")

check("dq_region_match", _placed, lambda: q.expect("dq_region_match", F.max("match_pct"), lambda v: v == 100), """
SELECT CAST(COUNT(*) FILTER (WHERE region_id <> 0) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS v FROM f_order""", "v = 100")

check("dq_orphan_items", _orphans, lambda: q.expect("dq_orphan_items", F.coalesce(F.sum("item_count"), F.lit(0)), lambda v: v == 0),
      "SELECT COUNT(*) AS v FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)", "v = 0")


def _suite(c: Canon) -> DataFrame:
    by_frame: dict[Frame, list[Check]] = {}
    for frame, make, _, _ in _CHECKS:
        by_frame.setdefault(frame, []).append(make())
    return q.suite([q.evaluate(frame(c), made) for frame, made in by_frame.items()])


query("dq_summary", """
SELECT COUNT(*) FILTER (WHERE passed) AS passed, COUNT(*) AS total, BOOL_AND(passed) AS all_passed FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT COALESCE({verdict}, FALSE) AS passed FROM ({observed})" for _, _, observed, verdict in _CHECKS
) + ")")(lambda c: q.summary(_suite(c)))


# Row-level checks and measures

@query("burst_ratio", f"""
SELECT CAST(f AS BIGINT) AS focus_rows, (rest / days) AS other_day_mean, (f * days / rest) AS burst_ratio FROM ({_BURST})""")
def _(c: Canon) -> DataFrame:
    return shown(_burst(c))


@query("orders_with_item_count_ne", """
SELECT COUNT(*) AS orders FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) <> 4)""")
def _(c: Canon) -> DataFrame:
    return q.orders_with_item_count_ne(_line_keys(c), 4)


@query("reconcile_amounts", """
, lines AS (SELECT order_id, SUM(line_amount) AS detail_amount FROM f_detail GROUP BY order_id)
SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, CAST(detail_amount AS DOUBLE) AS detail_amount
FROM f_order JOIN lines USING (order_id) WHERE ABS(total_amount - detail_amount) > 0.05""")
def _(c: Canon) -> DataFrame:
    return shown(q.reconcile_amounts(c.order_core(), c.detail_lines(), c.cfg))


@query("reconcile_raw", """
, lines AS (SELECT order_id, SUM(qty * unit_price) AS items_total FROM c_items GROUP BY order_id)
SELECT o.order_id, CAST(i.items_total AS DOUBLE) AS items_total, CAST(o.total_amount AS DOUBLE) AS total_amount
FROM lines i JOIN c_orders o USING (order_id) WHERE i.items_total <> o.total_amount""")
def _(c: Canon) -> DataFrame:
    return shown(q.reconcile_raw(c.orders(), c.items()))


@query("price_deviation", """
, charged AS (SELECT l_partkey AS product_id,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) // CAST(l_quantity AS BIGINT) AS cents FROM lineitem)
SELECT i.product_id, i.cents / 100.0 AS unit_price, COUNT(*) AS lines
FROM charged i JOIN c_products p ON i.product_id = p.product_id
WHERE ABS(i.cents / 100.0 - CAST(p.price AS DOUBLE)) > 0.05 * CAST(p.price AS DOUBLE) GROUP BY 1, 2""")
def _(c: Canon) -> DataFrame:
    """The price charged per piece, in whole cents, against the list price."""
    cents = F.expr("CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) DIV CAST(l_quantity AS BIGINT)")
    items = c.raw("lineitem").select(
        F.col("l_partkey").alias("product_id"), (cents / 100).cast("decimal(12,2)").alias("unit_price"))
    return shown(q.price_deviation(items, c.products()))


@query("event_chain_gaps", """
SELECT o.order_id, o.status FROM c_orders o
WHERE (o.status = 'completed' AND EXISTS (
         SELECT 1 FROM (VALUES ('created'), ('paid'), ('shipped'), ('completed')) AS s(step)
         WHERE NOT EXISTS (SELECT 1 FROM c_events e WHERE e.order_id = o.order_id AND e.to_status = s.step)))
   OR (o.status = 'cancelled' AND EXISTS (
         SELECT 1 FROM (VALUES ('created'), ('cancelled')) AS s(step)
         WHERE NOT EXISTS (SELECT 1 FROM c_events e WHERE e.order_id = o.order_id AND e.to_status = s.step)))""")
def _(c: Canon) -> DataFrame:
    """All orders against the whole event log."""
    return q.event_chain_gaps(c.orders(), c.status_events())


@query("orphan_items", """
SELECT l_orderkey AS order_id, COUNT(*) AS item_count FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    """Lines without an order."""
    return q.orphan_items(_line_keys(c), c.orders())
