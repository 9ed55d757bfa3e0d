"""Cleaning rules and simple predicates."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.functions import duration_minutes, freight, to_business_time, wall
from strataflow.operators.clean import CLEAN_RULES, clean, clean_report
from strataflow.plans.aggregates import valid_orders


def _blank(value: str, every: int, key: str = "order_id"):
    return F.when(F.pmod(F.col(key), F.lit(every)) != 0, F.col(value)).alias(value)


def _gappy_orders(c: Canon) -> DataFrame:
    """The orders with values knocked out by key arithmetic."""
    return c.orders().select(
        _blank("order_id", 17), _blank("user_id", 19), "order_date", _blank("status", 13), _blank("total_amount", 11),
        "promo_id",
    )


_GAPPY = """
SELECT CASE WHEN order_id % 17 <> 0 THEN order_id END AS order_id, CASE WHEN order_id % 19 <> 0 THEN user_id END AS user_id,
       order_date, CASE WHEN order_id % 13 <> 0 THEN status END AS status,
       CASE WHEN order_id % 11 <> 0 THEN total_amount END AS total_amount, promo_id FROM c_orders"""


@query("clean_orders_nulls", f"""
SELECT order_id, user_id, order_date FROM ({_GAPPY}) WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND order_date IS NOT NULL""")
def _(c: Canon) -> DataFrame:
    return clean(_gappy_orders(c), CLEAN_RULES["orders"]).select("order_id", "user_id", "order_date")


@query("clean_fill_defaults", f"""
SELECT order_id, COALESCE(status, 'unknown') AS status, CAST(COALESCE(total_amount, 0) AS DOUBLE) AS total_amount,
       COALESCE(promo_id, 0) AS promo_id
FROM ({_GAPPY}) WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND order_date IS NOT NULL""")
def _(c: Canon) -> DataFrame:
    cleaned = clean(_gappy_orders(c), CLEAN_RULES["orders"])
    return shown(cleaned.select("order_id", "status", "total_amount", "promo_id"))


@query("clean_numeric", """
SELECT p_partkey AS product_id, CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * 0.3337, 2) AS DOUBLE) AS price,
       COALESCE(CASE WHEN p_partkey % 7 <> 0 THEN p_size END, 0) AS stock FROM part""")
def _(c: Canon) -> DataFrame:
    fine = c.products().withColumn("price", F.col("price") * F.lit(Decimal("0.3337"))).withColumn(
        "stock", _blank("stock", 7, "product_id").cast("double"))
    return shown(clean(fine, CLEAN_RULES["products"]).select("product_id", "price", "stock"))


@query("clean_report", f"""
SELECT 'orders' AS table_name, COUNT(*) FILTER (WHERE order_id IS NOT NULL AND user_id IS NOT NULL) AS kept,
       COUNT(*) FILTER (WHERE order_id IS NULL OR user_id IS NULL) AS dropped FROM ({_GAPPY})
UNION ALL
SELECT 'users', COUNT(*) FILTER (WHERE user_id % 29 <> 0), COUNT(*) FILTER (WHERE user_id % 29 = 0) FROM c_users
UNION ALL
SELECT 'payments', COUNT(*) FILTER (WHERE order_id % 31 <> 0), COUNT(*) FILTER (WHERE order_id % 31 = 0) FROM c_payments""")
def _(c: Canon) -> DataFrame:
    users = c.users().select("user_id", _blank("name", 29, "user_id"))
    payments = c.payments().select("payment_id", _blank("order_id", 31))
    return clean_report({"orders": _gappy_orders(c), "users": users, "payments": payments})


@query("valid_orders", """
SELECT order_id, status, CAST(total_amount AS DOUBLE) AS total_amount FROM c_orders
WHERE status IN ('paid', 'shipped', 'completed')""")
def _(c: Canon) -> DataFrame:
    return shown(valid_orders(c.orders(), c.cfg).select("order_id", "status", "total_amount"))


@query("range_filter_agg", """
SELECT COUNT(*) AS order_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-11-01' AND o_orderdate < TIMESTAMP '1998-12-01'""")
def _(c: Canon) -> DataFrame:
    low, high = (wall(datetime(1998, m, 1)) for m in (11, 12))
    in_range = c.raw("orders").where((F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high))
    return shown(in_range.agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total_amount")))


@query("day_in_list", """
SELECT order_date, COUNT(*) AS order_count FROM f_order
WHERE order_date IN (DATE '1998-11-11', DATE '1997-11-11', DATE '1996-11-11') GROUP BY order_date""")
def _(c: Canon) -> DataFrame:
    days = [date(1998, 11, 11), date(1997, 11, 11), date(1996, 11, 11)]
    return c.order_core().where(F.col("order_date").isin(days)).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"))


@query("source_type_split", """
SELECT source_type, COUNT(*) AS order_count, CAST(SUM(total_amount) AS DOUBLE) AS amount FROM f_order GROUP BY source_type""")
def _(c: Canon) -> DataFrame:
    return shown(c.order_core().groupBy("source_type").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("amount")))


@query("freight_bounds", """
SELECT order_id, CASE WHEN amount >= 200 THEN CAST(0 AS DOUBLE) ELSE CAST((800 + (order_id % 700 * 433) % 700) / 100.0 AS DOUBLE) END AS freight,
       amount >= 200 AS free, TRUE AS in_bounds
FROM (SELECT order_id, CAST(floor(total_amount) AS BIGINT) % 400 AS amount FROM c_orders)""")
def _(c: Canon) -> DataFrame:
    """Freight on amounts folded into [0, 400), so that both branches occur."""
    folded = F.pmod(F.floor("total_amount").cast("long"), F.lit(400))
    charge = freight(F.col("order_id"), folded.cast("decimal(12,2)"), c.cfg.free_freight_from)
    free = folded >= 200
    bounded = F.when(free, charge == 0).otherwise((charge >= 8) & (charge < 15))
    return shown(c.orders().select("order_id", charge.alias("freight"), free.alias("free"), bounded.alias("in_bounds")))


@query("duration_minutes", """
SELECT p.order_id, date_diff('microsecond', o.order_date, p.pay_date) / 6.0e7 AS minutes
FROM c_payments p JOIN c_orders o ON p.order_id = o.order_id""")
def _(c: Canon) -> DataFrame:
    return c.payments().select("order_id", "pay_date").join(
        c.orders().select("order_id", "order_date"), "order_id"
    ).select("order_id", duration_minutes("order_date", "pay_date").alias("minutes"))


@query("business_time", """
SELECT CAST(ts + INTERVAL 8 HOUR AS DATE) AS business_day, CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS business_hour,
       COUNT(*) AS n FROM events GROUP BY 1, 2""")
def _(c: Canon) -> DataFrame:
    local = to_business_time("ts", "Asia/Shanghai")
    return c.activity().groupBy(F.to_date(local).alias("business_day"), F.hour(local).alias("business_hour")).agg(
        F.count(F.lit(1)).alias("n"))
