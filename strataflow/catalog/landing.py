"""Scans, landing projections and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.plans import dims
from strataflow.session import scratch_path
from strataflow.sinks import stamp_sync_time
from strataflow.sources import read_csv, replicate, row_counts

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@query("scan_tables_rowcount", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _TABLES))
def _(c: Canon) -> DataFrame:
    return row_counts({name: c.raw(name) for name in _TABLES})


_ORDER_COLUMNS = ("order_id", "user_id", "order_date", "status", "total_amount", "promo_id")
_ORDER_SQL = "SELECT order_id, user_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount, promo_id FROM c_orders"


@query("csv_roundtrip", _ORDER_SQL)
def _(c: Canon) -> DataFrame:
    path = scratch_path(c.spark, "orders-csv")
    c.orders().select(*_ORDER_COLUMNS).write.option("quote", '"').option("escape", '"').csv(path)
    return shown(read_csv(c.spark, path, schemas.ORDERS))


@query("strip_crlf", _ORDER_SQL)
def _(c: Canon) -> DataFrame:
    path = scratch_path(c.spark, "orders-crlf")
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in _ORDER_COLUMNS]
    c.orders().select(F.concat(F.concat_ws(",", *cells), F.lit("\r")).alias("line")).write.text(path)
    return shown(read_csv(c.spark, path, schemas.ORDERS, crlf=True))


@query("replicate_rows", """
SELECT status, COUNT(*) AS row_count, CAST(SUM(total_amount) AS DOUBLE) AS total_amount
FROM c_orders CROSS JOIN generate_series(1, 40) GROUP BY status""")
def _(c: Canon) -> DataFrame:
    copies = replicate(c.orders(), c.cfg.size_sample_copies)
    return shown(copies.groupBy("status").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").alias("total_amount")))


@query("federated_join", """
SELECT u.city, COUNT(*) AS orders, CAST(SUM(o.total_amount) AS DOUBLE) AS amount
FROM c_orders o JOIN c_users u ON o.user_id = u.user_id GROUP BY u.city""")
def _(c: Canon) -> DataFrame:
    """A join across two systems: buyers from a delimited export, orders from the warehouse."""
    path = scratch_path(c.spark, "users-csv")
    c.users().select(*schemas.USERS.names).write.option("quote", '"').option("escape", '"').csv(path)
    users = read_csv(c.spark, path, schemas.USERS).select("user_id", "city")
    per_user = c.orders().groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("amount"))
    return shown(per_user.join(users, "user_id").groupBy("city").agg(
        F.sum("orders").alias("orders"), F.sum("amount").alias("amount")))


def _landed(df: DataFrame, columns: list[str]) -> DataFrame:
    return shown(stamp_sync_time(df, columns).drop("sync_time"))


@query("ods_orders", _ORDER_SQL)
def _(c: Canon) -> DataFrame:
    return _landed(c.orders(), list(_ORDER_COLUMNS))


@query("ods_users", "SELECT user_id, name, email, register_date, city, province, status FROM c_users")
def _(c: Canon) -> DataFrame:
    return _landed(c.users(), schemas.USERS.names)


@query("ods_products", """
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, stock FROM c_products""")
def _(c: Canon) -> DataFrame:
    return _landed(c.products(), schemas.PRODUCTS.names)


@query("ods_order_items", """
SELECT order_id, product_id, qty, CAST(unit_price AS DOUBLE) AS unit_price FROM c_items""")
def _(c: Canon) -> DataFrame:
    return _landed(c.items(), ["order_id", "product_id", "qty", "unit_price"])


@query("ods_payments", """
SELECT payment_id, order_id, method, pay_date, CAST(amount AS DOUBLE) AS amount, status FROM c_payments""")
def _(c: Canon) -> DataFrame:
    return _landed(c.payments(), schemas.PAYMENTS.names)


@query("ods_order_status_events", """
SELECT event_id, order_id, from_status, to_status, event_time, operator_type FROM c_events""")
def _(c: Canon) -> DataFrame:
    return _landed(c.status_events(), schemas.STATUS_EVENTS.names)


@query("dim_date", """
SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
       CAST(month(d) AS SMALLINT) AS month, CAST(week(d) AS SMALLINT) AS week,
       CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring'
            WHEN month(d) IN (6, 7, 8) THEN 'summer' WHEN month(d) IN (9, 10, 11) THEN 'autumn' END AS season
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def _(c: Canon) -> DataFrame:
    """The calendar of all days the orders span."""
    bounds = c.raw("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))
    return dims.dim_date(bounds, "first_day", "last_day")


@query("dim_region", "SELECT region_id, province, city, district, region_tier FROM c_region")
def _(c: Canon) -> DataFrame:
    return c.region()


@query("dim_promotion", """
SELECT promo_id, make_date(y, 11, d1) AS start_date, make_date(y, 11, d2) AS end_date, CAST(rate AS DOUBLE) AS discount_rate
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
CROSS JOIN (VALUES (1, 1, 10, 0.10), (2, 11, 11, 0.25), (3, 12, 14, 0.15)) AS p(promo_id, d1, d2, rate)""")
def _(c: Canon) -> DataFrame:
    return shown(c.promotion_periods())


@query("dim_product", "SELECT DISTINCT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM c_products")
def _(c: Canon) -> DataFrame:
    return shown(dims.dim_product(c.products()))


@query("dim_user", """
SELECT DISTINCT user_id, name AS user_name, city, status, register_date FROM c_users""")
def _(c: Canon) -> DataFrame:
    return dims.dim_user(c.users())
