"""Layouts, verified loads, upserts and reports over written tables."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.functions import clock_hms, epoch_micros
from strataflow.operators import reports
from strataflow.plans import warehouse
from strataflow.plans.views import register_views
from strataflow.plans.warehouse import Warehouse
from strataflow.session import scratch_path, tidily
from strataflow.sinks import load_verified, out_of_range, refresh, upsert_latest, upsert_partitions, with_key_range, with_month
from strataflow.sinks.folders import _remove
from strataflow.sources import replicate


def _monthly(c: Canon, df: DataFrame, ts: str, sort: tuple[str, ...]) -> DataFrame:
    """The frame written in monthly partitions and read back."""
    path = scratch_path(c.spark, "monthly")
    load_verified(with_month(df, ts), path, "ym", sort)
    return c.spark.read.parquet(path)


@query("load_verified", """
SELECT order_id, order_date, order_time, CAST(total_amount AS DOUBLE) AS total_amount, status,
       CAST(year(order_date) * 100 + month(order_date) AS INTEGER) AS ym FROM f_order""")
def _(c: Canon) -> DataFrame:
    facts = c.order_core().select("order_id", "order_date", "order_time", "total_amount", "status")
    return shown(_monthly(c, facts, "order_date", ("order_date", "order_id")))


@query("partition_row_counts", """
SELECT CAST(year(event_time) * 100 + month(event_time) AS INTEGER) AS ym, COUNT(*) AS row_count FROM c_events GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    return reports.partition_rows(_monthly(c, c.status_events(), "event_time", ("event_time", "event_id")), "ym")


@query("key_range_counts", """
SELECT CAST(floor((l_orderkey - 1) / 20000.0) AS BIGINT) AS key_range, COUNT(*) AS row_count FROM lineitem GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    lines = c.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_quantity")
    return reports.partition_rows(with_key_range(lines, "order_id", 20_000), "key_range")


@query("out_of_range_rows", """
SELECT CAST(year(order_date) AS INTEGER) AS year, COUNT(*) AS row_count FROM c_orders
WHERE order_date < TIMESTAMP '1996-01-01' OR order_date >= TIMESTAMP '2001-01-01' GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    rejected = out_of_range(c.orders(), "order_date", datetime(1996, 1, 1), datetime(2001, 1, 1))
    return rejected.groupBy(F.year("order_date").alias("year")).agg(F.count(F.lit(1)).alias("row_count"))


@query("partitions_touched", """
, e AS (SELECT event_time, year(event_time) * 100 + month(event_time) AS ym FROM c_events)
SELECT 'range' AS scope, COUNT(DISTINCT ym) AS partitions, COUNT(*) AS row_count FROM e
WHERE event_time >= TIMESTAMP '1998-11-01' AND event_time < TIMESTAMP '1998-12-01'
UNION ALL SELECT 'full', COUNT(DISTINCT ym), COUNT(*) FROM e""")
def _(c: Canon) -> DataFrame:
    stored = _monthly(c, c.status_events(), "event_time", ("event_time", "event_id"))
    return reports.partitions_touched(stored, "event_time", datetime(1998, 11, 1), datetime(1998, 12, 1))


@query("mv_equals_direct", """
SELECT dt, CAST(gmv AS DOUBLE) AS stored_gmv, CAST(gmv AS DOUBLE) AS direct_gmv, order_count, TRUE AS equal FROM dws_daily""")
def _(c: Canon) -> DataFrame:
    """The refreshed daily aggregate next to the same aggregate computed on the spot."""
    root = scratch_path(c.spark, "dws")
    refresh(c.spark, {"daily_gmv": c.daily()}, root)
    stored = c.spark.read.parquet(f"{root}/daily_gmv").select(
        "dt", F.col("gmv").alias("stored_gmv"), F.col("order_count").alias("_stored_count"))
    direct = c.daily().select("dt", F.col("gmv").alias("direct_gmv"), "order_count")
    same = F.col("stored_gmv").eqNullSafe(F.col("direct_gmv")) & F.col("_stored_count").eqNullSafe(F.col("order_count"))
    return shown(stored.join(direct, "dt", "full").withColumn("equal", same).drop("_stored_count"))


@query("upsert_latest", """
SELECT order_id, IF(status = 'cancelled', 'refunded', status) AS status,
       CAST(IF(status = 'cancelled', 0, total_amount) AS DOUBLE) AS total_amount, IF(status = 'cancelled', 2, 1) AS version FROM c_orders
UNION ALL
SELECT -1 - order_id, 'renewed', CAST(total_amount AS DOUBLE), 2 FROM c_orders WHERE status = 'completed'""")
def _(c: Canon) -> DataFrame:
    """Cancelled orders are refunded by a later version and completed ones are ordered again under new ids."""
    base = c.orders().select("order_id", "status", "total_amount", F.lit(1).alias("version"))
    status, second = F.col("status"), F.lit(2).alias("version")
    zero = F.lit(0).cast("decimal(12,2)").alias("total_amount")
    changed = base.where(status == "cancelled").select("order_id", F.lit("refunded").alias("status"), zero, second)
    added = base.where(status == "completed").select(
        (-1 - F.col("order_id")).alias("order_id"), F.lit("renewed").alias("status"), "total_amount", second)
    return shown(upsert_latest(base, changed.unionByName(added), ["order_id"], "version"))


def _step_log(c: Canon) -> DataFrame:
    """A step log out of the event table: one step per day and type, timed by its first and last event."""
    micros = epoch_micros("ts")
    return c.activity().groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("rows_processed"), (F.max(micros) - F.min(micros)).alias("_micros"),
    ).select(
        F.concat_ws(" ", F.col("event_type"), F.col("day").cast("string")).alias("step"),
        "rows_processed",
        F.floor(F.col("_micros") / 1000).cast("long").alias("duration_ms"),
    )


_LOG = """
, log AS (SELECT event_type || ' ' || CAST(CAST(ts AS DATE) AS VARCHAR) AS step, COUNT(*) AS rows_processed,
                 date_diff('microsecond', MIN(ts), MAX(ts)) // 1000 AS duration_ms FROM events GROUP BY CAST(ts AS DATE), event_type)"""
_HMS = "printf('%02d:%02d:%02d', duration_ms // 3600000, duration_ms // 60000 % 60, duration_ms // 1000 % 60)"


@query("etl_throughput", _LOG + f"""
SELECT step, rows_processed AS rows, duration_ms,
       CAST(CASE WHEN duration_ms > 0 THEN (rows_processed * 2000 + duration_ms) // (2 * duration_ms) ELSE 0 END AS DOUBLE) AS rows_per_sec,
       CAST(CASE WHEN duration_ms > 0 THEN (duration_ms + 5) // 10 ELSE 0 END AS DOUBLE) / 100 AS duration_sec,
       {_HMS} AS duration FROM log""")
def _(c: Canon) -> DataFrame:
    return reports.etl_throughput(_step_log(c))


@query("etl_duration_hms", _LOG + f" SELECT step, {_HMS} AS duration FROM log")
def _(c: Canon) -> DataFrame:
    return _step_log(c).select("step", clock_hms("duration_ms").alias("duration"))


# The write side

_BUILT: dict[tuple[str, str], Warehouse] = {}


def _built(c: Canon) -> Warehouse:
    """The warehouse of these tables, built once per session into scratch."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _BUILT:
        with tidily(c.spark):  # the numbering of the lines too, which runs as soon as the sources are named
            _BUILT[key] = warehouse.build(
                c.spark, c.sources(), scratch_path(c.spark, "warehouse"), c.region(), c.promotions(), c.cfg, verify=False)
    return _BUILT[key]


_SIZES = {
    ("ods", "users"): "c_users", ("ods", "products"): "c_products", ("ods", "orders"): "c_orders", ("ods", "order_items"): "c_items",
    ("ods", "payments"): "c_payments", ("ods", "order_status_events"): "c_events", ("dim", "dim_product"): "c_products",
    ("dim", "dim_user"): "c_users", ("dim", "dim_region"): "c_region", ("dwd", "order_fact"): "f_order",
    ("dwd", "order_detail_fact"): "f_detail", ("dwd", "order_status_event_fact"): "f_event", ("dws", "daily_gmv"): "dws_daily",
    ("dws", "minute_traffic"): "dws_minute", ("dws", "product_daily_sales"): "dws_product", ("dws", "user_purchase_stats"): "dws_user",
    ("dws", "status_funnel"): "dws_funnel",
}


@query("warehouse_rows", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {relation}" for (layer, name), relation in _SIZES.items()))
def _(c: Canon) -> DataFrame:
    """Rows of the tables a build lands, conforms and aggregates."""
    house = _built(c)
    counts = [house.read(*at).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(at[0]).alias("layer"), F.lit(at[1]).alias("table_name"), "row_count") for at in _SIZES]
    return reduce(DataFrame.unionByName, counts)


@query("warehouse_audit", """
SELECT 'load_ods' AS step, 'success' AS status, (SELECT COUNT(*) FROM c_users) + (SELECT COUNT(*) FROM c_products) + (SELECT COUNT(*) FROM c_orders)
  + (SELECT COUNT(*) FROM c_items) + (SELECT COUNT(*) FROM c_payments) + (SELECT COUNT(*) FROM c_events) AS rows_processed
UNION ALL SELECT 'order_fact', 'success', COUNT(*) FROM f_order
UNION ALL SELECT 'order_detail_fact', 'success', COUNT(*) FROM f_detail
UNION ALL SELECT 'order_status_event_fact', 'success', COUNT(*) FROM f_event""")
def _(c: Canon) -> DataFrame:
    """What the build's log says of the large loads."""
    steps = ("load_ods", "order_fact", "order_detail_fact", "order_status_event_fact")
    return _built(c).read("audit", "etl_log").where(F.col("step").isin(*steps)).select("step", "status", "rows_processed")


# Copies written as text at a time, some six gigabytes.
TEXT_ROWS = 100_000_000


@query("layout_saving", """
SELECT 40 * COUNT(*) AS compact_rows, 40 * COUNT(*) AS plain_rows, TRUE AS saves_half FROM orders""")
def _(c: Canon) -> DataFrame:
    """Forty copies of the orders as compressed columns and as uncompressed text rows.

    All copies are written as text, read and measured, but no more than about ``TEXT_ROWS`` stand there at once: the orders are cut by a hash of
    the whole row, and a part goes when the next one comes.
    """
    orders, compact = c.orders(), scratch_path(c.spark, "compact")
    # Copies of a row stand together, so it is the orders that are sorted, not their copies.
    held = load_verified(replicate(orders.sortWithinPartitions("order_date"), 40), compact, codec="lz4")
    parts, gone_rows, gone_bytes = max(1, -(-held // TEXT_ROWS)), 0, 0
    for n in range(parts):
        plain = scratch_path(c.spark, "plain")
        part = orders.where(F.pmod(F.xxhash64(*orders.columns), F.lit(parts)) == n) if parts > 1 else orders
        replicate(part, 40).write.csv(plain)
        if n < parts - 1:
            gone_rows += c.spark.read.text(plain).count()
            gone_bytes += reports.table_bytes(c.spark, plain).select("bytes").first()[0]
            _remove(c.spark, plain)
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return reports.layout_savings(c.spark, compact, plain, gone_bytes).select(
        rows(c.spark.read.parquet(compact)).alias("compact_rows"), (rows(c.spark.read.text(plain)) + F.lit(gone_rows).cast("long")).alias("plain_rows"),
        (F.col("savings_pct") >= 50).alias("saves_half"))


@query("codec_saving", "SELECT COUNT(*) AS zstd_rows, COUNT(*) AS plain_rows, TRUE AS smaller FROM lineitem")
def _(c: Canon) -> DataFrame:
    """The lines with and without a codec."""
    small, large, lines = scratch_path(c.spark, "zstd"), scratch_path(c.spark, "uncompressed"), c.raw("lineitem")
    counts = [load_verified(lines, path, sort=("l_orderkey",), codec=codec) for path, codec in ((small, "zstd"), (large, "uncompressed"))]
    sizes = [reports.table_bytes(c.spark, path).select("bytes").scalar() for path in (small, large)]
    return c.spark.range(1).select(
        F.lit(counts[0]).cast("long").alias("zstd_rows"), F.lit(counts[1]).cast("long").alias("plain_rows"), (sizes[0] < sizes[1]).alias("smaller"))


@query("upsert_partitions", """
SELECT order_id, CASE WHEN order_id % 50 = 0 THEN 'moved' WHEN order_id % 50 = 1 THEN 'unknown' ELSE status END AS status,
       CASE WHEN order_id % 50 = 0 THEN 203001 WHEN order_id % 50 = 1 THEN NULL WHEN order_id % 50 = 2 THEN NULL
            ELSE CAST(year(order_date) * 100 + month(order_date) AS INTEGER) END AS ym FROM c_orders
UNION ALL SELECT -order_id, 'new', NULL FROM c_orders WHERE order_id % 50 = 3""")
def _(c: Canon) -> DataFrame:
    """Orders of one month and of none; some move to another month, some lose theirs, some are new in the NULL month."""
    key, path = F.col("order_id") % 50, scratch_path(c.spark, "merged-orders")
    month = F.when(key != 2, F.year("order_date") * 100 + F.month("order_date"))
    base = c.orders().select("order_id", "status", F.lit(1).alias("version"), month.alias("ym"))
    load_verified(base, path, "ym", ("order_id",))
    moved = base.where(key == 0).select("order_id", F.lit("moved").alias("status"), F.lit(2).alias("version"), F.lit(203001).alias("ym"))
    unknown = base.where(key == 1).select("order_id", F.lit("unknown").alias("status"), F.lit(2).alias("version"), F.lit(None).cast("int").alias("ym"))
    added = base.where(key == 3).select((-F.col("order_id")).alias("order_id"), F.lit("new").alias("status"), F.lit(1).alias("version"), F.lit(None).cast("int").alias("ym"))
    upsert_partitions(c.spark, path, moved.unionByName(unknown).unionByName(added), ["order_id"], "version", "ym", ("order_id",))
    return c.spark.read.parquet(path).select("order_id", "status", "ym")


@query("views_sql", """
SELECT r.province, COUNT(*) AS order_cnt, CAST(SUM(f.total_amount) AS DOUBLE) AS gmv, CAST((SELECT COUNT(DISTINCT category) FROM c_products JOIN dws_product ON sku_id = product_id) AS BIGINT) AS categories
FROM f_order f JOIN c_region r ON f.region_id = r.region_id GROUP BY r.province""")
def _(c: Canon) -> DataFrame:
    """Metrics of the built warehouse through its named views."""
    register_views(_built(c), c.cfg)
    return shown(c.spark.sql(
        "SELECT province, order_cnt, gmv, (SELECT COUNT(*) FROM metric_category_share) AS categories FROM metric_gmv_by_region"))


@query("bucketed_join", """
SELECT CAST(year(order_date) AS INTEGER) AS year, COUNT(*) AS lines, CAST(SUM(line_amount) AS DOUBLE) AS line_amount,
       CAST(SUM(total_amount) AS DOUBLE) AS order_amount FROM f_detail JOIN (SELECT order_id, total_amount FROM f_order) USING (order_id) GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    """Lines with their orders from the bucketed facts of the build."""
    tables = warehouse.bucket_facts(_built(c), 8, f"b{uuid.uuid4().hex}_")
    lines, orders = c.spark.table(tables["order_detail_fact"]), c.spark.table(tables["order_fact"]).select("order_id", "total_amount")
    return shown(lines.join(orders.hint("merge"), "order_id").groupBy(F.year("order_date").alias("year")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_amount").alias("line_amount"), F.sum("total_amount").alias("order_amount")))


# A file of a lookup table: its footer names every row group, and whoever reads a part of the file reads the whole footer.
LOOKUP_ROWS = 100_000


@query("point_lookup", """
, keys AS (SELECT CAST(MAX(order_id) AS BIGINT) AS some_order, CAST(MAX(user_id) AS BIGINT) AS some_user FROM f_order)
SELECT 'order present' AS lookup, (SELECT COUNT(*) FROM f_order WHERE order_id = some_order) AS found, TRUE AS reads_part, TRUE AS reads_no_more FROM keys
UNION ALL SELECT 'order absent', 0, TRUE, TRUE
UNION ALL SELECT 'user present', (SELECT COUNT(*) FROM f_order WHERE user_id = some_user), TRUE, TRUE FROM keys
UNION ALL SELECT 'user absent', 0, TRUE, TRUE""")
def _(c: Canon) -> DataFrame:
    """Lookups in a table sorted by order with Bloom filters on the buyer, next to a plain one: rows found, whether only a part of the table was
    read for them, and no more than of the plain one.

    Every other order key is unused, and buyers are known by a hash, so absent keys lie within the range of present ones.
    """
    order_key, user_key = (F.col("order_id") * 2).alias("order_key"), F.xxhash64("user_id").alias("user_key")
    rows = c.order_core().select(order_key, user_key, "order_date", "total_amount")
    files = max(4, -(-rows.count() // LOOKUP_ROWS))
    tuned, plain = scratch_path(c.spark, "lookup-tuned"), scratch_path(c.spark, "lookup-plain")
    held = load_verified(rows.repartitionByRange(files, "order_key"), tuned, sort=("order_key",), lookup={"user_key": 10_000}, row_group_bytes=2 << 10)
    load_verified(rows.repartition(files, F.xxhash64("order_key")), plain)
    top = c.order_core().agg(F.max(order_key).alias("o"), F.max("user_id").alias("u")).select("o", F.xxhash64("u").alias("u"), F.xxhash64(F.lit(-1).cast("long")).alias("nobody")).first()
    wanted = (("order present", "order_key", top.o), ("order absent", "order_key", top.o - 1), ("user present", "user_key", top.u), ("user absent", "user_key", top.nobody))
    out = []
    for label, name, key in wanted:
        found, read = reports.rows_scanned(c.spark.read.parquet(tuned).where(F.col(name) == key))
        _, plainly = reports.rows_scanned(c.spark.read.parquet(plain).where(F.col(name) == key))
        out.append((label, found, read < held, read <= plainly))
    return c.spark.createDataFrame(out, "lookup string, found long, reads_part boolean, reads_no_more boolean")
