"""A table of orders maintained from a feed of changes, and the aggregates maintained from what each batch changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.catalog.registry import query, shown
from strataflow.plans import incremental as inc
from strataflow.session import scratch_path
from strataflow.sinks import load_verified, with_key_range, with_month
from strataflow.sinks.changes import DELETE, INSERT, UPDATE, Feed, applied, apply_changes, change_stream, current, images
from strataflow.sources import read_file_stream

BATCHES, STEP = 2, 20_000
_COLUMNS = ("order_id", "user_id", "order_date", "status", "total_amount", "promo_id")


def _records(c: Canon) -> DataFrame:
    """First loads, later orders, updates that move an order by forty days and cancel it, deletes, orders placed again, and deletes of unknown keys."""
    orders, key = c.orders().select(*_COLUMNS), F.col("order_id")

    def record(rows: DataFrame, op: str, seq: int) -> DataFrame:
        return with_month(rows, "order_date").select(*_COLUMNS, "ym", F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"))

    moved = orders.where(key % 7 == 0).withColumn("status", F.lit("cancelled")).withColumn("order_date", F.timestamp_add("DAY", F.lit(40), F.col("order_date")))
    again = orders.where(key % 77 == 0).withColumn("status", F.lit("paid")).withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(12,2)"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "order_id" else F.col(f.name) for f in orders.schema]
    steps = (record(orders, INSERT, 1), record(moved, UPDATE, 2), record(orders.where(key % 11 == 0).select(*blank), DELETE, 3),
             record(again, INSERT, 4), record(orders.where(key % 13 == 0).withColumn("order_id", -key).select(*blank), DELETE, 3))
    out = steps[0]
    for rows in steps[1:]:
        out = out.unionByName(rows)
    return out


class Maintained:
    """Four fifths of the first records as one load, then everything in batches without order, some records twice."""

    def __init__(self, c: Canon):
        spark, root = c.spark, scratch_path(c.spark, "feed")
        self.spark, self.root, self.feed = spark, f"{root}/dws", Feed(f"{root}/orders", ("order_id",), "ym", sort=("order_date",))
        items = f"{root}/items"
        load_verified(with_key_range(c.items(), "order_id", STEP), items, "key_range", ("order_id",))
        records, arriving = _records(c), f"{root}/arriving"
        lots = F.pmod(F.xxhash64("order_id", "seq"), F.lit(BATCHES)), F.pmod(F.xxhash64("seq", "order_id"), F.lit(4))
        first = records.where((F.col("seq") == 1) & (F.col("order_id") % 5 != 0))
        def follow(spark: SparkSession, batch_no: int) -> None:
            changed = images(spark, self.feed, batch_no)
            orders = inc.signed_orders(changed, c.cfg)
            lines = inc.signed_lines(changed, inc.items_of(spark.read.parquet(items), changed, "key_range", STEP), c.promotions(), c.cfg)
            for spec, signed in ((inc.daily_gmv(), orders), (inc.user_purchase_stats(), orders), (inc.product_daily_sales(), lines)):
                inc.refresh_changed(spark, self.root, spec, signed, batch_no)

        apply_changes(spark, self.feed, first, -1)
        follow(spark, -1)
        for number in range(BATCHES):
            here = (lots[0] == number) | ((lots[1] == 0) & (F.pmod(lots[0] + 1, F.lit(BATCHES)) == number))
            records.where(here).write.mode("append").parquet(arriving)
            # The stream goes on from its checkpoint: what has arrived since is one batch, of however many files.
            change_stream(read_file_stream(spark, arriving, records.schema), self.feed, f"{root}/checkpoint", follow)

    def aggregate(self, spec: inc.Increment) -> DataFrame:
        return inc.stored(self.spark, self.root, spec)


_HELD: dict[tuple[str, str], Maintained] = {}


def _maintained(c: Canon) -> Maintained:
    """The maintained tables, built once per session."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _HELD:
        _HELD[key] = Maintained(c)
    return _HELD[key]


_FINAL = """
, final AS (
  SELECT order_id, user_id, promo_id,
         CASE WHEN order_id % 77 = 0 THEN 'paid' WHEN order_id % 7 = 0 THEN 'cancelled' ELSE status END AS status,
         order_date + to_days(CASE WHEN order_id % 7 = 0 AND order_id % 77 <> 0 THEN 40 ELSE 0 END) AS order_date,
         CAST(total_amount + CASE WHEN order_id % 77 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS total_amount
  FROM c_orders WHERE order_id % 11 <> 0 OR order_id % 77 = 0),
final_valid AS (SELECT * FROM final WHERE status IN ('paid', 'shipped', 'completed'))"""


@query("change_feed_orders", _FINAL + """
SELECT order_id, user_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount, promo_id,
       CAST(year(order_date) * 100 + month(order_date) AS INTEGER) AS ym FROM final""")
def _(c: Canon) -> DataFrame:
    """Every order as its newest record has it."""
    held = _maintained(c)
    return shown(current(held.spark, held.feed))


@query("change_feed_log", """
SELECT CAST(COUNT(*) FILTER (WHERE order_id % 5 <> 0) AS BIGINT) AS first_load, CAST(3 AS BIGINT) AS batches,
       CAST(COUNT(*) FILTER (WHERE order_id % 11 <> 0 OR order_id % 77 = 0) AS BIGINT) AS left_over FROM c_orders""")
def _(c: Canon) -> DataFrame:
    """The log accounts for the rows that are there: inserted less deleted, over all batches."""
    held = _maintained(c)
    return applied(held.spark, held.feed).agg(
        F.sum(F.when(F.col("batch_no") == -1, F.col("inserted"))).alias("first_load"), F.count_distinct("batch_no").alias("batches"),
        F.sum(F.col("inserted") - F.col("deleted")).alias("left_over"))


@query("incremental_daily_gmv", _FINAL + """
SELECT date_trunc('day', order_date) AS dt, COUNT(*) AS order_count, CAST(SUM(total_amount) AS DOUBLE) AS gmv,
       (CAST(SUM(total_amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) AS avg_order_amount FROM final_valid GROUP BY 1""")
def _(c: Canon) -> DataFrame:
    return shown(_maintained(c).aggregate(inc.daily_gmv()))


@query("incremental_user_stats", _FINAL + """
SELECT user_id, COUNT(*) AS total_orders, CAST(SUM(total_amount) AS DOUBLE) AS total_spent FROM final_valid GROUP BY user_id""")
def _(c: Canon) -> DataFrame:
    return shown(_maintained(c).aggregate(inc.user_purchase_stats()))


@query("incremental_product_sales", _FINAL + """
SELECT CAST(order_date AS DATE) AS order_date, product_id AS sku_id, CAST(SUM(qty) AS BIGINT) AS total_qty,
       CAST(SUM(ROUND(qty * unit_price * (1 - COALESCE(discount_rate, 0.00)), 2)) AS DOUBLE) AS total_revenue
FROM c_items JOIN final_valid USING (order_id) LEFT JOIN c_promo USING (promo_id) GROUP BY 1, 2""")
def _(c: Canon) -> DataFrame:
    return shown(_maintained(c).aggregate(inc.product_daily_sales()))


@query("change_feed_partitions", """
, months AS (SELECT DISTINCT year(order_date) * 100 + month(order_date) AS ym FROM c_orders)
SELECT CAST(2 AS BIGINT) AS rewritten, COUNT(*) - 2 AS untouched FROM months""")
def _(c: Canon) -> DataFrame:
    """An order that moves from the fullest month but the first one to the first one: the files of two months are new, all others stand as they were."""
    feed = Feed(f"{scratch_path(c.spark, 'months')}/orders", ("order_id",), "ym", sort=("order_date",))
    orders = with_month(c.orders().select(*_COLUMNS), "order_date").withColumns({"op": F.lit(INSERT), "seq": F.lit(1).cast("long")})
    apply_changes(c.spark, feed, orders, 0)
    files = lambda: {(r.ym, r.file) for r in c.spark.read.parquet(feed.rows).select("ym", F.col("_metadata.file_path").alias("file")).distinct().collect()}
    before, low = files(), orders.agg(F.min("ym")).scalar()
    full = orders.where(F.col("ym") != low).groupBy("ym").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "ym")).alias("top")).select("top.ym").scalar()
    one = orders.where(F.col("ym") == full).agg(F.min("order_id").alias("order_id"))
    moved = orders.join(one, "order_id").withColumns({"ym": low, "op": F.lit(UPDATE), "seq": F.lit(2).cast("long")})
    apply_changes(c.spark, feed, moved.select(*orders.columns), 1)
    after = files()
    new, kept = {m for m, _ in after - before}, {m for m, _ in after & before}
    return c.spark.read.parquet(feed.rows).groupBy("ym").agg(F.count(F.lit(1))).select(
        F.col("ym").isin(*new).alias("new"), F.col("ym").isin(*kept).alias("kept")).agg(
        F.count_if(F.expr("new AND NOT kept")).alias("rewritten"), F.count_if(F.expr("kept AND NOT new")).alias("untouched"))
