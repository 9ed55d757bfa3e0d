"""The given tables in the shape of the operational sources.

Only integer, decimal and date arithmetic, so any engine derives the same rows.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.config import WarehouseConfig
from strataflow.operators.ordered import ordinals
from strataflow.plans import aggregates, facts
from strataflow.functions import time_bucket

CONFIG = WarehouseConfig(
    segment_high=Decimal("3000000"), segment_mid=Decimal("1500000"), focus_day=date(2024, 1, 15)
)


class Canon:
    """Lazy source frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, CONFIG

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # Sources

    def orders(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        november = F.month(day) == 11
        dom = F.dayofmonth(day)
        return self.raw("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.timestamp_add("SECOND", F.pmod(key * 7919, F.lit(86400)), day).alias("order_date"),
            F.when(F.pmod(key, F.lit(20)) == 0, "cancelled").when(F.col("o_orderstatus") == "F", "completed")
            .when(F.col("o_orderstatus") == "O", "shipped").otherwise("paid").alias("status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.when(november & dom.between(1, 10), 1).when(november & (dom == 11), 2)
            .when(november & dom.between(12, 14), 3).alias("promo_id"),
        )

    def items(self, with_id: bool = False) -> DataFrame:
        """Lines have no key of their own; ``with_id`` numbers all of them from 1, order by order.

        Lines that agree in every column get different numbers, so none is taken for a repeat of another.  The numbers are dealt in
        chunks of a range partitioning, so an order of any number of lines is spread like any other rows.  Columns behind the quantity
        are not carried: lines that agree up to it are the same rows here, whichever comes first.
        """
        lines = self.raw("lineitem")
        ids = []
        if with_id:
            order = ["l_orderkey", *[c for c in lines.columns if c != "l_orderkey"]]
            order = order[:order.index("l_quantity") + 1]
            lines = ordinals(lines.select(*order), order)
            ids = [F.col("row_no").alias("item_id")]
        price = self.raw("part").select("p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"))
        return lines.select(
            *ids, F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("qty"),
        ).join(price, F.col("product_id") == F.col("p_partkey")).drop("p_partkey")

    def places(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("province")
        )

    def users(self) -> DataFrame:
        customer = self.raw("customer")
        key = F.col("c_custkey")
        return customer.join(self.places(), customer.c_nationkey == F.col("n_nationkey")).select(
            key.alias("user_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.date_add(F.lit(date(1995, 1, 1)), F.pmod(key, F.lit(365)).cast("int")).alias("register_date"),
            "city",
            "province",
            F.lit("active").alias("status"),
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
            F.col("p_size").alias("stock"),
        )

    def region(self) -> DataFrame:
        """Every place."""
        return self.places().select(
            (F.col("n_nationkey") + 1).alias("region_id"),
            "province",
            "city",
            F.concat(F.col("city"), F.lit(" centre")).alias("district"),
            F.when(F.col("n_nationkey") < 5, "T1").otherwise("T2").alias("region_tier"),
        )

    def promotions(self) -> DataFrame:
        """Promotion rates by id; the periods follow the month of the order, not a year."""
        return self.spark.sql(
            "SELECT promo_id, CAST(rate AS DECIMAL(3,2)) AS discount_rate "
            "FROM VALUES (1, '0.10'), (2, '0.25'), (3, '0.15') AS t(promo_id, rate)"
        )

    def promotion_periods(self) -> DataFrame:
        """The three November periods of every year that has orders."""
        def period(promo_id: int, first: int, last: int, rate: str):
            year = F.col("year")
            return F.struct(
                F.lit(promo_id).alias("promo_id"),
                F.make_date(year, F.lit(11), F.lit(first)).alias("start_date"),
                F.make_date(year, F.lit(11), F.lit(last)).alias("end_date"),
                F.lit(Decimal(rate)).cast("decimal(3,2)").alias("discount_rate"),
            )

        years = self.raw("orders").select(F.year("o_orderdate").alias("year")).distinct()
        periods = F.array(period(1, 1, 10, "0.10"), period(2, 11, 11, "0.25"), period(3, 12, 14, "0.15"))
        return years.select(F.inline(periods))

    def payments(self) -> DataFrame:
        key = F.col("order_id")
        method = F.pmod(key, F.lit(3))
        return self.orders().where(F.col("status") != "cancelled").select(
            key.alias("payment_id"),
            "order_id",
            F.when(method == 0, "alipay").when(method == 1, "wechat").otherwise("card").alias("method"),
            F.timestamp_add("MINUTE", F.pmod(key, F.lit(11)), F.col("order_date")).alias("pay_date"),
            F.col("total_amount").alias("amount"),
            F.lit("completed").alias("status"),
        )

    def status_events(self) -> DataFrame:
        """Two to four transitions per order, expanded in place."""
        key, status = F.col("order_id"), F.col("status")

        def after(minutes, base):
            return F.timestamp_add("MINUTE", minutes, base)

        paid_at = after(F.pmod(key, F.lit(11)), F.col("order_date"))
        shipped_at = after((F.pmod(key, F.lit(37)) + 12) * 60, paid_at)
        done_at = after((F.pmod(key, F.lit(5)) + 1) * 1440, shipped_at)
        cancelled_at = after(F.pmod(key, F.lit(60)) + 1, F.col("order_date"))

        def event(step: int, source: str | None, target: str, at, actor: str, happens):
            row = F.struct(
                (key * 10 + step).alias("event_id"),
                F.lit(source).cast("string").alias("from_status"),
                F.lit(target).alias("to_status"),
                at.alias("event_time"),
                F.lit(actor).alias("operator_type"),
            )
            return F.when(happens, row)

        steps = F.array_compact(F.array(
            event(1, None, "created", F.col("order_date"), "user", F.lit(True)),
            event(2, "created", "cancelled", cancelled_at, "user", status == "cancelled"),
            event(3, "created", "paid", paid_at, "user", status != "cancelled"),
            event(4, "paid", "shipped", shipped_at, "system", status.isin("shipped", "completed")),
            event(5, "shipped", "completed", done_at, "system", status == "completed"),
        ))
        return self.orders().select("order_id", F.inline(steps)).select(
            "event_id", "order_id", "from_status", "to_status", "event_time", "operator_type"
        )

    def sources(self) -> dict[str, DataFrame]:
        """The six operational tables."""
        return {
            "users": self.users(),
            "products": self.products(),
            "orders": self.orders(),
            "order_items": self.items(with_id=True),
            "payments": self.payments(),
            "order_status_events": self.status_events(),
        }

    # Facts and aggregates, as lazy plans

    def order_core(self) -> DataFrame:
        return facts.order_core(self.orders())

    def placed_orders(self) -> DataFrame:
        return facts.with_region(self.order_core(), self.users(), self.region())

    def order_fact(self) -> DataFrame:
        return facts.order_fact(
            self.orders(), self.users(), self.region(), self.payments(), self.status_events(), self.items(),
            self.promotions(), self.cfg,
        )

    def detail_lines(self) -> DataFrame:
        return facts.detail_lines(self.items(), self.orders(), self.promotions())

    def event_fact(self) -> DataFrame:
        return facts.status_event_fact(self.status_events(), self.orders())

    def daily(self) -> DataFrame:
        return aggregates.daily_gmv(self.order_core(), self.cfg)

    def minutes(self) -> DataFrame:
        return aggregates.minute_traffic(self.order_core(), self.cfg)

    def product_days(self) -> DataFrame:
        return aggregates.product_daily_sales(self.detail_lines(), cfg=self.cfg)

    def user_stats(self) -> DataFrame:
        return aggregates.user_purchase_stats(self.order_core(), self.cfg)

    def funnel(self) -> DataFrame:
        return aggregates.status_funnel(self.status_events())

    def latency(self) -> DataFrame:
        return aggregates.fulfilment_latency(self.status_events())

    def promo_compare(self) -> DataFrame:
        return aggregates.promo_daily_compare(self.order_core(), self.cfg)

    # The event table as a time series

    def activity(self) -> DataFrame:
        return self.raw("events").select(
            "event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(10,2)").alias("amount")
        )

    def activity_minutes(self) -> DataFrame:
        return self.activity().groupBy(time_bucket("1 minute", "ts").alias("bucket_time")).agg(
            F.count(F.lit(1)).alias("minute_order_count"), F.sum("amount").alias("minute_gmv")
        )
