"""Fact tables.

Shape of the work: everything known at a coarser grain is settled there first
(users get their region before they meet orders, orders get both before they
meet their lines), and the many-per-order inputs are reduced to one row per
order before any join.  That keeps the joins on ``order_id`` one-to-one, so a
payment or event recorded twice cannot multiply orders, and an order with a
huge number of payments or events is combined map-side instead of travelling
whole.  Lines need their order's rate before they can be summed; an order with a
huge number of them is split by adaptive execution in that join.
No side is force-broadcast: dimensions may grow, and Spark broadcasts by
measured size and falls back to a shuffle join above its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import channel, freight, line_amount, line_discount, net_price


def order_core(orders: DataFrame) -> DataFrame:
    """The part of the order fact that needs no join."""
    return orders.where(F.col("status").isNotNull()).select(
        "order_id",
        "user_id",
        F.to_date("order_date").alias("order_date"),
        F.col("order_date").alias("order_time"),
        F.coalesce("promo_id", F.lit(0)).alias("promo_id"),
        "total_amount",
        channel(F.col("order_id")).alias("source_type"),
        "status",
    )


def user_region(users: DataFrame, region: DataFrame) -> DataFrame:
    """(user_id, region_id) through the composite city and province key; unmatched users have no row."""
    place = region.select(
        "region_id", F.col("city").alias("_city"), F.col("province").alias("_province")
    )
    on = (F.col("city") == F.col("_city")) & (F.col("province") == F.col("_province"))
    return users.select("user_id", "city", "province").join(place, on, "inner").select("user_id", "region_id")


def with_region(facts: DataFrame, users: DataFrame, region: DataFrame) -> DataFrame:
    """Adds ``region_id``, 0 where the buyer's place is unknown."""
    return facts.join(user_region(users, region), "user_id", "left").withColumn(
        "region_id", F.coalesce("region_id", F.lit(0))
    )


def order_discount(items: DataFrame, orders: DataFrame, promotions: DataFrame, discounted_only: bool = False) -> DataFrame:
    """Promotion discount per order, each line rounded before it is summed.

    ``discounted_only`` leaves out orders without a promotion before they reach
    the join; whoever reads the result with a default of 0 sees no difference.
    """
    rates = promotions.select("promo_id", "discount_rate")
    parents = orders.select("order_id", "promo_id").join(rates, "promo_id", "inner" if discounted_only else "left")
    if discounted_only:
        parents = parents.where(F.col("discount_rate") > 0)
    lines = items.select("order_id", "qty", "unit_price").join(
        parents.select("order_id", "discount_rate"), "order_id", "inner"
    )
    line = line_discount(F.col("qty"), F.col("unit_price"), F.col("discount_rate"))
    return lines.groupBy("order_id").agg(F.sum(line).alias("discount_amount"))


def order_fact(
    orders: DataFrame, users: DataFrame, region: DataFrame, payments: DataFrame, events: DataFrame,
    items: DataFrame, promotions: DataFrame, cfg: WarehouseConfig = DEFAULT,
) -> DataFrame:
    """One row per order: 14 columns."""
    paid = payments.groupBy("order_id").agg(F.min("pay_date").alias("pay_time"))
    # The status predicate belongs to the event side; orders without such an event keep a NULL time.
    closed = (
        events.where(F.col("to_status").isin("cancelled", "completed"))
        .groupBy("order_id")
        .agg(
            F.min(F.when(F.col("to_status") == "cancelled", F.col("event_time"))).alias("_cancelled_at"),
            F.min(F.when(F.col("to_status") == "completed", F.col("event_time"))).alias("_completed_at"),
        )
    )
    discount = order_discount(items, orders, promotions, discounted_only=True)
    joined = (
        order_core(orders)
        .join(paid, "order_id", "left")
        .join(closed, "order_id", "left")
        .join(discount, "order_id", "left")
    )
    return with_region(joined, users, region).select(
        "order_id",
        "user_id",
        "order_date",
        "order_time",
        "region_id",
        "promo_id",
        "total_amount",
        freight(F.col("order_id"), F.col("total_amount"), cfg.free_freight_from).alias("freight_amount"),
        F.coalesce("discount_amount", F.lit(0)).cast("decimal(22,2)").alias("discount_amount"),
        "pay_time",
        F.when(F.col("status") == "cancelled", F.col("_cancelled_at")).alias("cancel_time"),
        F.when(F.col("status") == "completed", F.col("_completed_at")).alias("finish_time"),
        "source_type",
        "status",
    )


_LINE_COLUMNS = ("detail_id", "order_id", "user_id", "sku_id", "order_date", "order_time")


def detail_lines(items: DataFrame, orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Lines with their order's attributes and discounted amounts; everything but the region."""
    return _lines(items, order_core(orders), promotions)


def _lines(items: DataFrame, order_rows: DataFrame, promotions: DataFrame) -> DataFrame:
    rates = promotions.select("promo_id", "discount_rate")
    parents = order_rows.join(rates, "promo_id", "left")
    identity = [F.col("item_id").alias("detail_id")] if "item_id" in items.columns else []
    lines = items.select(*identity, "order_id", F.col("product_id").alias("sku_id"), "qty", "unit_price")
    qty, price, rate = F.col("qty"), F.col("unit_price"), F.col("discount_rate")
    lead = [c for c in _LINE_COLUMNS if c in lines.columns or c in parents.columns]
    place = ["region_id"] if "region_id" in parents.columns else []
    return lines.join(parents, "order_id", "inner").select(
        *lead,
        *place,
        "promo_id",
        qty.alias("sku_num"),
        price.alias("original_price"),
        net_price(price, rate).alias("final_price"),
        line_amount(qty, price, rate).alias("line_amount"),
        "source_type",
        "status",
    )


def order_detail_fact(
    items: DataFrame, orders: DataFrame, users: DataFrame, region: DataFrame, promotions: DataFrame, with_status: bool = False,
) -> DataFrame:
    """One row per line; the region joins the orders, which are fewer, before the lines do.

    ``with_status`` keeps the order's status, which saves the aggregates another join with the orders.
    """
    lines = _lines(items, with_region(order_core(orders), users, region), promotions)
    return lines if with_status else lines.drop("status")


def status_event_fact(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Status transitions of known orders with the buyer and the event day."""
    return events.join(orders.select("order_id", "user_id"), "order_id", "inner").select(
        "event_id", "order_id", "user_id", "from_status", "to_status", "event_time",
        F.to_date("event_time").alias("event_date"), "operator_type",
    )
