"""Pre-aggregates over the facts.

Every aggregate is a partial aggregation before its shuffle, so a day, product
or buyer holding a third of the rows reaches its task as one row per input split.
Money stays decimal; averages are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import epoch_micros, safe_ratio, time_bucket


def valid_orders(facts: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return facts.where(F.col("status").isin(*cfg.valid_statuses))


def bucket_totals(
    df: DataFrame, width: str, ts: str, amount: str, bucket: str, count: str, total: str, mean: str
) -> DataFrame:
    """Count, sum and mean of one measure per time bucket."""
    return df.groupBy(time_bucket(width, ts).alias(bucket)).agg(
        F.count(F.lit(1)).alias(count), F.sum(amount).alias(total), F.count(amount).alias("_n"),
    ).select(bucket, count, total, safe_ratio(F.col(total), F.col("_n")).alias(mean))


def daily_gmv(order_facts: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return bucket_totals(
        valid_orders(order_facts, cfg), "1 day", "order_time", "total_amount",
        "dt", "order_count", "gmv", "avg_order_amount",
    )


def minute_traffic(order_facts: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return bucket_totals(
        valid_orders(order_facts, cfg), "1 minute", "order_time", "total_amount",
        "bucket_time", "minute_order_count", "minute_gmv", "avg_order_amount",
    )


def product_daily_sales(
    details: DataFrame, order_facts: DataFrame | None = None, cfg: WarehouseConfig = DEFAULT
) -> DataFrame:
    """Quantity and revenue per product and day of valid orders.

    The status comes from the order fact unless the lines already carry it,
    which saves joining the two largest tables a second time.
    """
    if order_facts is not None:
        details = details.drop("status").join(valid_orders(order_facts, cfg).select("order_id", "status"), "order_id")
    return valid_orders(details, cfg).groupBy("order_date", "sku_id").agg(
        F.sum("sku_num").alias("total_qty"), F.sum("line_amount").alias("total_revenue")
    )


def user_purchase_stats(order_facts: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return valid_orders(order_facts, cfg).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_amount").alias("total_spent")
    )


def status_funnel(event_facts: DataFrame) -> DataFrame:
    """Distinct orders per reached status; Spark spreads the distinct over (status, order) first."""
    return event_facts.groupBy(F.col("to_status").alias("status")).agg(
        F.count_distinct("order_id").alias("order_count")
    )


_STAGES = ("paid", "shipped", "completed")


def _weighted_latency(per_order: DataFrame) -> DataFrame:
    """Mean hours between the stages of each order, weighted by how often the stages repeat."""
    count = {s: F.col(f"_n_{s}").cast("double") for s in _STAGES}
    at = {s: F.col(f"_s_{s}") / count[s] for s in _STAGES}
    weight = count["paid"] * count["shipped"] * count["completed"]
    weighted = per_order.select(
        weight.alias("_w"),
        (weight * (at["shipped"] - at["paid"])).alias("_ship"),
        (weight * (at["completed"] - at["shipped"])).alias("_done"),
    )
    total = weighted.agg(*[F.sum(c).alias(c) for c in ("_w", "_ship", "_done")])
    return total.select(
        F.try_divide(F.col("_ship") / 3.6e9, F.col("_w")).alias("paid_to_shipped_hours"),
        F.try_divide(F.col("_done") / 3.6e9, F.col("_w")).alias("shipped_to_completed_hours"),
    )


def _event_clock() -> Column:
    """Microseconds since 2000 as a double: exact for single events and for sums of a few repeats.

    Primitive buffers keep the aggregation in its fast hash map and its shuffle
    narrow, and no number of repeats can overflow them.
    """
    return (epoch_micros("event_time") - F.lit(946_684_800_000_000)).cast("double")


def fulfilment_latency(event_facts: DataFrame) -> DataFrame:
    """Mean hours paid to shipped and shipped to completed, over orders that reached all three.

    Defined as a three-way join of the event table with itself, which pairs
    every repetition of a status with every repetition of the others.  The same
    weighted mean follows from counts and sums per order, so one aggregation
    replaces two joins and no pairs are ever formed.
    """
    clock, reached = _event_clock(), F.col("to_status")
    per_order = (
        event_facts.where(reached.isin(*_STAGES))
        .groupBy("order_id")
        .agg(
            *[F.count_if(reached == s).alias(f"_n_{s}") for s in _STAGES],
            *[F.sum(F.when(reached == s, clock)).alias(f"_s_{s}") for s in _STAGES],
        )
        .where(" AND ".join(f"_n_{s} > 0" for s in _STAGES))
    )
    return _weighted_latency(per_order)


def fulfilment_latency_joined(event_facts: DataFrame) -> DataFrame:
    """The same measure as a self join of three status aliases.

    Each alias is reduced to one row per order before it joins, with its number
    of repetitions as a weight, so the join stays one-to-one.
    """
    def alias(status: str) -> DataFrame:
        return event_facts.where(F.col("to_status") == status).groupBy("order_id").agg(
            F.count(F.lit(1)).alias(f"_n_{status}"), F.sum(_event_clock()).alias(f"_s_{status}")
        )

    return _weighted_latency(alias("paid").join(alias("shipped"), "order_id").join(alias("completed"), "order_id"))


def promo_daily_compare(order_facts: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Promotion and ordinary orders side by side.

    Days are counted by aggregating to (period, day) first, so the distinct
    count costs no row expansion and both steps combine before their shuffle.
    """
    period = F.when(F.col("promo_id") > 0, "promo").otherwise("normal")
    by_day = valid_orders(order_facts, cfg).groupBy(period.alias("period"), "order_date").agg(
        F.count(F.lit(1)).alias("_orders"), F.sum("total_amount").alias("_gmv"), F.count("total_amount").alias("_n")
    )
    both = by_day.groupBy("period").agg(
        F.count("order_date").alias("days"), F.sum("_orders").alias("order_cnt"),
        F.sum("_gmv").alias("gmv"), F.sum("_n").alias("_n"),
    )
    return both.select(
        "period", "days", "order_cnt", "gmv",
        safe_ratio(F.col("gmv"), F.col("days")).alias("daily_avg_gmv"),
        safe_ratio(F.col("gmv"), F.col("_n")).alias("avg_order_value"),
    )


def build_all(
    order_facts: DataFrame, details: DataFrame, event_facts: DataFrame, cfg: WarehouseConfig = DEFAULT
) -> dict[str, DataFrame]:
    """The seven pre-aggregates by name, in refresh order."""
    return {
        "daily_gmv": daily_gmv(order_facts, cfg),
        "minute_traffic": minute_traffic(order_facts, cfg),
        "product_daily_sales": product_daily_sales(details, None if "status" in details.columns else order_facts, cfg),
        "user_purchase_stats": user_purchase_stats(order_facts, cfg),
        "status_funnel": status_funnel(event_facts),
        "fulfilment_latency": fulfilment_latency(event_facts),
        "promo_daily_compare": promo_daily_compare(order_facts, cfg),
    }
