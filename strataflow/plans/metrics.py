"""Business metrics over the pre-aggregates.

Results are unordered unless a top-k decides which rows exist; sort at the
outermost call where an order is shown.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import safe_ratio, wall
from strataflow.operators.ordered import ordinals, running_total
from strataflow.operators.pivot import share_of_total
from strataflow.plans.aggregates import valid_orders


def day_window(day: date) -> tuple[datetime, datetime]:
    start = datetime.combine(day, time())
    return start, start + timedelta(days=1)


def on_day(df: DataFrame, ts: str, day: date) -> DataFrame:
    """Rows of one wall-clock day as a half-open range, which the scan can use."""
    low, high = day_window(day)
    return df.where((F.col(ts) >= wall(low)) & (F.col(ts) < wall(high)))


def top_by(df: DataFrame, measures: Sequence[str], k: int, tiebreak: str) -> DataFrame:
    """The k greatest rows; each task keeps k, so nothing is sorted globally."""
    return df.orderBy(*[F.col(m).desc() for m in measures], F.col(tiebreak).asc()).limit(k)


def top_products(product_days: DataFrame, products: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Best sellers by revenue; the limit comes before the dimension join."""
    per_product = product_days.groupBy("sku_id").agg(
        F.sum("total_qty").alias("total_qty"), F.sum("total_revenue").alias("total_revenue")
    )
    best = top_by(per_product, ["total_revenue"], cfg.top_products, "sku_id")
    # At most top_products rows: a proven size.
    return products.join(F.broadcast(best), products.product_id == best.sku_id).select(
        "product_name", "category", "total_qty", "total_revenue"
    )


def category_revenue(product_days: DataFrame, products: DataFrame) -> DataFrame:
    per_product = product_days.groupBy("sku_id").agg(F.sum("total_revenue").alias("revenue"))
    named = per_product.join(products.select("product_id", "category"), F.col("sku_id") == F.col("product_id"))
    return named.groupBy("category").agg(F.sum("revenue").alias("revenue"))


def category_share(product_days: DataFrame, products: DataFrame) -> DataFrame:
    return share_of_total(category_revenue(product_days, products), "revenue")


def user_repurchase(user_stats: DataFrame) -> DataFrame:
    """Share of buyers with more than one order; NULL when there are no buyers."""
    return user_stats.agg(
        F.count_if(F.col("total_orders") > 1).alias("repeat_buyers"), F.count(F.lit(1)).alias("total_buyers")
    ).select(
        safe_ratio(F.col("repeat_buyers"), F.col("total_buyers"), 100).alias("repurchase_rate"),
        "repeat_buyers", "total_buyers",
    )


def segment_of(spent: Column, cfg: WarehouseConfig = DEFAULT) -> Column:
    return F.when(spent >= cfg.segment_high, "high").when(spent >= cfg.segment_mid, "mid").otherwise("low")


def user_segment(user_stats: DataFrame, cfg: WarehouseConfig = DEFAULT, mode: str = "threshold") -> DataFrame:
    """Buyers and orders per spend segment: by fixed cut points, or by exact terciles."""
    if mode == "threshold":
        segments = user_stats.withColumn("segment", segment_of(F.col("total_spent"), cfg))
    elif mode == "ntile":
        ranked = ordinals(user_stats, ["total_spent", "user_id"], ntiles=3)
        names = F.when(F.col("tile") == 3, "high").when(F.col("tile") == 2, "mid").otherwise("low")
        segments = ranked.withColumn("segment", names)
    else:
        raise ValueError(f"unknown segmentation {mode!r}")
    return segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("user_count"), F.sum("total_orders").alias("total_orders")
    )


def gmv_by_region(
    order_facts: DataFrame, region: DataFrame, valid_only: bool = False, cfg: WarehouseConfig = DEFAULT
) -> DataFrame:
    """Orders and amount per province.  All statuses count unless ``valid_only``; unknown places drop out.

    The fact has one row per order, which the suite checks, so orders are counted without a distinct.
    """
    facts = valid_orders(order_facts, cfg) if valid_only else order_facts
    placed = facts.select("region_id", "order_id", "total_amount").join(
        region.select("region_id", "province"), "region_id"
    )
    return placed.groupBy("province").agg(
        F.count("order_id").alias("order_cnt"), F.sum("total_amount").alias("gmv")
    )


def traffic_peak_minutes(minutes: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return top_by(minutes, ["minute_order_count", "minute_gmv"], cfg.peak_minutes, "bucket_time").select(
        "bucket_time", "minute_order_count", "minute_gmv"
    )


def status_rank(status: Column, cfg: WarehouseConfig = DEFAULT) -> Column:
    rank = F.lit(9)
    for number, name in enumerate(cfg.funnel_order, start=1):
        rank = F.when(status == name, number).otherwise(rank)
    return rank


def status_funnel_ordered(funnel: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """The funnel with its step number, so the order survives wherever the rows go."""
    return funnel.select(status_rank(F.col("status"), cfg).alias("step_no"), "status", "order_count").orderBy(
        "step_no", "status"
    )


def funnel_conversion(funnel: DataFrame) -> DataFrame:
    """One row of step rates in percent."""
    def reached(status: str) -> Column:
        return F.sum(F.when(F.col("status") == status, F.col("order_count")))

    counts = funnel.agg(*[reached(s).alias(s) for s in ("created", "paid", "shipped", "completed", "cancelled")])
    return counts.select(
        safe_ratio(F.col("paid"), F.col("created"), 100).alias("paid_pct"),
        safe_ratio(F.col("shipped"), F.col("paid"), 100).alias("shipped_pct"),
        safe_ratio(F.col("completed"), F.col("shipped"), 100).alias("completed_pct"),
        safe_ratio(F.col("cancelled"), F.col("created"), 100).alias("cancelled_pct"),
    )


_RUNNING = {"minute_gmv": "running_gmv", "minute_order_count": "running_order_count"}


def gmv_running_total(minutes: DataFrame, day: date | None = None) -> DataFrame:
    """Running amount and orders per minute, of one day or of the whole series.

    A day has at most 1,440 minutes, so the day is the natural chunk.
    """
    series = minutes if day is None else on_day(minutes, "bucket_time", day)
    return running_total(series, ["bucket_time"], _RUNNING, chunk=F.to_date("bucket_time")).select(
        "bucket_time", "minute_gmv", "running_gmv", "minute_order_count", "running_order_count"
    )


def promo_compare(compare: DataFrame) -> DataFrame:
    """Adds the promotion's uplift over ordinary days in percent, 0 for ordinary days themselves."""
    ordinary = compare.where(F.col("period") == "normal").agg(F.max("daily_avg_gmv")).scalar()
    uplift = (F.try_divide(F.col("daily_avg_gmv"), ordinary) - 1) * 100
    return compare.withColumn("uplift_pct", F.when(F.col("period") == "promo", uplift).otherwise(F.lit(0.0)))


def promo_by_date_range(order_facts: DataFrame, promotions: DataFrame) -> DataFrame:
    """Orders with the promotion whose validity period covers their day.

    A range condition would compare every order with every promotion.  Written
    out day by day, the promotions join on equality and stay shuffle-safe.  Periods are clipped to the days
    that have orders, so open ends cost nothing; a period that ends before it starts matches no day.
    """
    days = order_facts.agg(F.min("order_date").alias("low"), F.max("order_date").alias("high"))
    first = F.greatest(F.col("start_date"), days.select("low").scalar())
    last = F.least(F.col("end_date"), days.select("high").scalar())
    periods = promotions.select(F.col("promo_id").alias("range_promo_id"), "discount_rate", first.alias("_first"), last.alias("_last"))
    valid_days = periods.where("_first <= _last").select(
        "range_promo_id", "discount_rate", F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))).alias("order_date"))
    return order_facts.join(valid_days, "order_date", "left")


def daily_buyers_by_calendar(order_facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Paying users, orders and amount per calendar day.

    Rows are first reduced to one per (day, user); the distinct count is then a plain count.
    """
    per_user = order_facts.groupBy("order_date", "user_id").agg(
        F.count("order_id").alias("_orders"), F.sum("total_amount").alias("_gmv")
    )
    per_day = per_user.groupBy("order_date").agg(
        F.count("user_id").alias("paying_users"), F.sum("_orders").alias("orders"), F.sum("_gmv").alias("gmv")
    )
    return per_day.join(dates.select("date_key"), per_day.order_date == F.col("date_key")).select(
        "date_key", "paying_users", "orders", "gmv"
    )


def rank_products_in_category(product_days: DataFrame, products: DataFrame) -> DataFrame:
    """Products by revenue within their category; exact for any category size."""
    per_product = product_days.groupBy("sku_id").agg(F.sum("total_revenue").alias("total_revenue"))
    named = per_product.join(
        products.select(F.col("product_id").alias("sku_id"), "category"), "sku_id"
    ).withColumn("_neg", -F.col("total_revenue"))
    return ordinals(named, ["_neg", "sku_id"], keys=["category"], rank=True).select(
        "category", "sku_id", "total_revenue", F.col("row_no"), F.col("rank_no")
    )
