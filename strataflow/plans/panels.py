"""The thirteen dashboard panels: thin projections of the metrics."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import status_band
from strataflow.operators.pivot import pivot_filtered
from strataflow.plans import metrics

# The categories and segments the pie charts show, by output column.
CATEGORY_COLUMNS = {"电子": "electronics", "美妆": "beauty", "服装": "clothing", "家居": "home", "食品": "food"}
SEGMENT_COLUMNS = {"low": "low_value_users", "mid": "mid_value_users", "high": "high_value_users"}


def panel_daily(daily: DataFrame) -> DataFrame:
    return daily.select(F.col("dt").alias("time"), "gmv", "order_count").orderBy("time")


def panel_top_products(product_days: DataFrame, products: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return metrics.top_products(product_days, products, cfg)


def panel_category_pivot(categories: DataFrame, columns: Mapping[str, str] = CATEGORY_COLUMNS) -> DataFrame:
    return pivot_filtered(categories, "category", columns, "revenue")


def panel_repurchase(user_stats: DataFrame) -> DataFrame:
    return metrics.user_repurchase(user_stats).select("repurchase_rate")


def panel_region(regions: DataFrame) -> DataFrame:
    return regions.select("province", "gmv").orderBy(F.desc("gmv"))


def panel_running_gmv(minutes: DataFrame, day: date) -> DataFrame:
    return metrics.gmv_running_total(minutes, day).select(
        F.col("bucket_time").alias("time"), "running_gmv", "minute_gmv"
    ).orderBy("time")


def panel_running_orders(minutes: DataFrame, day: date) -> DataFrame:
    return metrics.gmv_running_total(minutes, day).select(
        F.col("bucket_time").alias("time"), "running_order_count", "minute_order_count"
    ).orderBy("time")


def panel_funnel(funnel: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return metrics.status_funnel_ordered(funnel, cfg).select("status", "order_count")


def panel_promo_pivot(compare: DataFrame) -> DataFrame:
    columns = {"normal": "normal_daily_avg_gmv", "promo": "promo_daily_avg_gmv"}
    return pivot_filtered(compare, "period", columns, "daily_avg_gmv", F.max)


def panel_segment_pivot(segments: DataFrame) -> DataFrame:
    return pivot_filtered(segments, "segment", SEGMENT_COLUMNS, "user_count")


def panel_minute_traffic(minutes: DataFrame, day: date) -> DataFrame:
    return metrics.on_day(minutes, "bucket_time", day).select(
        F.col("bucket_time").alias("time"), "minute_order_count"
    ).orderBy("time")


def panel_latency(latency: DataFrame) -> DataFrame:
    def shown(name: str):
        return F.round(F.col(name).cast("decimal(20,6)"), 1)

    return latency.select(
        shown("paid_to_shipped_hours").alias("paid_to_shipped"),
        shown("shipped_to_completed_hours").alias("shipped_to_completed"),
    )


def panel_peaks(minutes: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    return metrics.traffic_peak_minutes(minutes, cfg)


def panel_bands(user_stats: DataFrame, latency: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Colour band of the two stat panels."""
    rate = metrics.user_repurchase(user_stats).select(
        F.lit("repurchase_rate").alias("panel"), status_band(F.col("repurchase_rate"), cfg.repurchase_bands).alias("band")
    )
    hours = [
        latency.select(F.lit(name).alias("panel"), status_band(F.col(name), cfg.latency_bands).alias("band"))
        for name in ("paid_to_shipped_hours", "shipped_to_completed_hours")
    ]
    return rate.unionByName(hours[0]).unionByName(hours[1])
