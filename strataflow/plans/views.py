"""Named views, so that the warehouse can be queried in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.plans import metrics
from strataflow.plans.warehouse import Warehouse

DIMENSIONS = ("dim_product", "dim_user", "dim_region", "dim_promotion", "dim_date")
FACTS = ("order_fact", "order_detail_fact", "order_status_event_fact")
AGGREGATES = (
    "daily_gmv", "minute_traffic", "product_daily_sales", "user_purchase_stats", "status_funnel", "fulfilment_latency", "promo_daily_compare",
)


def metric_views(
    order_facts: DataFrame, products: DataFrame, region: DataFrame, aggregates: Mapping[str, DataFrame], cfg: WarehouseConfig = DEFAULT
) -> dict[str, DataFrame]:
    """The metrics by view name."""
    sales, minutes, users = (aggregates[n] for n in ("product_daily_sales", "minute_traffic", "user_purchase_stats"))
    return {
        "metric_top_products": metrics.top_products(sales, products, cfg),
        "metric_category_share": metrics.category_share(sales, products),
        "metric_user_repurchase": metrics.user_repurchase(users),
        "metric_user_segment": metrics.user_segment(users, cfg),
        "metric_gmv_by_region": metrics.gmv_by_region(order_facts, region),
        "metric_peak_minutes": metrics.traffic_peak_minutes(minutes, cfg),
        "metric_status_funnel": metrics.status_funnel_ordered(aggregates["status_funnel"], cfg),
        "metric_gmv_running_total": metrics.gmv_running_total(minutes, cfg.focus_day),
        "metric_promo_compare": metrics.promo_compare(aggregates["promo_daily_compare"]),
    }


def register_views(house: Warehouse, cfg: WarehouseConfig = DEFAULT) -> list[str]:
    """Temporary views of every dimension, fact, aggregate and metric of a built warehouse; their names."""
    frames = {name: house.read("dim", name) for name in DIMENSIONS}
    frames |= {name: house.read("dwd", name) for name in FACTS}
    aggregates = {name: house.aggregate(name) for name in AGGREGATES}
    frames |= aggregates | metric_views(frames["order_fact"], frames["dim_product"], frames["dim_region"], aggregates, cfg)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)
