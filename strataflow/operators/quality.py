"""Data-quality expectations.

A check is an aggregate plus a verdict on its value.  All checks on one frame
are evaluated in a single aggregation of that frame, and a suite is the union of
those one-pass results: no job per check and no value travels to the driver
until the verdicts are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import safe_ratio
from strataflow.operators.ordered import lagged


@dataclass(frozen=True)
class Check:
    name: str
    observed: Column
    verdict: Callable[[Column], Column]


def expect(name: str, observed: Column, verdict: Callable[[Column], Column]) -> Check:
    return Check(name, observed, verdict)


def expect_count(name: str, n: int) -> Check:
    return Check(name, F.count(F.lit(1)), lambda v: v == n)


def expect_min_count(name: str, n: int) -> Check:
    return Check(name, F.count(F.lit(1)), lambda v: v >= n)


def expect_sum(name: str, value: Column, target: float, tolerance: float) -> Check:
    return Check(name, F.coalesce(F.sum(value), F.lit(0)), lambda v: F.abs(v - F.lit(target)) < tolerance)


def expect_min(name: str, value: Column, low: float) -> Check:
    """``value`` is an aggregate such as ``F.min(...)``."""
    return Check(name, value, lambda v: v >= low)


def expect_between(name: str, value: Column, low: float, high: float) -> Check:
    return Check(name, value, lambda v: v.between(low, high))


def expect_no_violation(name: str, violation: Column) -> Check:
    return Check(name, F.count_if(F.coalesce(violation, F.lit(False))), lambda v: v == 0)


def expect_some(name: str, hit: Column) -> Check:
    return Check(name, F.count_if(F.coalesce(hit, F.lit(False))), lambda v: v > 0)


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_name, observed, passed): one row per check, one pass over ``df``; a NULL value fails."""
    measured = df.agg(*[c.observed.cast("double").alias(f"_v{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.col(f"_v{i}").alias("observed"),
            F.coalesce(c.verdict(F.col(f"_v{i}")), F.lit(False)).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return measured.select(F.inline(F.array(*rows)))


def expect_unique(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return evaluate(repeated, [expect_no_violation(name, F.col("_n") > 1)])


def suite(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def summary(results: DataFrame) -> DataFrame:
    """One row: how many checks passed, how many there are, and whether that is all of them."""
    return results.agg(
        F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"), F.every("passed").alias("all_passed")
    )


def per_day_counts(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def burst(days: DataFrame, day: str, measure: str, focus) -> Column:
    """Aggregate over a daily frame: the focus day against the mean of all other days."""
    is_focus = F.col(day) == F.lit(focus)
    return safe_ratio(
        F.sum(F.when(is_focus, F.col(measure))), F.avg(F.when(~is_focus, F.col(measure).cast("double")))
    )


def burst_ratio(df: DataFrame, day: str, focus) -> DataFrame:
    """One row: rows on the focus day, mean rows on other days, and their ratio."""
    days = per_day_counts(df, day)
    is_focus = F.col("day") == F.lit(focus)
    return days.agg(
        F.coalesce(F.sum(F.when(is_focus, F.col("n"))), F.lit(0)).alias("focus_rows"),
        F.sum(F.when(~is_focus, F.col("n"))).alias("_rest"),
        F.count_if(~is_focus).alias("_days"),
    ).select(
        "focus_rows",
        safe_ratio(F.col("_rest"), F.col("_days")).alias("other_day_mean"),
        safe_ratio(F.col("focus_rows") * F.col("_days"), F.col("_rest")).alias("burst_ratio"),
    )


def child_ratio(children: DataFrame, parents: DataFrame) -> DataFrame:
    """One row with both row counts and their quotient, from one scan of each side."""
    sizes = children.select(F.lit(1).alias("_child")).unionByName(parents.select(F.lit(0).alias("_child"))).agg(
        F.count_if(F.col("_child") == 1).alias("children"), F.count_if(F.col("_child") == 0).alias("parents")
    )
    return sizes.withColumn("ratio", safe_ratio(F.col("children"), F.col("parents")))


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"))


def orders_with_item_count_ne(items: DataFrame, n: int) -> DataFrame:
    return items_per_order(items).where(F.col("item_count") != n).agg(F.count(F.lit(1)).alias("orders"))


def reconcile_amounts(order_facts: DataFrame, details: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Orders whose header differs from the sum of their lines by more than the tolerance.

    Lines are summed before the join, so it is one-to-one whatever an order's size.
    """
    lines = details.groupBy("order_id").agg(F.round(F.sum("line_amount"), 2).alias("detail_amount"))
    return (
        order_facts.select("order_id", "total_amount")
        .join(lines, "order_id")
        .where(F.abs(F.col("total_amount") - F.col("detail_amount")) > F.lit(cfg.reconcile_tolerance))
    )


def reconcile_raw(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose header is not exactly the undiscounted sum of their lines."""
    lines = items.groupBy("order_id").agg(F.sum(F.col("qty") * F.col("unit_price")).alias("items_total"))
    return (
        lines.join(orders.select("order_id", "total_amount"), "order_id")
        .where(F.col("items_total") != F.col("total_amount"))
    )


def running_violations(running: DataFrame, order: str = "bucket_time", measure: str = "running_gmv") -> DataFrame:
    """Rows of a minute series where the running measure falls below the minute before."""
    return lagged(running, [order], measure, chunk=F.to_date(order)).where(
        F.col("previous").isNotNull() & (F.col(measure) < F.col("previous"))
    )


def region_match(order_facts: DataFrame) -> DataFrame:
    """Share of orders whose buyer's place is a known region."""
    return order_facts.agg(
        F.count_if(F.col("region_id") != 0).alias("matched"), F.count(F.lit(1)).alias("orders")
    ).withColumn("match_pct", safe_ratio(F.col("matched"), F.col("orders"), 100))


def price_deviation(items: DataFrame, products: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Lines priced further than ``tolerance`` from the product's list price.

    Lines are reduced to distinct (product, price) with a count before the join,
    so a best seller joins as its few distinct prices.
    """
    priced = items.groupBy("product_id", "unit_price").agg(F.count(F.lit(1)).alias("lines"))
    gap = F.abs(F.col("unit_price").cast("double") - F.col("price").cast("double"))
    return (
        priced.join(products.select("product_id", "price"), "product_id")
        .where(gap > F.lit(tolerance) * F.col("price").cast("double"))
        .groupBy("product_id", "unit_price")
        .agg(F.sum("lines").alias("lines"))
    )


_CHAINS = {"completed": ("created", "paid", "shipped", "completed"), "cancelled": ("created", "cancelled")}


def event_chain_gaps(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Completed and cancelled orders whose chain of events has a gap: an event that is missing, has no time, or comes before the one it follows.

    Repeated events count by their first time.  Events of the same moment are in order.
    """
    statuses = dict.fromkeys(s for chain in _CHAINS.values() for s in chain)
    seen = events.where(F.col("to_status").isin(*statuses)).groupBy("order_id").agg(
        *[F.min(F.when(F.col("to_status") == s, F.col("event_time"))).alias(f"_{s}") for s in statuses])
    joined = orders.where(F.col("status").isin(*_CHAINS)).select("order_id", "status").join(seen, "order_id", "left")
    full = F.lit(True)
    for status, chain in _CHAINS.items():
        steps = [F.col(f"_{a}") <= F.col(f"_{b}") for a, b in zip(chain, chain[1:])]
        full = F.when(F.col("status") == status, F.coalesce(reduce(lambda a, b: a & b, steps), F.lit(False))).otherwise(full)
    return joined.where(~full).select("order_id", "status")


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order ids that lines refer to but no order has, with their line counts."""
    return items_per_order(items).join(orders.select("order_id"), "order_id", "left_anti")


def cancelled_in_gmv(daily_total: DataFrame, order_facts: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Daily amount minus the amount of valid orders; anything but 0 means other statuses leaked in."""
    valid = order_facts.agg(
        F.sum(F.when(F.col("status").isin(*cfg.valid_statuses), F.col("total_amount")))
    ).scalar()
    return daily_total.agg(F.sum("gmv").alias("gmv")).withColumn("leak", F.col("gmv") - valid)
