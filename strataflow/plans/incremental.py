"""Pre-aggregates kept up to date from what changed, without reading the facts again.

An aggregate is stored as sums that can be taken back: rows, amounts and how many amounts were known, per group.  A change takes the old row's
share away and adds the new one's, so a batch of changes is one aggregation of its images.  Groups whose rows have
gone vanish; sums over none are null, as they are when computed anew.

The groups lie in partitions, of which only those with a change are read and written.  Every row of a partition carries the number of the batch
it was written by: a partition that has a batch already is passed over when the batch is replayed, so a failure between partitions counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import safe_ratio, time_bucket
from strataflow.plans import facts
from strataflow.plans.aggregates import valid_orders
from strataflow.session import settle
from strataflow.sinks.changes import SIGN, _read, in_partitions, partition_values, replace_partitions

_ROWS, _UPTO, _PART = "_rows", "_upto", "_part"


@dataclass(frozen=True)
class Increment:
    """Keys and sums of an aggregate, each an expression and its stored type, the partition of a group, and the columns shown."""

    name: str
    keys: Mapping[str, Column]
    sums: Mapping[str, tuple[Column, str]]
    part: Column
    finish: Callable[[DataFrame], DataFrame]


def _known(total: str, known: str) -> Column:
    """A sum, null where no value went into it."""
    return F.when(F.col(known) > 0, F.col(total))


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def _present(name: str) -> tuple[Column, str]:
    return F.col(name).isNotNull().cast("int"), "long"


BUYER_BUCKETS = 64


def daily_gmv() -> Increment:
    return Increment(
        "daily_gmv", {"dt": time_bucket("1 day", "order_time")},
        {"gmv": (F.coalesce("total_amount", F.lit(0)), "decimal(38,2)"), "_known": _present("total_amount")}, _month(F.col("dt")),
        lambda rows: rows.select(
            "dt", F.col(_ROWS).alias("order_count"), _known("gmv", "_known").alias("gmv"),
            safe_ratio(_known("gmv", "_known"), F.col("_known")).alias("avg_order_amount")))


def user_purchase_stats() -> Increment:
    return Increment(
        "user_purchase_stats", {"user_id": F.col("user_id")},
        {"total_spent": (F.coalesce("total_amount", F.lit(0)), "decimal(38,2)"), "_known": _present("total_amount")},
        F.pmod(F.xxhash64("user_id"), F.lit(BUYER_BUCKETS)).cast("int"),
        lambda rows: rows.select("user_id", F.col(_ROWS).alias("total_orders"), _known("total_spent", "_known").alias("total_spent")))


def product_daily_sales() -> Increment:
    return Increment(
        "product_daily_sales", {"order_date": F.col("order_date"), "sku_id": F.col("sku_id")},
        {"total_qty": (F.coalesce("sku_num", F.lit(0)), "long"), "_known_qty": _present("sku_num"),
         "total_revenue": (F.coalesce("line_amount", F.lit(0)), "decimal(38,2)"), "_known": _present("line_amount")}, _month(F.col("order_date")),
        lambda rows: rows.select(
            "order_date", "sku_id", _known("total_qty", "_known_qty").alias("total_qty"), _known("total_revenue", "_known").alias("total_revenue")))


def signed_orders(images: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Signed images of source orders as signed facts of valid orders."""
    signs = [valid_orders(facts.order_core(images.where(F.col(SIGN) == sign)), cfg).withColumn(SIGN, F.lit(sign)) for sign in (-1, 1)]
    return signs[0].unionByName(signs[1])


def signed_lines(images: DataFrame, items: DataFrame, promotions: DataFrame, cfg: WarehouseConfig = DEFAULT) -> DataFrame:
    """Signed lines of the orders in signed images; lines and rates themselves don't change."""
    signs = [valid_orders(facts.detail_lines(items, images.where(F.col(SIGN) == sign), promotions), cfg).withColumn(SIGN, F.lit(sign)) for sign in (-1, 1)]
    return signs[0].unionByName(signs[1])


def items_of(items: DataFrame, images: DataFrame, key_range: str, step: int, first: int = 1) -> DataFrame:
    """The stored lines in the key ranges of changed orders: the other ranges are not read."""
    from strataflow.sinks.tables import with_key_range

    ranges = partition_values(with_key_range(images.select("order_id"), "order_id", step, first, "_range"), "_range")
    return items.where(in_partitions(key_range, ranges)).drop(key_range)


def partials(signed: DataFrame, spec: Increment) -> DataFrame:
    """The signed sums of a batch per group; combined before the shuffle, so a hot group is one row per task."""
    rows = signed.select(*[expr.alias(name) for name, expr in spec.keys.items()], SIGN, *[expr.alias(name) for name, (expr, _) in spec.sums.items()])
    sums = rows.groupBy(*spec.keys).agg(
        F.sum(SIGN).alias(_ROWS), *[F.sum(F.col(name) * F.col(SIGN)).cast(kind).alias(name) for name, (_, kind) in spec.sums.items()])
    return sums.withColumn(_PART, spec.part)


def refresh_changed(spark: SparkSession, root: str, spec: Increment, signed: DataFrame, batch_no: int) -> int:
    """Adds a batch of signed rows to the stored aggregate; the number of partitions written."""
    path = f"{root}/{spec.name}"
    delta = settle(partials(signed, spec), f"{spec.name}-delta")
    values, base = partition_values(delta, _PART), _read(spark, path)
    if base is not None:
        stored = base.where(in_partitions(_PART, values))
        done = partition_values(stored.groupBy(_PART).agg(F.max(_UPTO).alias(_UPTO)).where(F.col(_UPTO) >= batch_no), _PART)
        values = [v for v in values if v not in done]
    if not values:
        return 0
    both = delta.where(in_partitions(_PART, values))
    if base is not None:
        both = base.where(in_partitions(_PART, values)).drop(_UPTO).unionByName(both)
    merged = both.groupBy(_PART, *spec.keys).agg(
        F.sum(_ROWS).alias(_ROWS), *[F.sum(name).cast(kind).alias(name) for name, (_, kind) in spec.sums.items()])
    merged = settle(merged.withColumn(_UPTO, F.lit(batch_no).cast("long")), f"{spec.name}-merged")
    # A partition that has lost all its rows keeps its empty groups, which say what batch it has; readers do not see them.
    alive = merged.where(F.col(_ROWS) > 0).select(F.col(_PART).alias("_alive")).distinct()
    gone = merged.join(alive, F.col(_PART).eqNullSafe(F.col("_alive")), "left_anti")
    left = merged.where(F.col(_ROWS) > 0).unionByName(gone.where(F.col(_ROWS) <= 0))
    replace_partitions(spark, path, left, values, _PART, tuple(spec.keys))
    return len(values)


def stored(spark: SparkSession, root: str, spec: Increment) -> DataFrame:
    """The aggregate as it is when computed anew."""
    return spec.finish(spark.read.parquet(f"{root}/{spec.name}").where(F.col(_ROWS) > 0))
