"""Declarative row cleaning."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CleanRule:
    required: tuple[str, ...]
    defaults: Mapping[str, object] = field(default_factory=dict)
    money: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()


# Which columns a row must have and what a missing optional one becomes.
CLEAN_RULES: dict[str, CleanRule] = {
    "users": CleanRule(("user_id", "name"), {"status": "active"}),
    "products": CleanRule(("product_id", "product_name"), {"price": 0, "stock": 0}, ("price",), ("stock",)),
    "orders": CleanRule(
        ("order_id", "user_id", "order_date"),
        {"total_amount": 0, "status": "unknown", "promo_id": 0},
        ("total_amount",),
        ("promo_id",),
    ),
    "order_items": CleanRule(
        ("item_id", "order_id", "product_id"), {"qty": 1, "unit_price": 0}, ("unit_price",), ("qty",)
    ),
    "payments": CleanRule(("payment_id", "order_id"), {"amount": 0, "status": "completed"}, ("amount",)),
    "order_status_events": CleanRule(
        ("event_id", "order_id", "to_status", "event_time"), {"from_status": "", "operator_type": "system"}
    ),
}


def clean(df: DataFrame, rule: CleanRule) -> DataFrame:
    """Drop rows lacking a required column, fill defaults, round money to cents, cast counts.

    One projection over one filter, so it fuses with the scan and the required
    columns reach it as IS NOT NULL predicates.
    """
    typed: dict[str, Column] = {}
    for name in df.columns:
        value = F.col(name)
        if name in rule.money:
            value = F.round(value, 2).cast("decimal(12,2)")
        elif name in rule.integers:
            value = value.cast("int")
        if name in rule.defaults:
            filler = F.lit(rule.defaults[name])
            value = F.coalesce(value, filler.cast("decimal(12,2)") if name in rule.money else filler)
        typed[name] = value.alias(name)
    return df.na.drop(subset=list(rule.required)).select(*typed.values())


def is_complete(rule: CleanRule) -> Column:
    """Whether a row has every required column."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.required])


def clean_report(tables: Mapping[str, DataFrame], rules: Mapping[str, CleanRule] = CLEAN_RULES) -> DataFrame:
    """(table_name, kept, dropped) per table, each from one pass over its required columns."""
    def one(name: str, df: DataFrame) -> DataFrame:
        complete = is_complete(rules[name])
        return df.agg(
            F.count_if(complete).alias("kept"), F.count_if(~complete).alias("dropped")
        ).select(F.lit(name).alias("table_name"), "kept", "dropped")

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])
