"""Scalar business rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def channel(order_id: Column) -> Column:
    """Sales channel from the last digit of the order id."""
    digit = F.pmod(order_id, F.lit(10))
    return F.when(digit.isin(0, 1), "miniapp").when(digit.isin(2, 3, 4), "web").otherwise("app")


def freight(order_id: Column, amount: Column, free_from: Decimal) -> Column:
    """Free above the limit, else spread over [8.00, 15.00) by the order id.

    The spread must be a function of the row: a random draw would change when a
    lost task is run again.
    """
    cents = F.pmod(F.pmod(order_id, F.lit(700)) * 433, F.lit(700))
    charged = (F.lit(800) + cents).cast("decimal(10,2)") / F.lit(100).cast("decimal(3,0)")
    return F.when(amount >= F.lit(free_from), F.lit(Decimal("0.00"))).otherwise(charged).cast("decimal(10,2)")


def _rate(rate: Column) -> Column:
    return F.coalesce(rate, F.lit(Decimal("0.00")))


def net_price(price: Column, rate: Column) -> Column:
    return F.round(price * (F.lit(1) - _rate(rate)), 2).cast("decimal(10,2)")


def line_amount(qty: Column, price: Column, rate: Column) -> Column:
    return F.round(qty * price * (F.lit(1) - _rate(rate)), 2).cast("decimal(12,2)")


def line_discount(qty: Column, price: Column, rate: Column) -> Column:
    return F.round(qty * price * _rate(rate), 2).cast("decimal(12,2)")


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``numerator * scale / denominator`` as a double; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double") * F.lit(float(scale)), denominator.cast("double"))


def status_band(value: Column, steps: Sequence[tuple[float, str]]) -> Column:
    """Label of the highest step whose lower bound ``value`` reaches; NULL below the first."""
    band = F.lit(None).cast("string")
    for bound, label in sorted(steps):
        band = F.when(value >= F.lit(float(bound)), F.lit(label)).otherwise(band)
    return band
