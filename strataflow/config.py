"""Business constants shared by every layer, kept in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class WarehouseConfig:
    # The statuses, codes and cut points the metrics are defined by.
    valid_statuses: tuple[str, ...] = ("paid", "shipped", "completed")
    funnel_order: tuple[str, ...] = ("created", "paid", "shipped", "completed", "cancelled")
    segment_high: Decimal = Decimal("300000")
    segment_mid: Decimal = Decimal("10000")
    free_freight_from: Decimal = Decimal("200")
    focus_day: date = date(2024, 11, 11)
    top_products: int = 10
    peak_minutes: int = 20
    reconcile_tolerance: Decimal = Decimal("0.05")
    # Dashboard bands: (lower bound, label), ascending.
    repurchase_bands: tuple[tuple[float, str], ...] = ((0, "red"), (30, "yellow"), (50, "green"))
    latency_bands: tuple[tuple[float, str], ...] = ((0, "green"), (48, "yellow"), (96, "red"))
    # Check thresholds.
    min_layout_savings_pct: float = 50.0
    min_burst_ratio: float = 50.0
    min_item_ratio: float = 2.0
    max_item_ratio: float = 5.0
    min_repurchase_rate: float = 30.0
    size_sample_copies: int = 40


DEFAULT = WarehouseConfig()
