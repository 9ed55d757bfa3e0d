"""Source schemas of the operational tables and the audit log."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_INT, _LONG, _STR, _DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
_WALL = T.TimestampNTZType()
_PRICE, _AMOUNT, _RATE = T.DecimalType(10, 2), T.DecimalType(12, 2), T.DecimalType(3, 2)

USERS = _schema(
    ("user_id", _LONG), ("name", _STR), ("email", _STR), ("register_date", _DATE),
    ("city", _STR), ("province", _STR), ("status", _STR),
)
PRODUCTS = _schema(
    ("product_id", _LONG), ("product_name", _STR), ("category", _STR), ("price", _PRICE), ("stock", _INT),
)
ORDERS = _schema(
    ("order_id", _LONG), ("user_id", _LONG), ("order_date", _WALL), ("status", _STR),
    ("total_amount", _AMOUNT), ("promo_id", _INT),
)
ORDER_ITEMS = _schema(
    ("item_id", _LONG), ("order_id", _LONG), ("product_id", _LONG), ("qty", _INT), ("unit_price", _PRICE),
)
PAYMENTS = _schema(
    ("payment_id", _LONG), ("order_id", _LONG), ("method", _STR), ("pay_date", _WALL),
    ("amount", _AMOUNT), ("status", _STR),
)
STATUS_EVENTS = _schema(
    ("event_id", _LONG), ("order_id", _LONG), ("from_status", _STR), ("to_status", _STR),
    ("event_time", _WALL), ("operator_type", _STR),
)
DIM_REGION = _schema(
    ("region_id", _INT), ("province", _STR), ("city", _STR), ("district", _STR), ("region_tier", _STR),
)
DIM_PROMOTION = _schema(
    ("promo_id", _INT), ("promo_name", _STR), ("promo_type", _STR),
    ("start_date", _DATE), ("end_date", _DATE), ("discount_rate", _RATE),
)
AUDIT_LOG = _schema(
    ("run_id", _STR), ("log_id", _LONG), ("step", _STR), ("status", _STR), ("rows_processed", _LONG),
    ("duration_ms", _LONG), ("message", _STR), ("log_time", T.TimestampType()),
)

SOURCES = {
    "users": USERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "order_status_events": STATUS_EVENTS,
}

# Business key of each source table.
KEYS = {
    "users": ["user_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["item_id"],
    "payments": ["payment_id"],
    "order_status_events": ["event_id"],
}
