from __future__ import annotations

import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow import schemas  # noqa: E402
from strataflow.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text)


@pytest.fixture(scope="session")
def shop(spark):
    """A hand-written shop: every state, a missing place, a promotion, edge times and an order without payment."""
    users = [
        (1, "Ann", "a@x", date(2024, 1, 1), "北京", "北京市", "active"),
        (2, "Bob", "b@x", date(2024, 1, 2), "广州", "广东省", "active"),
        (3, "Cai", "c@x", date(2024, 1, 3), "广州", "四川省", None),
    ]
    products = [
        (10, "pen", "电子", money("10.00"), 5), (11, "cup", "家居", money("99.99"), None), (12, "hat", "服装", money("0.01"), 1),
    ]
    orders = [
        (100, 1, at("2024-11-11T00:00:00"), "completed", money("75.00"), 2),
        (101, 1, at("2024-11-11T23:59:59.999"), "paid", money("199.98"), None),
        (102, 2, at("2024-11-12T00:00:00"), "shipped", money("85.00"), 3),
        (103, 3, at("2024-10-31T12:00:30"), "cancelled", money("300.00"), None),
        (104, 2, at("2024-10-31T12:00:59"), "paid", money("0.02"), None),
    ]
    items = [
        (1, 100, 10, 10, money("10.00")), (2, 101, 11, 2, money("99.99")), (3, 102, 10, 10, money("10.00")),
        (4, 103, 10, 30, money("10.00")), (5, 104, 12, 2, money("0.01")), (6, 100, 12, 1, money("0.01")),
    ]
    payments = [
        (1, 100, "card", at("2024-11-11T00:05:00"), money("75.00"), "completed"),
        (2, 101, "card", at("2024-11-12T00:01:00"), money("199.98"), None),
        (3, 102, "card", at("2024-11-12T00:03:00"), money("85.00"), "completed"),
        (4, 102, "card", at("2024-11-12T00:02:00"), money("85.00"), "completed"),
    ]
    events = [
        (1, 100, None, "created", at("2024-11-11T00:00:00"), "user"),
        (2, 100, "created", "paid", at("2024-11-11T00:05:00"), "user"),
        (3, 100, "paid", "shipped", at("2024-11-12T00:05:00"), None),
        (4, 100, "shipped", "completed", at("2024-11-14T00:05:00"), "system"),
        (5, 103, None, "created", at("2024-10-31T12:00:30"), "user"),
        (6, 103, "created", "cancelled", at("2024-10-31T12:10:30"), "user"),
        (7, 101, None, "created", at("2024-11-11T23:59:59.999"), "user"),
        (8, 101, "created", "paid", at("2024-11-12T00:01:00"), "user"),
    ]
    rows = dict(zip(schemas.SOURCES, (users, products, orders, items, payments, events)))
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in schemas.SOURCES.items()}
