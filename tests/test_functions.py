"""Scalar helpers against plain Python."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow.functions import (
    channel,
    clock_hms,
    duration_minutes,
    epoch_micros,
    freight,
    hours_between,
    safe_ratio,
    status_band,
    time_bucket,
    to_business_time,
)
from strataflow.functions.timing import width_seconds
from strataflow.plans import dims

STAMPS = [
    datetime(1970, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 3, 10, 2, 30, 15, 123456),
    datetime(2024, 11, 11, 23, 59, 59, 999000), datetime(2000, 2, 29, 12, 0), datetime(1899, 1, 1, 5, 7, 9), datetime(2199, 12, 31, 6),
]


def _frame(spark, stamps=STAMPS):
    return spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")


def _reference_bucket(ts, seconds, origin):
    elapsed = (ts - origin) // timedelta(seconds=seconds)
    return origin + elapsed * timedelta(seconds=seconds)


@pytest.mark.parametrize("width", ["1 day", "1 minute", "5 minutes", "15 minutes", "7 days", "90 seconds", "1 hour"])
@pytest.mark.parametrize("origin", [datetime(1970, 1, 1), datetime(2000, 1, 3), datetime(2024, 1, 1, 0, 0, 30)])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_time_bucket_is_wall_clock_whatever_the_session_zone(spark, width, origin, zone):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        bucketed = _frame(spark).select("ts", time_bucket(width, "ts", origin).alias("b"))
        assert dict(bucketed.dtypes)["b"] == "timestamp_ntz"
        rows = bucketed.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    for row in rows:
        assert row.b == _reference_bucket(row.ts, width_seconds(width), origin), row


def test_rows_without_time_keep_a_null_bucket(spark):
    frame = spark.createDataFrame([(None,), (datetime(2024, 1, 1, 0, 7),)], "ts timestamp_ntz")
    rows = frame.groupBy(time_bucket("5 minutes", "ts").alias("b")).count().collect()
    assert {r.b: r["count"] for r in rows} == {None: 1, datetime(2024, 1, 1, 0, 5): 1}


def test_width_must_be_positive():
    with pytest.raises(ValueError):
        width_seconds("0 minutes")


def test_epoch_micros_and_differences(spark):
    rows = _frame(spark).select("ts", epoch_micros("ts").alias("m")).collect()
    assert all(row.m == (row.ts - datetime(1970, 1, 1)) // timedelta(microseconds=1) for row in rows)
    pair = spark.createDataFrame([(datetime(2024, 3, 10, 1), datetime(2024, 3, 10, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
    row = pair.select(hours_between("a", "b").alias("h"), duration_minutes("a", "b").alias("m")).first()
    assert (row.h, row.m) == (2.5, 150.0)


def test_clock_hms(spark):
    rows = spark.createDataFrame([(0,), (999,), (61_000,), (360_000_500,)], "ms long").select(clock_hms("ms").alias("t")).collect()
    assert [r.t for r in rows] == ["00:00:00", "00:00:00", "00:01:01", "100:00:00"]


def test_business_time_is_explicit(spark):
    row = spark.createDataFrame([(datetime(2024, 11, 10, 18),)], "ts timestamp_ntz").select(
        to_business_time("ts", "Asia/Shanghai").alias("t")).first()
    assert row.t == datetime(2024, 11, 11, 2)


def test_channel_freight_band_ratio(spark):
    rows = spark.range(0, 5000).select(
        "id", channel(F.col("id")).alias("c"),
        freight(F.col("id"), F.lit(Decimal("199.99")), Decimal("200")).alias("f"),
        freight(F.col("id"), F.lit(Decimal("200.00")), Decimal("200")).alias("free"),
    ).collect()
    names = ["miniapp"] * 2 + ["web"] * 3 + ["app"] * 5
    assert all(r.c == names[r.id % 10] and Decimal(8) <= r.f < Decimal(15) and r.free == 0 for r in rows)
    assert len({r.f for r in rows}) == 700
    steps = ((0, "red"), (30, "yellow"), (50, "green"))
    bands = spark.createDataFrame([(-1.0,), (0.0,), (30.0,), (49.9,), (50.0,), (None,)], "v double").select(
        status_band(F.col("v"), steps).alias("b")).collect()
    assert [r.b for r in bands] == [None, "red", "yellow", "yellow", "green", None]
    assert spark.range(1).select(safe_ratio(F.lit(1), F.lit(0)).alias("r")).first().r is None


def test_calendar_matches_python(spark):
    rows = dims.calendar(spark, "2023-01-01", "2025-12-31").collect()
    assert len(rows) == 1096
    seasons = {1: "winter", 2: "winter", 12: "winter", 3: "spring", 4: "spring", 5: "spring",
               6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn"}
    for r in rows:
        d: date = r.date_key
        sunday_first = d.isoweekday() % 7 + 1
        assert (r.year, r.month, r.day_of_month, r.week, r.day_of_week) == (d.year, d.month, d.day, d.isocalendar().week, sunday_first)
        assert r.is_weekend == (d.isoweekday() > 5) and r.season == seasons[d.month] and r.quarter == (d.month + 2) // 3


def test_literal_dimensions(spark):
    assert dims.dim_region(spark).count() == 10
    rates = {r.promo_id: r.discount_rate for r in dims.dim_promotion(spark).collect()}
    assert rates == {1: Decimal("0.10"), 2: Decimal("0.25"), 3: Decimal("0.15")}
