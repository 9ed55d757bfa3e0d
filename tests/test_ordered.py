"""Chunked order-dependent operators against plain windows, on hot keys, ties and awkward cuts."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.operators.ordered import lagged, moving_average, ordinals, running_total


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows belongs to one key, another third to one minute; times tie; one key is NULL."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(1500):
        key = 1 if i % 3 == 0 else rng.choice([2, 3, 4, None])
        ts = start + (timedelta(minutes=77) if i % 3 == 1 else timedelta(seconds=rng.randrange(200_000)))
        amount = None if i % 50 == 0 else Decimal(rng.randrange(-500, 5000)) / 100
        data.append((i, key, ts, amount))
    return spark.createDataFrame(data, "id long, key int, ts timestamp_ntz, amount decimal(10,2)").cache()


PIECES = [None, 1, 7, 40]


def _same(left, right):
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, right.select(*left.columns).collect()), key=repr)


@pytest.mark.parametrize("pieces", PIECES)
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_running_total(rows, keys, pieces):
    got = running_total(rows, ["ts", "id"], {"amount": "total"}, keys=keys, pieces=pieces)
    frame = Window.partitionBy(*keys).orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    _same(got, rows.withColumn("total", F.sum("amount").over(frame).cast(got.schema["total"].dataType)))


@pytest.mark.parametrize("pieces", PIECES)
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_ordinals(rows, keys, pieces):
    got = ordinals(rows, ["ts", "id"], keys=keys, rank=True, ntiles=7, pieces=pieces)
    w = Window.partitionBy(*keys)
    want = (
        rows.withColumn("row_no", F.row_number().over(w.orderBy("ts", "id")).cast("long"))
        .withColumn("rank_no", F.rank().over(w.orderBy("ts")).cast("long"))
        .withColumn("tile", F.ntile(7).over(w.orderBy("ts", "id")))
    )
    _same(got, want)


def test_ntile_with_fewer_rows_than_tiles(rows):
    few = rows.where("id < 4")
    got = ordinals(few, ["ts", "id"], ntiles=7, pieces=3)
    _same(got.select("id", "tile"), few.select("id", F.ntile(7).over(Window.orderBy("ts", "id")).alias("tile")))


@pytest.mark.parametrize("pieces", PIECES)
@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("size", [2, 10])
def test_moving_average(rows, keys, size, pieces):
    got = moving_average(rows, ["ts", "id"], "amount", size, keys=keys, pieces=pieces)
    frame = Window.partitionBy(*keys).orderBy("ts", "id").rowsBetween(-(size - 1), 0)
    mean = F.try_divide(F.sum("amount").over(frame).cast("double"), F.count("amount").over(frame).cast("double"))
    _same(got, rows.withColumn("moving_avg", mean))


@pytest.mark.parametrize("pieces", PIECES)
@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("offset", [1, 3])
def test_lagged(rows, keys, offset, pieces):
    got = lagged(rows, ["ts", "id"], "id", keys=keys, offset=offset, pieces=pieces)
    _same(got, rows.withColumn("previous", F.lag("id", offset).over(Window.partitionBy(*keys).orderBy("ts", "id"))))


@pytest.mark.parametrize("pieces", [2, 40])
def test_frame_longer_than_most_chunks(rows, pieces):
    got = moving_average(rows, ["ts", "id"], "amount", 1000, pieces=pieces)
    frame = Window.orderBy("ts", "id").rowsBetween(-999, 0)
    _same(got, rows.withColumn("moving_avg", F.try_divide(F.sum("amount").over(frame).cast("double"), F.count("amount").over(frame).cast("double"))))


def test_long_frame_on_a_calendar_chunk(rows):
    got = lagged(rows, ["ts", "id"], "id", offset=700, chunk=F.date_trunc("hour", "ts"))
    _same(got, rows.withColumn("previous", F.lag("id", 700).over(Window.orderBy("ts", "id"))))


def test_frame_of_one_row(rows):
    got = moving_average(rows, ["ts", "id"], "amount", 1, pieces=7)
    _same(got, rows.withColumn("moving_avg", F.col("amount").cast("double")))


def test_empty_input(rows):
    none = rows.where("id < 0")
    assert running_total(none, ["ts", "id"], {"amount": "t"}).count() == 0
    assert ordinals(none, ["ts", "id"], ntiles=3).count() == 0
    assert lagged(none, ["ts", "id"], "id").count() == 0


def test_hot_key_and_hot_time_spread_over_chunks(rows):
    """No (key, chunk) holds much more than a chunk's fair share, though a key and a minute hold a third each."""
    from strataflow.operators.ordered import _chunked

    chunked = _chunked(rows, ["ts", "id"], ["key"], 15, None)
    sizes = [r["count"] for r in chunked.groupBy("key", "_chunk").count().collect()]
    assert max(sizes) < 3 * 1500 / 15
    assert chunked.where("ts = TIMESTAMP_NTZ'2024-01-01 01:17:00'").select("_chunk").distinct().count() >= 5


def test_chunk_column_is_for_series_without_keys(rows):
    with pytest.raises(ValueError):
        running_total(rows, ["ts"], {"amount": "t"}, keys=["key"], chunk=F.to_date("ts"))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_only_the_summary_gathers(rows, keys):
    """Raw rows are windowed by (key, chunk); the one side that is gathered or broadcast is the per-chunk summary."""
    plan = running_total(rows, ["ts", "id"], {"amount": "total"}, keys=keys, pieces=7)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    single = plan.count("Exchange SinglePartition")
    assert single == (0 if keys else 1)
    if single:
        below = plan[plan.index("Exchange SinglePartition"):].splitlines()[1]
        assert "HashAggregate" in below and "_chunk" in below
