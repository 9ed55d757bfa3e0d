"""Distinct counts by bitmaps and sketches, selection of ranks, tiles, and interval joins against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators import selection
from strataflow.operators.intervals import LEVELS, interval_bins, interval_join
from strataflow.operators.selection import percentiles, select_ranks, tile_cuts, with_tile
from strataflow.plans import distinct

LONG = (1 << 63) - 1


def days_of(spark, rows):
    return spark.createDataFrame(rows, "day date, k long, g string").repartition(3)


def test_bitmaps_count_any_long(spark):
    keys = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, LONG, -LONG, -LONG - 1, None]
    rows = [(date(2024, 1, n % 3 + 1), k, "ab"[n % 2]) for n, k in enumerate(keys * 3)]
    stored = distinct.stored_bitmaps(days_of(spark, rows), ["day", "g"], "k", "bits")
    want = defaultdict(set)
    for d, k, g in rows:
        want[d, g].add(k)
    got = {(r.day, r.g): r.n for r in distinct.distinct_counts(stored, ["day", "g"], "n").collect()}
    assert got == {at: len(ks - {None}) for at, ks in want.items() if ks - {None}}
    assert distinct.distinct_counts(stored, [], "n").first().n == 11
    # Uniting again, as a replay does, changes nothing.
    assert distinct.distinct_counts(stored.unionByName(stored), [], "n").first().n == 11


def test_ranges_of_days(spark):
    rng = random.Random(1)
    rows = [(date(2024, 1, 1) + timedelta(rng.randrange(40)), rng.randrange(90_000), "x") for _ in range(600)]
    rows = [r for r in rows if r[0] != date(2024, 1, 9)]
    ranges = [(1, date(2023, 1, 1), date(2025, 1, 1)), (2, date(2024, 1, 9), date(2024, 1, 9)), (3, date(2024, 1, 5), date(2024, 1, 8)), (4, date(2024, 2, 1), date(2024, 1, 1)),
              (5, date(2030, 1, 1), date(2030, 2, 1)), (None, date(2024, 1, 1), date(2024, 1, 20))]
    stored = distinct.bitmaps(days_of(spark, rows), ["day"], "k")
    got = distinct.distinct_in_ranges(stored, "day", spark.createDataFrame(ranges, "id int, first_day date, last_day date"), "n")
    assert {r.id: r.n for r in got.collect()} == {i: len({k for d, k, _ in rows if a <= d <= b}) for i, a, b in ranges}


def test_dense_numbers_keep_old_ones(spark):
    first = spark.createDataFrame([("b",), ("zz",), (None,), ("b",)], "name string")
    known = distinct.dense_numbers(first, "name")
    assert {r.name: r.key_no for r in known.collect()} == {"b": 1, "zz": 2}
    more = distinct.dense_numbers(first.unionByName(spark.createDataFrame([("a",), ("c",)], "name string")), "name", known)
    assert {r.name: r.key_no for r in more.collect()} == {"b": 1, "zz": 2, "a": 3, "c": 4}
    spread = spark.range(5000).select((F.col("id") * 7_000_000_003).alias("k"), F.lit(date(2024, 1, 1)).alias("day"))
    numbered = spread.join(distinct.dense_numbers(spread, "k"), "k")
    assert distinct.bitmaps(numbered, ["day"], "key_no").count() == 1 and distinct.bitmaps(spread, ["day"], "k").count() == 5000


@pytest.mark.parametrize("size", [0, 1, 100, 60_000])
def test_sketches_stay_within_their_bound(spark, size):
    rows = spark.range(size).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("day"))
    whole = distinct.estimates(distinct.sketches(rows, [], "k"), "n").first().n
    days = distinct.sketches(rows.unionByName(rows.where("k % 2 = 0")), ["day"], "k")
    united = distinct.estimates(distinct.merged_sketches(days), "n").first().n if size else 0
    for estimate in (whole or 0, united):
        assert abs(estimate - size) <= size * distinct.ERROR_BOUND


# Selection

def ranked(rows, rank):
    held = 0
    for v, w in sorted(Counter({v: sum(w for x, w in rows if x == v) for v, _ in rows}).items()):
        if held + w >= rank:
            return v, held, w
        held += w
    return None


KINDS = {
    "long": [0, -1, LONG, -LONG - 1, 5, 5, 5, 1 << 60, (1 << 60) + 1], "decimal(22,2)": [Decimal("1.10"), Decimal("-3.33"), Decimal("99999999999999999999.99"), Decimal("0.00"), Decimal("1.10")],
    "double": [0.0, -0.0, 1e-320, 5e-324, -1e308, 1e308, 3.5, -3.5, float("inf"), float("-inf"), 2.0 ** -1000], "date": [date(1900, 1, 1), date(2024, 2, 29), date(2024, 2, 29), date(1970, 1, 1)],
    "timestamp_ntz": [datetime(2024, 3, 10, 2, 30), datetime(1905, 1, 1, 0, 0, 0, 1), datetime(2024, 3, 10, 2, 30, 0, 1)], "tinyint": [-128, 127, 0, 3, 3]}


@pytest.mark.parametrize("kind", KINDS)
def test_ranks_of_every_type(spark, kind):
    values = KINDS[kind] + [None]
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T._parse_datatype_string(kind))]))
    rows = [(v, 1) for v in values if v is not None]
    got = select_ranks(df, "v", list(range(1, len(rows) + 2)), bins=16)
    assert [g and (g.value, g.below, g.equal) for g in got] == [ranked(rows, r) for r in range(1, len(rows) + 2)]


def test_weights_and_passes(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), rng.choice([0, 1, 3, None, -2, 10])) for _ in range(400)]
    df = spark.createDataFrame(rows, "v long, w long").repartition(3)
    real = [(v, w) for v, w in rows if w and w > 0]
    total, passes = sum(w for _, w in real), []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: passes.append(1) or collect(self))
    got = select_ranks(df, "v", [1, total // 2, total, total + 1], F.col("w"))
    assert [g and (g.value, g.below, g.equal) for g in got] == [ranked(real, r) for r in (1, total // 2, total, total + 1)] and len(passes) <= 8
    assert percentiles(df, "v", [50, 100], weight=F.col("w")) == [ranked(real, -(-total // 2))[0], max(v for v, _ in real)]


def test_nothing_to_select(spark):
    none = spark.createDataFrame([(None, 1)], "v long, t long")
    assert select_ranks(none, "v", [1]) == [None] and percentiles(none, "v", [50]) == [None] and percentiles(none.limit(0), "v", [50]) == [None]
    with pytest.raises(TypeError):
        select_ranks(spark.createDataFrame([("a",)], "v string"), "v", [1])


def tiles_by_hand(rows, tiles):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]) if r[0] is not None else (False, 0, r[1]))
    size, extra, out, at = len(rows) // tiles, len(rows) % tiles, {}, 0
    for tile in range(1, tiles + 1):
        for row in order[at:at + size + (tile <= extra)]:
            out[row[1]] = tile
        at += size + (tile <= extra)
    return out


@pytest.mark.parametrize("values", [
    [5] * 20, list(range(17)), [None] * 9 + [1, 2], [1] * 10 + [2] * 3 + [None] * 4, [7, 7, 7, 8], [1], [], [3.5, 3.5, -1.0, None, 3.5]])
@pytest.mark.parametrize("tiles", [1, 3, 5])
def test_tiles_equal_ntile(spark, values, tiles):
    rng = random.Random(3)
    ids = rng.sample(range(-1000, 1000), len(values))
    rows = list(zip(values, ids))
    kind = "double" if any(isinstance(v, float) for v in values) else "decimal(10,2)"
    data = [(Decimal(v) if kind.startswith("dec") and v is not None else v, i) for v, i in rows]
    df = spark.createDataFrame(data, f"v {kind}, id long").repartition(2)
    assert {r.id: r.tile for r in with_tile(df, "v", "id", tiles).collect()} == tiles_by_hand(rows, tiles)


def test_no_window_and_no_sort(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("v"), "id")
    plan = with_tile(df, "v", "id", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Exchange" not in plan and len(tile_cuts(df, "v", "id", 4)) == 3


# Intervals

T0 = datetime(2024, 1, 1)


def met_by_hand(points, spans):
    return Counter((p, s) for p, at in points for s, a, b in spans if at is not None and (a is None or b is None or a < b) and (a is None or a <= at) and (b is None or at < b))


@pytest.fixture(scope="module")
def times():
    rng = random.Random(4)
    points = [(n, T0 + timedelta(seconds=rng.randrange(10 ** 7), microseconds=rng.randrange(3))) for n in range(150)] + [(900, None), (901, T0), (902, datetime(1931, 1, 1)), (903, T0), (903, T0)]
    spans = []
    for n in range(120):
        a = T0 + timedelta(seconds=rng.randrange(-10 ** 6, 10 ** 7))
        spans.append((n, a, a + timedelta(seconds=4 ** rng.randrange(13) * rng.random())))
    edge = points[5][1]
    spans += [(500, None, edge), (501, edge, None), (502, None, None), (503, edge, edge), (504, edge, edge - timedelta(days=1)), (505, edge, edge + timedelta(microseconds=1)),
              (506, datetime(1900, 1, 1), datetime(2200, 1, 1)), (507, datetime(2300, 1, 1), None), (None, edge, edge + timedelta(days=3)), (508, datetime(1931, 1, 1), datetime(1931, 1, 1, 0, 0, 4))]
    return points, spans


def frames(spark, points, spans):
    return (spark.createDataFrame(points, "p int, at timestamp_ntz").repartition(3), spark.createDataFrame(spans, "s int, a timestamp_ntz, b timestamp_ntz").repartition(2))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_equals_the_range_condition(spark, times, how):
    points, spans = times
    df, intervals = frames(spark, points, spans)
    got = Counter((r.p, r.s) for r in interval_join(df, "at", intervals, "a", "b", how).collect())
    want = met_by_hand(points, spans)
    if how == "left":
        held = {p for p, _ in want}
        want += Counter((p, None) for p, _ in points if p not in held)
    assert got == want


def test_interval_join_of_nothing(spark, times):
    points, spans = times
    df, intervals = frames(spark, points, spans)
    assert interval_join(df.limit(0), "at", intervals, "a", "b").count() == 0 and interval_join(df, "at", intervals.limit(0), "a", "b").count() == 0
    assert interval_join(df, "at", intervals.limit(0), "a", "b", "left").count() == len(points)
    with pytest.raises(ValueError):
        interval_join(df, "at", intervals.withColumnRenamed("s", "p"), "a", "b")


def test_no_nested_loop_and_two_bins_at_most(spark, times):
    df, intervals = frames(spark, *times)
    plan = interval_join(df, "at", intervals, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    low, high = F.lit(-2 * 10 ** 15).cast("long"), F.lit(9 * 10 ** 15).cast("long")
    bins = interval_bins(intervals, "a", "b", low, high).groupBy("s", "a", "b").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert bins[0] <= 2 and LEVELS == 20 and selection.BINS == 1024
