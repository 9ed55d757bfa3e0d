"""What keeps a task's share, the rows shuffled and the number of batches from growing with the tables."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import Decimal
import os
import random
import time

import pytest
from conftest import money
from pyspark.sql import functions as F

from strataflow.catalog import QUERIES, changes, storage
from strataflow.catalog.canon import Canon
from strataflow.operators.intervals import interval_join
from strataflow.operators.ordered import ordinals
from strataflow.plans import warehouse
from strataflow.session import coarsely, finely, scratch_path
from strataflow.sinks import dedupe_latest, dedupe_stored
from strataflow.sources import streams
from strataflow.streaming.event_time import emitted, store_batches


@pytest.fixture
def fine(spark):
    finely(spark)
    yield spark
    coarsely(spark)


def test_large_shuffles_begin_in_small_parts(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    finely(spark)
    assert int(spark.conf.get(name)) >= 400 and spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    coarsely(spark)
    assert spark.conf.get(name, None) is None


def test_a_task_holds_a_bounded_share_of_the_groups(fine):
    """Groups that all differ, shuffled as more than one share: no task has them all."""
    rows = fine.range(0, 4_000_000, 1, 2).select(F.xxhash64("id").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(fine, "groups")
    rows.write.parquet(path)
    sizes = [r["count"] for r in fine.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 4_000_000 and max(sizes) < 2_500_000


@pytest.mark.parametrize("pieces", [None, 1, 7])
def test_numbers_alone_take_one_shuffle_of_the_rows(fine, pieces):
    rows = fine.createDataFrame([(n * 7 % 50, n % 3) for n in range(400)] + [(None, 1)] * 3, "a int, b int")
    numbered = ordinals(rows, ["a", "b"], pieces=pieces)
    assert "row_number" not in numbered._jdf.queryExecution().executedPlan().toString()
    got = [(r.a, r.b) for r in sorted(numbered.collect(), key=lambda r: r.row_no)]
    assert got == sorted(((r.a, r.b) for r in rows.collect()), key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
    assert sorted(r.row_no for r in numbered.collect()) == list(range(1, 404))


def test_only_rows_of_repeated_keys_are_merged(spark):
    once = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    assert dedupe_stored(once, ["k"]) is once
    twice = once.unionByName(spark.createDataFrame([(1, "z"), (1, "a"), (None, "d"), (2, "b")], once.schema))
    want = Counter(map(tuple, dedupe_latest(twice, ["k"]).collect()))
    assert Counter(map(tuple, dedupe_stored(twice, ["k"]).collect())) == want == Counter([(1, "z"), (2, "b"), (None, "d")])


def test_buckets_follow_the_lines(spark, shop, monkeypatch):
    region = spark.createDataFrame([(1, "北京市", "北京", "d", "T1")], "region_id int, province string, city string, district string, region_tier string")
    promotion = spark.createDataFrame([(2, Decimal("0.25"))], "promo_id int, discount_rate decimal(3,2)")
    house = warehouse.build(spark, shop, scratch_path(spark, "bucket-house"), region, promotion, verify=False)
    made = []
    monkeypatch.setattr(warehouse, "BUCKET_ROWS", 2, raising=False)
    monkeypatch.setattr(warehouse, "save_bucketed", lambda df, table, key, buckets, *rest: made.append(buckets))
    warehouse.bucket_facts(house, 2, "sized_")
    assert made == [3, 3]


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for _, _, names in os.walk(folder.getPath()) for f in names if f.startswith("shuffle_")}


def test_a_build_leaves_no_shuffle_files(spark, shop):
    region = spark.createDataFrame([(1, "北京市", "北京", "d", "T1")], "region_id int, province string, city string, district string, region_tier string")
    promotion = spark.createDataFrame([(2, Decimal("0.25"))], "promo_id int, discount_rate decimal(3,2)")
    before = _shuffle_files(spark)
    house = warehouse.build(spark, shop, scratch_path(spark, "tidy-house"), region, promotion, verify=False)
    tables = warehouse.bucket_facts(house, 2, "tidy_")
    coarsely(spark)
    end = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert house.read("dwd", "order_fact").count() == spark.table(tables["order_fact"]).count() == 5
    # Outside, a frame may run twice and finds its shuffle files.
    rows = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(rows.collect()) == sorted(rows.collect()) and _shuffle_files(spark) - before


def test_an_arriving_lot_of_many_files_is_one_batch(spark, sf_dir):
    held = changes.Maintained(Canon(finely(spark), sf_dir))
    coarsely(spark)
    arriving = held.root.removesuffix("/dws") + "/arriving"
    assert len(spark.read.parquet(arriving).inputFiles()) > changes.BATCHES
    assert sorted(r.batch_no for r in changes.applied(spark, held.feed).collect()) == [-1, 0, 1]


def test_lots_are_batches_however_many_files_they_have(spark, monkeypatch):
    monkeypatch.setattr(streams, "LOT_ROWS", 10)
    lots = [spark.range(n).select("id", F.lit(k).alias("lot")) for k, n in enumerate((35, 3, 0, 40))]
    stream, path = streams.arriving_in_lots(spark, lots, scratch_path(spark, "lots")), scratch_path(spark, "lot-batches")
    store_batches(stream, path, scratch_path(spark, "lot-checkpoint"))
    by_batch = spark.read.option("basePath", path).parquet(f"{path}/batch_no=*").groupBy("batch_no", "lot").count().collect()
    assert {(r.batch_no, r.lot, r["count"]) for r in by_batch} == {(0, 0, 35), (1, 1, 3), (3, 3, 40)}
    assert emitted(spark, path).count() == 78


def test_totals_of_intervals_equal_the_pairs(spark):
    rng, day = random.Random(5), datetime(1969, 12, 30)
    when = lambda: day + timedelta(minutes=rng.randrange(4000))
    points = [(rng.choice([when(), day]), None if rng.random() < 0.2 else money(f"{rng.randrange(500)}.25")) for _ in range(150)] + [(None, money("9.00"))]
    spans = [(n, rng.choice([when(), when(), when(), None]), rng.choice([when(), when(), when(), None])) for n in range(120)] + [(1, day, day), (2, None, None), (2, None, None)]
    ps, ws = spark.createDataFrame(points, "ts timestamp_ntz, amount decimal(12,2)"), spark.createDataFrame(spans, "w int, opens timestamp_ntz, closes timestamp_ntz")
    want = []
    for w, opens, closes in spans:
        if opens is not None and closes is not None and opens >= closes:
            continue
        inside = [a for t, a in points if t is not None and (opens is None or t >= opens) and (closes is None or t < closes)]
        if inside:
            known = [a for a in inside if a is not None]
            want.append((w, opens, closes, len(inside), sum(known) if known else None))
    got = interval_join(ps, "ts", ws, "opens", "closes", totals={"n": None, "total": "amount"})
    assert Counter(map(tuple, got.collect())) == Counter(want)
    pairs = interval_join(ps, "ts", ws, "opens", "closes").groupBy("w", "opens", "closes").agg(F.count("*"), F.sum("amount")).collect()
    sizes = defaultdict(int)
    for row in want:
        sizes[row[:3]] += row[3]
    assert {tuple(r)[:3]: r[3] for r in pairs} == sizes
    assert interval_join(ps.limit(0), "ts", ws, "opens", "closes", totals={"n": None}).count() == 0
    with pytest.raises(ValueError):
        interval_join(ps, "ts", ws, "opens", "closes", "left", totals={"n": None})


def test_the_orders_are_sorted_not_their_copies(spark, sf_dir, monkeypatch):
    plans, real = [], storage.load_verified

    def noted(df, path, *args, **options):
        plans.append((df._jdf.queryExecution().optimizedPlan().toString(), options))
        return real(df, path, *args, **options)

    monkeypatch.setattr(storage, "load_verified", noted)
    row = QUERIES["layout_saving"](spark, sf_dir).first()
    coarsely(spark)
    plan, options = plans[0]
    assert "sort" not in options and plan.index("Generate") < plan.index("Sort")
    assert row.saves_half and row.compact_rows == row.plain_rows


def test_the_text_copies_stand_there_part_by_part(spark, sf_dir, monkeypatch):
    """All copies are counted and measured, but only the last part of them is left."""
    texts, real = [], storage.scratch_path

    def noted(spark, label):
        path = real(spark, label)
        texts.extend([path] if label == "plain" else [])
        return path

    monkeypatch.setattr(storage, "scratch_path", noted)
    whole = QUERIES["layout_saving"](spark, sf_dir)
    want, whole_bytes = whole.collect(), storage.reports.table_bytes(spark, texts[0]).first().bytes
    monkeypatch.setattr(storage, "TEXT_ROWS", 25_000, raising=False)
    measured, savings = [], storage.reports.layout_savings
    monkeypatch.setattr(storage.reports, "layout_savings", lambda *args: measured.append(savings(*args)) or measured[-1])
    got = QUERIES["layout_saving"](spark, sf_dir).collect()
    coarsely(spark)
    assert got == want and got[0].plain_rows == 40 * Canon(spark, sf_dir).orders().count()
    assert len(texts) == 1 + -(-got[0].plain_rows // 25_000) > 3
    assert [os.path.exists(path) for path in texts[1:]] == [False] * (len(texts) - 2) + [True]
    assert measured[0].first().plain_bytes == whole_bytes
    assert spark.read.text(texts[-1]).count() < got[0].plain_rows / 2


def test_lookup_files_follow_the_rows(spark, sf_dir, monkeypatch):
    files, real = [], storage.load_verified

    def noted(df, path, *args, **options):
        loaded = real(df, path, *args, **options)
        files.append(len(spark.read.parquet(path).inputFiles()))
        return loaded

    monkeypatch.setattr(storage, "load_verified", noted)
    monkeypatch.setattr(storage, "LOOKUP_ROWS", 150, raising=False)
    rows = QUERIES["point_lookup"](spark, sf_dir).collect()
    coarsely(spark)
    assert files[0] > 4 and files[1] > 4 and all(r.reads_part for r in rows)
