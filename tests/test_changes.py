"""A change feed in any order, repeated, replayed and broken off, and aggregates that follow it."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from conftest import at, money
from pyspark.sql import functions as F

from strataflow.plans import aggregates, facts
from strataflow.plans import incremental as inc
from strataflow.session import scratch_path
from strataflow.sinks import changes, with_month
from strataflow.sinks.changes import Feed, applied, apply_changes, change_stream, current, forget, images
from strataflow.sources import read_file_stream

RECORD = "id long, part int, value string, op string, seq long"
# Inserted, changed and moved; deleted and placed again; deleted before its insert comes; only ever deleted; no partition; no key.
HISTORY = [
    (1, 10, "a", "I", 1), (1, 10, "b", "U", 2), (1, 20, "c", "U", 3), (2, 10, "a", "I", 1), (2, None, None, "D", 2), (2, 30, "d", "I", 3),
    (3, 20, "a", "I", 1), (3, None, None, "D", 5), (3, 20, "old", "U", 4), (4, None, None, "D", 1), (5, None, "e", "I", 1), (None, 10, "f", "I", 1),
    (None, 10, "g", "U", 2), (6, 20, "h", "I", 7),
]
FINAL = Counter([(1, 20, "c"), (2, 30, "d"), (5, None, "e"), (None, 10, "g"), (6, 20, "h")])


def feed(spark, **options):
    return Feed(scratch_path(spark, "feed"), ("id",), "part", **options)


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def held(spark, f):
    return Counter((r.id, r.part, r.value) for r in current(spark, f).collect())


def test_one_batch_in_order(spark):
    f = feed(spark)
    assert apply_changes(spark, f, records(spark, HISTORY), 0) and held(spark, f) == FINAL
    log = applied(spark, f).first()
    assert (log.records, log.inserted, log.updated, log.deleted) == (len(HISTORY), 5, 0, 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_and_repeated_batches_end_alike(spark, seed):
    rng, f = random.Random(seed), feed(spark)
    rows = HISTORY + rng.sample(HISTORY, 6)
    rng.shuffle(rows)
    for number in range(3):
        apply_changes(spark, f, records(spark, rows[number::3]), number)
    assert held(spark, f) == FINAL
    log = applied(spark, f).agg(F.sum("inserted") - F.sum("deleted"), F.sum("records")).first()
    assert log[0] == 5 and log[1] == len(rows)


def test_a_replay_changes_nothing(spark):
    f = feed(spark)
    apply_changes(spark, f, records(spark, HISTORY[:7]), 0)
    apply_changes(spark, f, records(spark, HISTORY[7:]), 1)
    files = current(spark, f).inputFiles()
    assert not apply_changes(spark, f, records(spark, HISTORY[:7]), 0)
    # The same records as a batch of another number are older than what is stored: no image, no partition.
    assert apply_changes(spark, f, records(spark, HISTORY[:7]), 2) and images(spark, f, 2).count() == 0
    assert sorted(current(spark, f).inputFiles()) == sorted(files) and held(spark, f) == FINAL


def test_deletes_of_unknown_keys_are_harmless(spark):
    f = feed(spark)
    apply_changes(spark, f, records(spark, [(1, 10, "a", "I", 1)]), 0)
    apply_changes(spark, f, records(spark, [(9, 10, None, "D", 1), (1, 10, None, "D", 0)]), 1)
    assert held(spark, f) == Counter([(1, 10, "a")])
    apply_changes(spark, f, records(spark, [(9, 10, "late", "I", 0), (9, 10, "new", "I", 2)]), 2)
    assert held(spark, f) == Counter([(1, 10, "a"), (9, 10, "new")])


@pytest.mark.parametrize("broken", ["before the partitions", "after the partitions"])
def test_a_broken_batch_is_taken_up_again(spark, monkeypatch, broken):
    f, real = feed(spark), changes.replace_partitions
    apply_changes(spark, f, records(spark, HISTORY[:4]), 0)

    def failing(*args):
        if broken == "after the partitions":
            real(*args)
        raise OSError("lost")

    monkeypatch.setattr(changes, "replace_partitions", failing)
    with pytest.raises(OSError):
        apply_changes(spark, f, records(spark, HISTORY[4:]), 1)
    monkeypatch.setattr(changes, "replace_partitions", real)
    taken = Counter((r.id, r.value, r._sign) for r in images(spark, f, 1).collect())
    assert apply_changes(spark, f, records(spark, HISTORY[4:]), 1) and held(spark, f) == FINAL
    assert Counter((r.id, r.value, r._sign) for r in images(spark, f, 1).collect()) == taken


def test_only_touched_partitions_are_read_and_written(spark):
    f = feed(spark, settled=True)
    apply_changes(spark, f, records(spark, [(n, n % 5, "a", "I", 1) for n in range(50)]), 0)
    before = {(r.part, r.file) for r in spark.read.parquet(f.rows).select("part", F.col("_metadata.file_path").alias("file")).collect()}
    apply_changes(spark, f, records(spark, [(3, 3, "b", "U", 2), (8, 3, None, "D", 2)]), 1)
    after = {(r.part, r.file) for r in spark.read.parquet(f.rows).select("part", F.col("_metadata.file_path").alias("file")).collect()}
    assert {p for p, _ in after ^ before} == {3} and current(spark, f).count() == 49
    plan = spark.read.parquet(f.rows).where(changes.in_partitions("part", [3, None]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((part" in plan or "PartitionFilters: [(part" in plan


def test_forgotten_tombstones_and_images(spark):
    f = feed(spark)
    apply_changes(spark, f, records(spark, HISTORY), 0)
    forget(spark, f, 3, 0)
    rows = spark.read.parquet(f.rows)
    assert held(spark, f) == FINAL and {r.id for r in rows.where("_gone").collect()} == {3}


def test_a_stream_of_changes(spark):
    f, source = feed(spark), scratch_path(spark, "source")
    for number in range(3):
        records(spark, HISTORY[number::3]).coalesce(1).write.mode("append").parquet(source)
    seen = []
    stream = read_file_stream(spark, source, records(spark, []).schema, max_files=1)
    change_stream(stream, f, scratch_path(spark, "cp"), lambda s, number: seen.append(number))
    assert held(spark, f) == FINAL and seen == [0, 1, 2]


# Aggregates

ORDER = "order_id long, user_id long, order_date timestamp_ntz, status string, total_amount decimal(12,2), promo_id int, op string, seq long"


def orders(spark, rows):
    return with_month(spark.createDataFrame([(i, u, None if t is None else at(t), s, None if a is None else money(a), None, op, n) for i, u, t, s, a, op, n in rows], ORDER), "order_date")


LOADS = [
    [(1, 7, "2024-01-05T10:00:00", "paid", "10.00", "I", 1), (2, 7, "2024-01-05T11:00:00", "paid", None, "I", 1), (3, 8, "2024-02-01T00:00:00", "shipped", "5.50", "I", 1),
     (4, 9, "2024-01-06T00:00:00", "cancelled", "99.00", "I", 1), (5, None, "2024-03-01T00:00:00", "paid", "1.00", "I", 1)],
    [(1, 7, None, None, None, "D", 2), (3, 7, "2024-02-02T00:00:00", "paid", "6.00", "U", 2), (4, 9, "2024-01-06T00:00:00", "paid", "98.00", "U", 2), (77, 1, None, None, None, "D", 9)],
    [(5, None, None, None, None, "D", 2), (2, 7, "2024-01-05T11:00:00", "paid", "3.00", "U", 2), (1, 7, "2024-01-05T10:00:00", "paid", "10.00", "I", 1)],
]
ITEMS = "item_id long, order_id long, product_id long, qty int, unit_price decimal(10,2)"


def test_aggregates_follow_inserts_updates_and_deletes(spark, monkeypatch):
    f, root = Feed(scratch_path(spark, "orders"), ("order_id",), "ym"), scratch_path(spark, "dws")
    items = spark.createDataFrame([(10 * o + k, o, k, o + k, money("2.50")) for o in range(1, 6) for k in range(2)], ITEMS)
    promotions = spark.createDataFrame([(1, Decimal("0.10"))], "promo_id int, discount_rate decimal(3,2)")
    specs = inc.daily_gmv(), inc.user_purchase_stats(), inc.product_daily_sales()
    real = inc.replace_partitions

    def follow(number):
        changed = images(spark, f, number)
        signed = inc.signed_orders(changed), inc.signed_orders(changed), inc.signed_lines(changed, items, promotions)
        return [inc.refresh_changed(spark, root, spec, rows, number) for spec, rows in zip(specs, signed)]

    for number, rows in enumerate(LOADS):
        apply_changes(spark, f, orders(spark, rows), number)
        if number == 1:  # broken off after the first aggregate
            calls = []

            def failing(*args):
                real(*args)
                calls.append(args)
                if len(calls) == 2:
                    raise OSError("lost")

            monkeypatch.setattr(inc, "replace_partitions", failing)
            with pytest.raises(OSError):
                follow(number)
            monkeypatch.setattr(inc, "replace_partitions", real)
        follow(number)
        assert follow(number) == [0, 0, 0]
        now = current(spark, f).drop("ym")
        core = facts.order_core(now)
        want = aggregates.daily_gmv(core), aggregates.user_purchase_stats(core), aggregates.product_daily_sales(facts.detail_lines(items, now, promotions))
        for spec, frame in zip(specs, want):
            got = inc.stored(spark, root, spec)
            assert got.columns == frame.columns
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, frame.collect())), (number, spec.name)


def test_only_partitions_of_changed_groups_are_written(spark):
    root, spec = scratch_path(spark, "dws"), inc.daily_gmv()
    rows = [(n, 1, f"2024-{n:02d}-01T00:00:00", "paid", "1.00", "I", 1) for n in range(1, 9)]
    signed = inc.signed_orders(orders(spark, rows).drop("op", "seq").withColumn("_sign", F.lit(1)))
    assert inc.refresh_changed(spark, root, spec, signed, 0) == 8
    files = set(spark.read.parquet(f"{root}/daily_gmv").inputFiles())
    assert inc.refresh_changed(spark, root, spec, signed.where("month(order_date) = 3"), 1) == 1
    assert len(files & set(spark.read.parquet(f"{root}/daily_gmv").inputFiles())) == len(files) - 1


def test_lines_are_read_from_the_key_ranges_of_changed_orders(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = spark.range(1, 1001).select(F.col("id").alias("order_id"), F.lit(1).alias("qty"))
    changes_of = spark.createDataFrame([(5,), (17,), (905,)], "order_id long")
    from strataflow.sinks import load_verified, with_key_range
    load_verified(with_key_range(rows, "order_id", 100), path, "key_range")
    found = inc.items_of(spark.read.parquet(path), changes_of, "key_range", 100)
    assert found.count() == 200 and "key_range" not in found.columns
