"""Running totals with carried state, sessions in chunks, loads beside the table, lookups and bucketed facts."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow.catalog.canon import Canon
from strataflow.operators import quality, reports
from strataflow.operators.ordered import preceding_max
from strataflow.plans import warehouse
from strataflow.session import scratch_path
from strataflow.sinks import load_verified, tables
from strataflow.sources import read_file_stream
from strataflow.streaming import current_rows, drain_to_table, session_stream
from strataflow.streaming.running import add_batch, drain_running, running_rows

ROWS = "ts timestamp_ntz, amount decimal(10,2)"
START = datetime(2023, 12, 30)


def frame(spark, rows):
    return spark.createDataFrame([(t, None if a is None else Decimal(a)) for t, a in rows], ROWS)


def by_hand(rows):
    minutes = {}
    for t, a in rows:
        if t is not None:
            minutes.setdefault(t.replace(second=0, microsecond=0), []).append(a)
    out, total, count = [], None, 0
    for minute in sorted(minutes):
        known = [Decimal(a) for a in minutes[minute] if a is not None]
        own = sum(known) if known else None
        total, count = (total or 0) + own if own is not None else total, count + len(minutes[minute])
        out.append((minute, own, total, len(minutes[minute]), count))
    return out


def shown(df):
    return sorted((r.bucket_time, r.minute_gmv, r.running_gmv, r.minute_order_count, r.running_order_count) for r in df.collect())


def rows_of(seed, n, days=5):
    rng = random.Random(seed)
    return [(START + timedelta(minutes=rng.randrange(1440 * days), seconds=rng.randrange(60)), rng.choice(["1.50", "2.25", "-0.75", None])) for _ in range(n)]


def test_batches_out_of_order_equal_the_whole_series(spark):
    root, rows = scratch_path(spark, "running"), rows_of(1, 120, 3) + [(START - timedelta(days=9), None), (None, "5.00")]
    for number in range(2):
        add_batch(spark, root, frame(spark, rows[number::2]), "ts", "amount", number)
    assert add_batch(spark, root, frame(spark, rows[1::2]), "ts", "amount", 1) == 0  # a replay
    assert shown(running_rows(spark, root)) == by_hand(rows)
    day = date(2024, 1, 1)
    one = running_rows(spark, root, day, day)
    assert shown(one) == [r for r in by_hand(rows) if r[0].date() == day]
    assert "PartitionFilters: [isnotnull(_part" in one._jdf.queryExecution().executedPlan().toString()


def test_a_batch_rewrites_its_own_days_only(spark):
    source, root = scratch_path(spark, "source"), scratch_path(spark, "running")
    days = [[(START + timedelta(days=d, hours=h), "1.00") for h in (1, 20)] for d in range(4)]
    for rows in (*days, [(START + timedelta(hours=2), "10.00")]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
    _, written = drain_running(read_file_stream(spark, source, frame(spark, []).schema, max_files=1), root, scratch_path(spark, "cp"), "ts", "amount")
    assert written == [1, 1, 1, 1, 1]
    assert shown(running_rows(spark, root)) == by_hand([r for d in days for r in d] + [(START + timedelta(hours=2), "10.00")])


# Sessions

def test_sessions_of_a_hot_key_are_merged_in_chunks(spark):
    """One key holds most sessions; long ones swallow many short ones across chunk borders."""
    rng = random.Random(3)
    rows = [(n, START + timedelta(seconds=rng.randrange(400_000)), 1 if n % 4 else n % 7, None) for n in range(900)]
    rows += [(1000 + n, START + timedelta(minutes=20 * n), 1, None) for n in range(100)]
    source = scratch_path(spark, "source")
    schema = "event_id long, ts timestamp_ntz, user_id long, amount decimal(10,2)"
    for number in range(3):
        spark.createDataFrame(rows[number::3], schema).coalesce(1).write.mode("append").parquet(source)
    table, path = session_stream(read_file_stream(spark, source, spark.createDataFrame([], schema).schema, max_files=1), "ts", "user_id"), scratch_path(spark, "sessions")
    drain_to_table(table, path, scratch_path(spark, "cp"))
    want = set()
    for user in {r[2] for r in rows}:
        times = sorted(r[1] for r in rows if r[2] == user)
        held = [times[0]]
        for t in [*times[1:], None]:
            if t is not None and t <= held[-1] + timedelta(minutes=30):
                held.append(t)
                continue
            want.add((user, held[0], held[-1] + timedelta(minutes=30), len(held)))
            held = [t]
    assert {(r.user_id, r.session_start, r.session_end, r.n) for r in current_rows(spark, path, table).collect()} == want


@pytest.mark.parametrize("pieces", [1, 5])
def test_preceding_max_across_chunks(spark, pieces):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), n, rng.choice([None, rng.randrange(100)])) for n in range(200)]
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(3)
    got = {(r.k, r.o): r.reached for r in preceding_max(df, ["o"], "v", ["k"], pieces=pieces).collect()}
    for k, o, _ in rows:
        assert got[k, o] == max((v for kk, oo, v in rows if kk == k and oo < o and v is not None), default=None)


# Loads

def test_a_failed_load_leaves_the_old_table(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    path = scratch_path(spark, "kept")
    load_verified(spark.range(5), path)
    real = DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda self: real(self) - 1)
    with pytest.raises(RuntimeError):
        load_verified(spark.range(50), path)
    monkeypatch.setattr(DataFrame, "count", real)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        load_verified(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    beside = path.rsplit("/", 1)[0]
    names = [s.getPath().getName() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside))]
    assert not [n for n in names if n.startswith(path.rsplit("/", 1)[1]) and n != path.rsplit("/", 1)[1]]


def test_a_swap_that_fails_puts_the_old_table_back(spark):
    path = scratch_path(spark, "swapped")
    load_verified(spark.range(5), path)
    with pytest.raises(OSError):
        tables.swap(spark, f"{path}-missing", path)
    assert spark.read.parquet(path).count() == 5


def test_a_table_is_loaded_from_itself(spark):
    path = scratch_path(spark, "self")
    load_verified(spark.range(10), path)
    assert load_verified(spark.read.parquet(path).where("id > 3"), path, sort=("id",)) == 6
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [4, 5, 6, 7, 8, 9]


def test_lookups_read_few_row_groups(spark):
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    tuned, plain = scratch_path(spark, "tuned"), scratch_path(spark, "plain")
    load_verified(rows.repartitionByRange(2, "id"), tuned, sort=("id",), lookup={"key": 10_000}, row_group_bytes=64 << 10)
    load_verified(rows.repartition(2, "key"), plain, row_group_bytes=64 << 10)
    some = rows.where("id = 777").first()
    for name, value, found in (("id", 777, 1), ("id", 50_000, 0), ("key", some.key, 1), ("key", 12345, 0)):
        hits, read = reports.rows_scanned(spark.read.parquet(tuned).where(F.col(name) == value))
        same, plainly = reports.rows_scanned(spark.read.parquet(plain).where(F.col(name) == value))
        assert hits == same == found and read <= plainly and read < 4_000, (name, value, read, plainly)


@pytest.fixture(scope="module")
def house(spark):
    """Two fact tables where a build would have put them."""
    built = warehouse.Warehouse(spark, scratch_path(spark, "house"))
    orders = spark.range(500).select(F.col("id").alias("order_id"), F.lit(date(2024, 1, 1)).alias("order_date"), F.lit(1.0).alias("total_amount"), F.lit(202401).alias("ym"))
    lines = spark.range(2000).select((F.col("id") % 500).alias("order_id"), F.col("id").alias("detail_id"), F.lit(202401).alias("ym"))
    load_verified(orders, built.path("dwd", "order_fact"), "ym")
    load_verified(lines, built.path("dwd", "order_detail_fact"), "ym")
    return built


def test_bucketed_facts_join_without_a_shuffle(spark, house):
    names = warehouse.bucket_facts(house, 4, "facts_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(names["order_detail_fact"]).join(spark.table(names["order_fact"]).select("order_id", "total_amount"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == house.read("dwd", "order_detail_fact").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names.values():
            spark.sql(f"DROP TABLE {name}")


def test_items_of_one_order_are_numbered_like_any(spark, tmp_path, sf_dir):
    """An order that holds a third of all lines, many of them alike: no number twice, none lost."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = lines.limit(1).crossJoin(spark.range(3000)).drop("id").withColumn("l_orderkey", F.lit(1).cast(lines.schema["l_orderkey"].dataType))
    lines.unionByName(hot).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{sf_dir}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    items = Canon(spark, str(tmp_path)).items(with_id=True)
    total = items.count()
    assert total == lines.count() + 3000 and items.select("item_id").distinct().count() == total


def test_events_out_of_order_are_gaps(spark):
    t = [START + timedelta(hours=h) for h in range(5)]
    orders = spark.createDataFrame([(n, "completed") for n in range(5)] + [(9, "cancelled")], "order_id long, status string")
    chain = ("created", "paid", "shipped", "completed")
    rows = [(0, s, at) for s, at in zip(chain, t)] + [(1, s, at) for s, at in zip(chain, (t[1], t[0], t[2], t[3]))]
    rows += [(2, s, t[0]) for s in chain] + [(3, s, None if s == "paid" else at) for s, at in zip(chain, t)]
    rows += [(4, s, at) for s, at in zip((*chain, "paid"), (t[0], t[1], t[2], t[3], t[4]))] + [(9, "cancelled", t[0]), (9, "created", t[1])]
    events = spark.createDataFrame(rows, "order_id long, to_status string, event_time timestamp_ntz")
    assert {r.order_id for r in quality.event_chain_gaps(orders, events).collect()} == {1, 3, 9}
