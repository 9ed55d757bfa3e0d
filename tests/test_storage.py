"""Writers, layouts, upserts, audit and reports."""

import glob
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.catalog.canon import Canon
from strataflow.operators import reports
from strataflow.sinks import (
    AuditLog,
    assert_in_range,
    audit_append,
    dedupe_latest,
    filter_range,
    load_verified,
    out_of_range,
    refresh,
    upsert_latest,
    upsert_partitions,
    with_key_range,
    with_month,
)
from strataflow.session import scratch_path, scratch_root
from strataflow.sources import extract_all, jdbc_options, read_csv, replicate, row_counts


@pytest.fixture(scope="module")
def monthly(spark, sf_dir):
    path = scratch_path(spark, "monthly")
    events = Canon(spark, sf_dir).status_events()
    rows = load_verified(with_month(events, "event_time"), path, "ym", ("event_time", "event_id"))
    return path, rows, events


def test_load_is_verified_and_idempotent(spark, monthly):
    path, rows, events = monthly
    assert rows == events.count() == spark.read.parquet(path).count()
    assert load_verified(with_month(events, "event_time"), path, "ym") == rows
    assert load_verified(events.limit(0), scratch_path(spark, "empty")) == 0


def test_lost_rows_are_noticed(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    real = DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda self: real(self) - 1)
    with pytest.raises(RuntimeError, match="wrote 10 rows, table holds 9"):
        load_verified(spark.range(10).toDF("x"), scratch_path(spark, "short"))


def test_hot_month_is_written_by_several_tasks(spark):
    """Adaptive execution splits the heavy partition value and still merges the light ones."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 400_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                                   F.when(F.col("id") % 3 != 0, 202411).otherwise(F.col("id") % 12).alias("ym"))
        path = scratch_path(spark, "hot")
        load_verified(hot, path, "ym")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p: len(glob.glob(f"{path}/ym={p}/part-*")) for p in (202411, 0, 3, 6, 9)}
    assert files[202411] >= 4 and min(files.values()) <= 2, files


def test_range_filter_prunes_partitions(spark, monthly):
    path, _, events = monthly
    low, high = datetime(1998, 11, 1), datetime(1998, 12, 1)
    stored = spark.read.parquet(path)
    pruned = filter_range(stored, "event_time", low, high)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "(ym#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert pruned.count() == events.where((F.col("event_time") >= F.lit(low)) & (F.col("event_time") < F.lit(high))).count()
    touched = {r.scope: r.partitions for r in reports.partitions_touched(stored, "event_time", low, high).collect()}
    assert touched["range"] == 1 < touched["full"]
    # An upper bound at midnight of the first must not drag in the next month.
    assert filter_range(stored, "event_time", low, high).select("ym").distinct().count() == 1


def test_partition_report(spark, monthly):
    path, rows, _ = monthly
    report = reports.partition_sizes(spark, path).collect()
    assert sum(r.row_count for r in report) == rows
    assert [r.bytes for r in report] == sorted((r.bytes for r in report), reverse=True)
    total = reports.table_bytes(spark, path).first()
    assert total.bytes == sum(os.path.getsize(p) for p in glob.glob(f"{path}/ym=*/part-*"))


def test_compact_layout_saves_half(spark, sf_dir):
    """Forty copies of the orders as compressed columns and as plain text rows."""
    copies = replicate(Canon(spark, sf_dir).orders(), 40)
    compact, plain = scratch_path(spark, "compact"), scratch_path(spark, "plain")
    expected = Canon(spark, sf_dir).orders().count() * 40
    assert load_verified(copies, compact, sort=("order_date",), codec="lz4") == expected
    copies.write.csv(plain)
    assert spark.read.text(plain).count() == expected
    assert reports.layout_savings(spark, compact, plain).first().savings_pct >= 50


def test_key_range_and_bounds(spark):
    keys = spark.createDataFrame([(0,), (1,), (20000,), (20001,), (200000,), (None,)], "k long")
    rows = {r.k: r.key_range for r in with_key_range(keys, "k", 20_000).collect()}
    assert rows == {0: -1, 1: 0, 20000: 0, 20001: 1, 200000: 9, None: None}
    assert {r.k for r in out_of_range(keys, "k", 1, 20001).collect()} == {0, 20001, 200000, None}


def test_key_ranges_of_large_keys_are_exact(spark):
    big = 9007199254740994
    assert [r.key_range for r in with_key_range(spark.createDataFrame([(big,)], "k long"), "k", 1).collect()] == [big - 1]


def test_bounds_are_enforced(spark):
    keys = spark.range(1, 10).toDF("k")
    assert assert_in_range(keys, "k", 1, 10) is keys
    with pytest.raises(ValueError, match="1 rows have k outside"):
        assert_in_range(keys, "k", 1, 9)


def test_partition_upsert_rewrites_only_what_it_touches(spark):
    path = scratch_path(spark, "table")
    base = spark.range(0, 900).select("id", (F.col("id") % 3 + 202401).cast("int").alias("ym"), F.lit("old").alias("v"), F.lit(1).alias("ver"))
    load_verified(base, path, "ym", ("id",))
    before = {p: sorted(os.listdir(f"{path}/ym={p}")) for p in (202401, 202402, 202403)}
    delta = spark.createDataFrame([(1, 202402, "new", 2), (4, 202402, "stale", 0), (1000, 202402, "added", 1)], "id long, ym int, v string, ver int")
    upsert_partitions(spark, path, delta, ["id"], "ver", "ym", ("id",))
    after = {p: sorted(os.listdir(f"{path}/ym={p}")) for p in before}
    assert after[202401] == before[202401] and after[202403] == before[202403] and after[202402] != before[202402]
    rows = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert len(rows) == 901 and (rows[1], rows[4], rows[1000]) == ("new", "old", "added")


def test_partition_upsert_keeps_null_partitions_and_moves_keys(spark):
    path = scratch_path(spark, "nulls")
    rows = "id long, ym int, v string, ver int"
    base = spark.createDataFrame([(1, None, "a", 1), (2, None, "b", 1), (3, 202401, "c", 1), (5, 202402, "e", 1), (6, 202403, "f", 1)], rows)
    load_verified(base, path, "ym", ("id",))
    delta = spark.createDataFrame([(4, None, "d", 1), (3, 202402, "moved", 2), (2, 202403, "placed", 2), (5, 202401, "stale", 0)], rows)
    upsert_partitions(spark, path, delta, ["id"], "ver", "ym", ("id",))
    got = sorted((r.id, r.ym, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, None, "a"), (2, 202403, "placed"), (3, 202402, "moved"), (4, None, "d"), (5, 202402, "e"), (6, 202403, "f")]


def test_upsert_and_dedupe(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "k int, v string, ver int")
    delta = spark.createDataFrame([(1, "A", 2), (2, "old", 4), (3, "C", 1), (4, "D", 1)], "k int, v string, ver int")
    merged = {r.k: r.v for r in upsert_latest(base, delta, ["k"], "ver").collect()}
    assert merged == {1: "A", 2: "b", 3: "C", 4: "D"}
    twice = base.unionAll(base)
    assert sorted(map(tuple, dedupe_latest(twice, ["k"], "ver").collect())) == sorted(map(tuple, base.collect()))
    assert dedupe_latest(twice.select("k"), ["k"]).count() == 3
    plan = upsert_latest(base, delta, ["k"], "ver")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


def test_refresh_replaces(spark):
    root = scratch_path(spark, "dws")
    assert refresh(spark, {"a": spark.range(3).toDF("x"), "b": spark.range(4).toDF("x")}, root) == {"a": 3, "b": 4}
    assert refresh(spark, {"a": spark.range(2).toDF("x")}, root) == {"a": 2}


def test_audit_records_failures(spark):
    path = scratch_path(spark, "audit")
    log = AuditLog(spark, path, run_id="r1")
    log.step("good", lambda: (7, "dropped: orders 2"))
    with pytest.raises(ZeroDivisionError):
        log.step("bad", lambda: 1 // 0)
    audit_append(spark, path, "r1", 3, "timed", "success", 1000, 500)
    rows = {r.step: r for r in spark.read.parquet(path).collect()}
    assert (rows["good"].status, rows["good"].rows_processed, rows["good"].log_id, rows["good"].message) == ("success", 7, 1, "dropped: orders 2")
    assert rows["bad"].status == "failed" and "ZeroDivisionError" in rows["bad"].message

    def fails():
        raise ValueError("x" * 3000)

    with pytest.raises(ValueError):
        log.step("long", fails)
    assert "x" * 3000 in spark.read.parquet(path).where("step = 'long'").first().message
    speed = {r.step: r for r in reports.etl_throughput(spark.read.schema(schemas.AUDIT_LOG).parquet(path)).collect()}
    assert (speed["timed"].rows_per_sec, speed["timed"].duration_sec, speed["timed"].duration) == (2000.0, 0.5, "00:00:00")


def test_csv_quotes_nulls_and_crlf(spark, tmp_path):
    text = '1,"a, ""b""",x@y,2024-01-01,城,省,active\r\n2,,,,,,\r\n'
    (tmp_path / "u.csv").write_bytes(text.encode())
    rows = read_csv(spark, str(tmp_path), schemas.USERS, crlf=True).orderBy("user_id").collect()
    assert rows[0].name == 'a, "b"' and rows[0].status == "active" and rows[0].city == "城"
    assert rows[1].name is None
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "o.csv").write_bytes(b"1,2,2024-11-11T00:00:00.000,paid,1.50,\r\n2,2,2024-11-11T23:59:59.999,paid,1.50,3\r\n")
    orders = read_csv(spark, str(tmp_path / "n"), schemas.ORDERS, crlf=True).orderBy("order_id").collect()
    assert [r.promo_id for r in orders] == [None, 3] and orders[1].order_date == datetime(2024, 11, 11, 23, 59, 59, 999000)
    assert orders[0].total_amount == Decimal("1.50")


def test_malformed_rows_fail_fast(spark, tmp_path):
    (tmp_path / "o.csv").write_text("x,2,2024-11-11T00:00:00,paid,1.50,1\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_csv(spark, str(tmp_path), schemas.ORDERS).collect()


def test_jdbc_options():
    """Only the options are covered: no database may be started here."""
    options = jdbc_options("jdbc:x", "orders", part_col="order_id", bounds=(1, 9), partitions=4, user="u")
    assert options["partitionColumn"] == "order_id" and options["numPartitions"] == "4" and options["user"] == "u"
    assert options["preferTimestampNTZ"] == "true" and "partitionColumn" not in jdbc_options("jdbc:x", "orders")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "orders", partitions=4)


def test_row_counts_and_replicate(spark):
    counts = {r.table_name: r.row_count for r in row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert counts == {"a": 3, "b": 0}
    copies = replicate(spark.range(3), 5)
    assert copies.count() == 15 and copies.agg(F.min("copy_no"), F.max("copy_no")).first()[:] == (1, 5)
    assert "Exchange" not in copies._jdf.queryExecution().executedPlan().toString()


def test_scratch_follows_the_session_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_an_extract_needs_bounds_or_a_table_named_as_small(spark):
    with pytest.raises(ValueError, match="payments"):
        extract_all(spark, "jdbc:x", {"orders": (1, 9)}, whole=("users", "products", "order_items", "order_status_events"))
