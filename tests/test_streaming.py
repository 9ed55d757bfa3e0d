"""Streams equal their batch twins, over many files, late rows, rows without a time and restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.catalog.canon import Canon
from strataflow.functions import time_bucket
from strataflow.session import scratch_path
from strataflow.sources import read_file_stream
from strataflow.sources.streams import parse_records
from strataflow.streaming import (
    bucket_stats_stream,
    compact,
    current_rows,
    drain_to_table,
    minute_gmv_stream,
    session_stream,
    sliding_stats_stream,
)

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, amount decimal(10,2)"


@pytest.fixture(scope="module")
def folder(spark, sf_dir):
    """The events as five files, each a range of event times."""
    path = scratch_path(spark, "arriving")
    events = Canon(spark, sf_dir).activity().select("event_id", "ts", "user_id", "amount")
    edges = [datetime(2024, 1, 1) + timedelta(days=7 * i) for i in range(6)]
    for low, high in zip(edges, edges[1:]):
        events.where((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high))).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, folder):
    return read_file_stream(spark, folder, spark.read.parquet(folder).schema, max_files=1)


def _files(spark, batches):
    """A folder with one file per list of (id, time, user)."""
    path = scratch_path(spark, "files")
    for rows in batches:
        data = [(i, datetime.fromisoformat(t) if t else None, u, None) for i, t, u in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _drain(spark, table, path=None):
    path = path or scratch_path(spark, "table")
    drain_to_table(table, path, scratch_path(spark, "cp"))
    return path


def test_stream_equals_batch_over_many_batches(spark, folder):
    table = minute_gmv_stream(_stream(spark, folder), "ts", "amount")
    path = _drain(spark, table)
    assert spark.read.parquet(f"{path}/batches").select("batch_no").distinct().count() >= 5
    want = spark.read.parquet(folder).groupBy(time_bucket("1 minute", "ts").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"))
    assert _rows(current_rows(spark, path, table)) == _rows(want)


def test_restart_and_compaction_continue_where_they_stopped(spark, folder):
    live, path, checkpoint = scratch_path(spark, "live"), scratch_path(spark, "stats"), scratch_path(spark, "cp")
    files = spark.read.parquet(folder)
    first, second = files.where("day(ts) < 10"), files.where("day(ts) >= 10")
    first.coalesce(1).write.parquet(live)

    def drain():
        table = bucket_stats_stream(read_file_stream(spark, live, files.schema), "ts", "amount", "user_id")
        drain_to_table(table, path, checkpoint)
        return table

    compact(spark, path, drain())
    drain()
    second.coalesce(1).write.mode("append").parquet(live)
    table = drain()
    total = files.agg(F.count("*"), F.sum("amount")).first()[:]
    assert current_rows(spark, path, table).agg(F.sum("n"), F.sum("revenue")).first()[:] == total
    compact(spark, path, table)
    assert current_rows(spark, path, table).agg(F.sum("n"), F.sum("revenue")).first()[:] == total


def test_late_and_timeless_rows_are_counted(spark):
    path = _files(spark, [[(0, "2024-01-01T12:00:30", 1)], [(1, "2024-01-01T13:00:30", 1)], [(2, None, 1)], [(3, "2024-01-01T12:00:40", 1)], [(4, None, 2)]])
    table = minute_gmv_stream(_stream(spark, path), "ts", "amount")
    got = {r.bucket_time: r.minute_order_count for r in current_rows(spark, _drain(spark, table), table).collect()}
    assert got == {datetime(2024, 1, 1, 12): 2, datetime(2024, 1, 1, 13): 1, None: 2}


def test_buckets_do_not_depend_on_the_zone(spark):
    """02:30 does not exist in New York on that day."""
    path = _files(spark, [[(0, "2024-03-10T02:30:00", 1)], [(1, "2024-03-10T03:30:00", 1)]])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table = bucket_stats_stream(_stream(spark, path), "ts", "amount", "user_id")
        got = [r.bucket_time for r in current_rows(spark, _drain(spark, table), table).orderBy("bucket_time").collect()]
        slides = sliding_stats_stream(_stream(spark, path), "ts")
        spans = {(r.window_end - r.window_start) for r in current_rows(spark, _drain(spark, slides), slides).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 3, 30)] and spans == {timedelta(hours=1)}


def test_sliding_windows_overlap(spark, folder):
    table = sliding_stats_stream(_stream(spark, folder), "ts")
    got = current_rows(spark, _drain(spark, table), table)
    assert got.agg(F.sum("n")).first()[0] == spark.read.parquet(folder).count() * 12


def test_sessions_close_after_the_gap_and_merge_across_batches(spark):
    at = lambda m: (datetime(2024, 1, 1) + timedelta(minutes=m)).isoformat()
    path = _files(spark, [
        [(0, at(0), 1), (1, at(50), 1), (2, at(81), 1), (3, at(10), 2)], [(4, at(25), 1), (5, None, 1)], [(6, at(200), 1), (7, at(112), 1), (8, None, 1)],
    ])
    table = session_stream(_stream(spark, path), "ts", "user_id")
    out = _drain(spark, table)
    want = [(1, 0, 3), (1, 81, 1), (1, 112, 1), (1, 200, 1), (1, None, 2), (2, 10, 1)]
    for _ in range(2):
        got = {(r.user_id, r.session_start, r.n) for r in current_rows(spark, out, table).collect()}
        assert got == {(u, None if m is None else datetime(2024, 1, 1) + timedelta(minutes=m), n) for u, m, n in want}
        compact(spark, out, table)


def test_replayed_batch_replaces_its_own_folder(spark):
    """What foreachBatch does when a batch runs twice."""
    path = _files(spark, [[(0, "2024-01-01T12:00:30", 1)]])
    table = minute_gmv_stream(_stream(spark, path), "ts", "amount")
    out = _drain(spark, table)
    table.partial(spark.read.parquet(path)).write.mode("overwrite").parquet(f"{out}/batches/batch_no=0")
    assert [r.minute_order_count for r in current_rows(spark, out, table).collect()] == [1]


def test_malformed_records_keep_their_text(spark):
    raw = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no number"}',), ("not json",), (None,)], "value string")
    got = parse_records(raw, T.StructType().add("a", "long").add("b", "string")).collect()
    assert [(r.a, r.b, r.malformed) for r in got] == [
        (1, "x", None), (None, None, '{"a": "no number"}'), (None, None, "not json"), (None, None, None)]
