"""Event-time state: windows handed out once, late rows inside and outside the delay, restarts, bounded keys."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strataflow.session import scratch_path
from strataflow.sources import read_file_stream
from strataflow.streaming import bucket_stats, deduplicated, emitted, latest, minute_orders, sessions, state_rows, store_batches, windowed
from strataflow.streaming.event_time import clock, instant

SCHEMA = "id long, ts timestamp_ntz, user_id long, amount decimal(10,2)"
START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def put(spark, path, rows):
    """One file, which is one batch: (id, minutes, user)."""
    data = [(i, None if m is None else at(m), u, None) for i, m, u in rows]
    spark.createDataFrame(data, SCHEMA).withColumn("amount", F.lit(1).cast("decimal(10,2)")).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return read_file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, max_files=1)


def run(spark, batches, make, mode="append"):
    """(path, query) after all batches, one file each."""
    source, path = scratch_path(spark, "source"), scratch_path(spark, "rows")
    for rows in batches:
        put(spark, source, rows)
    return path, store_batches(make(stream(spark, source)), path, scratch_path(spark, "cp"), mode)


# 12:00, then 12:30; a row 20 minutes late, inside the delay of 30; then 14:00, and rows two hours late, outside of it.
BATCHES = [
    [(1, 720, 1), (2, 720.5, 1), (3, 750, 1)], [(4, 731, 1), (5, None, 1)], [(6, 840, 1)], [(7, 841, 1)], [(8, 720.2, 1), (9, 731.5, 1), (10, 842, 1)], [(11, 960, 2)],
]


def test_closed_windows_are_handed_out_once(spark):
    path, _ = run(spark, BATCHES, lambda s: minute_orders(s, "ts", "amount", "30 minutes"))
    got = Counter((r.bucket_time, r.minute_order_count) for r in emitted(spark, path).collect())
    # 16:00 is the newest row, so windows up to 15:30 are closed; 8 and 9 came too late.
    assert got == Counter({(at(720), 2): 1, (at(731), 1): 1, (at(750), 1): 1, (at(840), 1): 1, (at(841), 1): 1, (at(842), 1): 1})


def test_one_batch_has_no_late_rows(spark):
    path, _ = run(spark, [[row for batch in BATCHES for row in batch]], lambda s: minute_orders(s, "ts", "amount", "30 minutes"))
    got = {r.bucket_time: r.minute_order_count for r in emitted(spark, path).collect()}
    assert got == {at(720): 3, at(731): 2, at(750): 1, at(840): 1, at(841): 1, at(842): 1}


def test_update_mode_holds_the_newest_state(spark):
    path, _ = run(spark, BATCHES, lambda s: bucket_stats(s, "ts", "amount", "user_id", "30 minutes"), "update")
    got = {r.bucket_time: (r.n, r.units, r.avg_amount) for r in latest(spark, path, ["bucket_time"]).collect()}
    assert got == {at(720): (2, 2, 1.0), at(730): (1, 1, 1.0), at(750): (1, 1, 1.0), at(840): (3, 3, 1.0), at(960): (1, 2, 1.0)}


@pytest.mark.parametrize("mode", ["append", "update"])
def test_a_restart_goes_on_from_the_checkpoint(spark, mode):
    source, path, checkpoint = (scratch_path(spark, n) for n in ("live", "rows", "cp"))
    for cut in (BATCHES[:2], BATCHES[2:5], [], BATCHES[5:]):
        for rows in cut:
            put(spark, source, rows)
        store_batches(minute_orders(stream(spark, source), "ts", "amount", "30 minutes"), path, checkpoint, mode)
    once, _ = run(spark, BATCHES, lambda s: minute_orders(s, "ts", "amount", "30 minutes"), mode)
    read = emitted if mode == "append" else lambda s, p: latest(s, p, ["bucket_time"])
    assert Counter(map(tuple, read(spark, path).collect())) == Counter(map(tuple, read(spark, once).collect()))


def test_a_replayed_batch_replaces_its_folder(spark):
    path, _ = run(spark, BATCHES, lambda s: minute_orders(s, "ts", "amount", "30 minutes"))
    before = sorted(map(tuple, emitted(spark, path).collect()))
    numbers = [r.batch_no for r in spark.read.parquet(path).select("batch_no").distinct().collect()]
    again = spark.read.parquet(f"{path}/batch_no={max(numbers)}").collect()
    spark.createDataFrame(again, emitted(spark, path).schema).write.mode("overwrite").parquet(f"{path}/batch_no={max(numbers)}")
    assert sorted(map(tuple, emitted(spark, path).collect())) == before


def test_wall_clocks_survive_any_zone(spark):
    """02:30 does not exist in New York on that day, and 01:30 happens twice on another."""
    clocks = [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30, 0, 123456), datetime(1890, 5, 1, 1, 2, 3)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame([(c,) for c in clocks], "ts timestamp_ntz").withColumn("at", instant("ts"))
        assert [r.back for r in rows.select(clock("at").alias("back")).collect()] == clocks
        minutes = (clocks[0] - START).total_seconds() / 60
        path, _ = run(spark, [[(1, minutes, 1), (2, minutes + 60, 1)]], lambda s: minute_orders(s, "ts", "amount", "30 minutes"), "update")
        assert {r.bucket_time for r in latest(spark, path, ["bucket_time"]).collect()} == {clocks[0], clocks[0] + timedelta(hours=1)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_overlapping_windows_per_key(spark):
    path, _ = run(spark, BATCHES[:3], lambda s: windowed(s, "ts", "1 hour", "30 minutes", [F.count(F.lit(1)).alias("n")], ["user_id"], "30 minutes"), "update")
    got = {(r.bucket_time, r.user_id): r.n for r in latest(spark, path, ["bucket_time", "user_id"]).collect()}
    assert got == {(at(690), 1): 3, (at(720), 1): 4, (at(750), 1): 1, (at(810), 1): 1, (at(840), 1): 1}
    with pytest.raises(ValueError):
        windowed(stream(spark, path), "ts", "0 minutes", "1 minute", [F.count(F.lit(1)).alias("n")])


def test_sessions_close_behind_the_watermark(spark):
    batches = [[(1, 0, 1), (2, 50, 1), (3, 10, 2)], [(4, 25, 1), (5, 80, 1)], [(6, 300, 2)], [(8, 301, 2)], [(7, 5, 1)], [(9, 600, 3)]]
    path, _ = run(spark, batches, lambda s: sessions(s, "ts", "user_id", "30 minutes", "2 hours"))
    got = {(r.user_id, r.session_start, r.session_end, r.n) for r in emitted(spark, path).collect()}
    # 25 joins 0 and 50, and 80 touches the end of 50; 7 came hours late.
    assert got == {(1, at(0), at(110), 4), (2, at(10), at(40), 1), (2, at(300), at(331), 2)}


def test_repeats_are_dropped_until_their_key_expires(spark):
    batches = [[(1, 0, 1), (1, 0, 1), (2, 1, 1)], [(1, 20, 1), (3, 30, 1)], [(4, 500, 1)], [(5, 501, 1)], [(1, 502, 1), (2, 0, 1), (4, 499, 1)]]
    path, query = run(spark, batches, lambda s: deduplicated(s, ["id"], "ts", "60 minutes"))
    got = sorted((r.id, r.ts) for r in emitted(spark, path).collect())
    assert got == [(1, at(0)), (1, at(502)), (2, at(1)), (3, at(30)), (4, at(500)), (5, at(501))]
    assert "_at" not in emitted(spark, path).columns and state_rows(query)


def test_state_is_bounded_by_the_delay(spark):
    """Forty stretches of fifty keys each, of which the state never holds more than those of a few."""
    batches = [[(50 * n + k, 60 * n + k, 1) for k in range(50)] for n in range(12)]
    for make, most in ((lambda s: deduplicated(s, ["id"], "ts", "60 minutes"), 250), (lambda s: minute_orders(s, "ts", "amount", "60 minutes"), 250)):
        path, query = run(spark, batches, make)
        assert max(state_rows(query)) <= most and emitted(spark, path).count() >= 450
