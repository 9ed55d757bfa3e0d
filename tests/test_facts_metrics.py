"""Facts, pre-aggregates and metrics on the hand-written shop."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow.config import WarehouseConfig
from strataflow.operators import quality as q
from strataflow.operators.clean import CLEAN_RULES, clean, clean_report
from strataflow.plans import aggregates, dims, facts, metrics, panels

D = Decimal


@pytest.fixture(scope="module")
def built(spark, shop):
    ods = {name: clean(df, CLEAN_RULES[name]) for name, df in shop.items()}
    region, promo = dims.dim_region(spark), dims.dim_promotion(spark)
    order = facts.order_fact(
        ods["orders"], ods["users"], region, ods["payments"], ods["order_status_events"], ods["order_items"], promo)
    detail = facts.order_detail_fact(ods["order_items"], ods["orders"], ods["users"], region, promo)
    event = facts.status_event_fact(ods["order_status_events"], ods["orders"])
    return ods, order, detail, event, region, promo


def test_order_fact(built):
    _, order, *_ = built
    rows = {r.order_id: r for r in order.collect()}
    assert len(order.columns) == 14 and sorted(rows) == [100, 101, 102, 103, 104]
    assert (rows[100].region_id, rows[101].region_id, rows[102].region_id, rows[103].region_id) == (1, 1, 3, 0)
    assert rows[100].discount_amount == D("25.00") and rows[102].discount_amount == D("15.00") and rows[101].discount_amount == 0
    assert rows[100].finish_time == datetime(2024, 11, 14, 0, 5) and rows[100].cancel_time is None
    assert rows[103].cancel_time == datetime(2024, 10, 31, 12, 10, 30) and rows[103].pay_time is None
    assert rows[102].pay_time == datetime(2024, 11, 12, 0, 2), "two payments: the first counts, the order is not doubled"
    assert rows[101].order_date == date(2024, 11, 11) and rows[103].freight_amount == 0
    assert D(8) <= rows[104].freight_amount < D(15)
    assert [rows[i].source_type for i in (100, 101, 102, 104)] == ["miniapp", "miniapp", "web", "web"]


def test_detail_fact_rounds_each_line(built):
    _, _, detail, *_ = built
    rows = {r.detail_id: r for r in detail.collect()}
    assert len(detail.columns) == 13
    assert (rows[1].final_price, rows[1].line_amount) == (D("7.50"), D("75.00"))
    assert (rows[6].final_price, rows[6].line_amount) == (D("0.01"), D("0.01")), "0.0075 rounds half up"
    assert rows[3].line_amount == D("85.00") and rows[4].region_id == 0


def test_event_fact(built):
    _, _, _, event, *_ = built
    assert event.count() == 8 and len(event.columns) == 8
    assert event.where("event_date <> to_date(event_time)").count() == 0


def test_repeated_events_do_not_multiply_orders(built):
    ods, order, *_ , region, promo = built
    doubled = ods["order_status_events"].unionAll(ods["order_status_events"].withColumn("event_time", F.expr("event_time + interval 1 hour")))
    again = facts.order_fact(
        ods["orders"], ods["users"], region, ods["payments"].unionAll(ods["payments"]), doubled, ods["order_items"], promo)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, order.collect()))


def test_latency_equals_the_three_way_self_join_even_with_repeats(spark, built):
    _, _, _, event, *_ = built
    more = spark.createDataFrame(
        [(n, 7, s, datetime(2024, 1, d, h)) for n, (s, d, h) in enumerate([
            ("paid", 1, 1), ("paid", 1, 4), ("shipped", 2, 0), ("shipped", 3, 5), ("shipped", 3, 9), ("completed", 8, 0), ("completed", 9, 0)])],
        "event_id long, order_id long, to_status string, event_time timestamp_ntz")
    events = event.select("event_id", "order_id", "to_status", "event_time").unionAll(more)
    p, s, c = (events.where(F.col("to_status") == x).select("order_id", F.col("event_time").alias(x)) for x in ("paid", "shipped", "completed"))
    joined = p.join(s, "order_id").join(c, "order_id").selectExpr(
        "avg(timestampdiff(MICROSECOND, paid, shipped) / 3.6e9) AS a", "avg(timestampdiff(MICROSECOND, shipped, completed) / 3.6e9) AS b").first()
    for measure in (aggregates.fulfilment_latency, aggregates.fulfilment_latency_joined):
        got = measure(events).first()
        assert got.paid_to_shipped_hours == pytest.approx(joined.a, rel=1e-12)
        assert got.shipped_to_completed_hours == pytest.approx(joined.b, rel=1e-12)


def test_aggregates_and_metrics(built):
    ods, order, detail, event, region, _ = built
    products = dims.dim_product(ods["products"])
    dws = aggregates.build_all(order, detail, event)
    daily = {r.dt.date(): r for r in dws["daily_gmv"].collect()}
    assert daily[date(2024, 11, 11)].gmv == D("274.98") and daily[date(2024, 10, 31)].order_count == 1
    share = {r.category: r.pct for r in metrics.category_share(dws["product_daily_sales"], products).collect()}
    assert sum(share.values()) == pytest.approx(100)
    one = metrics.user_repurchase(dws["user_purchase_stats"]).first()
    assert (one.repurchase_rate, one.repeat_buyers, one.total_buyers) == (100.0, 2, 2)
    cfg = WarehouseConfig(segment_high=D("200"), segment_mid=D("100"))
    segments = {r.segment: r.user_count for r in metrics.user_segment(dws["user_purchase_stats"], cfg).collect()}
    assert segments == {"high": 1, "low": 1}
    by_region = {r.province: (r.order_cnt, r.gmv) for r in metrics.gmv_by_region(order, region).collect()}
    assert by_region == {"北京市": (2, D("274.98")), "广东省": (2, D("85.02"))}
    funnel = [(r.step_no, r.status, r.order_count) for r in metrics.status_funnel_ordered(dws["status_funnel"]).collect()]
    assert funnel == [(1, "created", 3), (2, "paid", 2), (3, "shipped", 1), (4, "completed", 1), (5, "cancelled", 1)]
    compare = {r.period: r for r in metrics.promo_compare(dws["promo_daily_compare"]).collect()}
    assert compare["normal"].uplift_pct == 0 and compare["promo"].days == 2
    assert compare["promo"].uplift_pct == pytest.approx((80.0 / 100.0 - 1) * 100)
    top = [r.product_name for r in metrics.top_products(dws["product_daily_sales"], products).collect()]
    assert set(top) == {"pen", "cup", "hat"}
    pivot = panels.panel_category_pivot(metrics.category_revenue(dws["product_daily_sales"], products)).first()
    assert pivot.electronics == D("160.00") and pivot.food is None
    joined = aggregates.product_daily_sales(detail, order)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, dws["product_daily_sales"].collect()))


def test_top_k_breaks_ties_by_key(spark):
    tied = spark.createDataFrame([(i, D("5.00")) for i in range(30)], "k int, m decimal(10,2)")
    assert [r.k for r in metrics.top_by(tied, ["m"], 3, "k").collect()] == [0, 1, 2]


def test_empty_inputs(built):
    ods, order, detail, event, region, _ = built
    none = order.where("order_id < 0")
    assert metrics.user_repurchase(aggregates.user_purchase_stats(none)).first().repurchase_rate is None
    assert aggregates.fulfilment_latency(event.where("order_id < 0")).first().paid_to_shipped_hours is None
    assert aggregates.daily_gmv(none).count() == 0


def test_invariants_on_given_tables(spark, sf_dir):
    """Cross-metric identities that hold on any data."""
    from strataflow.catalog.canon import Canon

    c = Canon(spark, sf_dir)
    users, minutes, daily = c.user_stats().cache(), c.minutes().cache(), c.daily().cache()
    segments = metrics.user_segment(users, c.cfg).agg(F.sum("user_count"), F.sum("total_orders")).first()
    assert segments[0] == metrics.user_repurchase(users).first().total_buyers
    valid = aggregates.valid_orders(c.order_core()).count()
    assert segments[1] == valid == c.promo_compare().agg(F.sum("order_cnt")).first()[0]
    funnel = {r.status: r.order_count for r in c.funnel().collect()}
    assert funnel["created"] == funnel["paid"] + funnel["cancelled"] and funnel["paid"] == valid
    per_day = minutes.groupBy(F.to_date("bucket_time").alias("d")).agg(F.sum("minute_order_count").alias("n"))
    assert per_day.join(daily, F.col("d") == F.to_date("dt")).where("n <> order_count").count() == 0
    assert daily.agg(F.sum("gmv")).first()[0] == c.promo_compare().agg(F.sum("gmv")).first()[0]
    placed = metrics.gmv_by_region(c.placed_orders(), c.region()).agg(F.sum("order_cnt")).first()[0]
    assert placed == q.region_match(c.placed_orders()).first().matched
    last = metrics.gmv_running_total(minutes).orderBy(F.desc("bucket_time")).first()
    assert last.running_order_count == valid


def test_cleaning(spark):
    raw = spark.createDataFrame(
        [(1, 1, datetime(2024, 1, 1), None, None, None), (None, 1, datetime(2024, 1, 1), "paid", D("1.00"), 1),
         (2, None, datetime(2024, 1, 1), "paid", D("1.00"), 1), (3, 1, None, "paid", D("1.00"), 1),
         (4, 1, datetime(2024, 1, 1), "paid", D("1.00"), 2)],
        "order_id long, user_id long, order_date timestamp_ntz, status string, total_amount decimal(12,2), promo_id int")
    rows = {r.order_id: r for r in clean(raw, CLEAN_RULES["orders"]).collect()}
    assert sorted(rows) == [1, 4]
    assert (rows[1].status, rows[1].total_amount, rows[1].promo_id) == ("unknown", 0, 0)
    report = clean_report({"orders": raw}).first()
    assert (report.kept, report.dropped) == (2, 3)
    assert clean_report({"orders": raw.limit(0)}).first().kept == 0


def test_running_violation_is_found(spark):
    series = spark.createDataFrame(
        [(datetime(2024, 1, 1, 23, 59), 5.0), (datetime(2024, 1, 2, 0, 0), 4.0), (datetime(2024, 1, 2, 0, 1), 6.0)],
        "bucket_time timestamp_ntz, running_gmv double")
    found = q.running_violations(series).collect()
    assert [r.bucket_time for r in found] == [datetime(2024, 1, 2)], "the fall is across midnight"


def test_checks_fail_on_null_and_empty(spark):
    empty = spark.createDataFrame([], "x double")
    results = q.suite([
        q.evaluate(empty, [q.expect_min("min", F.min("x"), 1), q.expect_count("none", 0), q.expect_sum("sum", F.col("x"), 0, 0.1)]),
        q.expect_unique("unique", spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]),
    ])
    verdicts = {r.check_name: r.passed for r in results.collect()}
    assert verdicts == {"min": False, "none": True, "sum": True, "unique": False}
    assert tuple(q.summary(results).first()) == (2, 4, False)
