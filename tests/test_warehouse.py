"""The whole build: layers, audit, repeatability and failure."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow import verify
from strataflow.catalog.canon import Canon
from strataflow.config import WarehouseConfig
from strataflow.operators import quality
from strataflow.plans import dims, metrics, warehouse
from strataflow.plans.views import register_views
from strataflow.session import scratch_path


@pytest.fixture(scope="module")
def house(spark, sf_dir):
    c = Canon(spark, sf_dir)
    root = scratch_path(spark, "house")
    return c, root, warehouse.build(spark, c.sources(), root, c.region(), c.promotions(), c.cfg, verify=False)


def test_layers_hold_what_the_lazy_plans_give(house):
    c, _, built = house
    assert built.read("ods", "orders").count() == c.raw("orders").count()
    assert built.read("dwd", "order_detail_fact").count() == c.detail_lines().count()
    for name, lazy in (("daily_gmv", c.daily()), ("user_purchase_stats", c.user_stats()), ("status_funnel", c.funnel()),
                       ("product_daily_sales", c.product_days()), ("promo_daily_compare", c.promo_compare()),
                       ("minute_traffic", c.minutes())):
        assert sorted(map(tuple, built.aggregate(name).collect())) == sorted(map(tuple, lazy.collect())), name
    assert built.read("dim", "dim_date").count() > 2000


def test_metrics_read_only_the_aggregates(house):
    c, _, built = house
    running = metrics.gmv_running_total(built.aggregate("minute_traffic"), date(1998, 1, 5))
    assert all("/dws/minute_traffic/" in name for name in running.inputFiles())
    assert "PushedFilters: [IsNotNull(bucket_time)" in running._jdf.queryExecution().executedPlan().toString()


def test_second_build_replaces_the_first(spark, house):
    c, root, built = house
    before = {n: built.aggregate(n).count() for n in ("daily_gmv", "product_daily_sales")}
    warehouse.build(spark, c.sources(), root, c.region(), c.promotions(), c.cfg, verify=False)
    assert {n: built.aggregate(n).count() for n in before} == before
    audit = built.read("audit", "etl_log")
    assert audit.select("run_id").distinct().count() == 2 and audit.where("status = 'success'").count() == 16
    assert built.read("ods", "orders").count() == c.raw("orders").count()


def test_failed_checks_are_stored_and_raise(spark, house):
    """The given tables have no focus-day burst and headers that differ from their lines."""
    c, _, _ = house
    root = scratch_path(spark, "failing")
    with pytest.raises(warehouse.VerificationFailed):
        warehouse.build(spark, c.sources(), root, c.region(), c.promotions(), c.cfg)
    verdicts = {r.check_name: r.passed for r in spark.read.parquet(f"{root}/audit/verification").collect()}
    assert len(verdicts) == 23 and verdicts["one fact per order"] and not verdicts["headers match lines"]
    assert verdicts["audit entries"] and verdicts["order day matches order time"] and not verdicts["focus day burst"]
    last = spark.read.parquet(f"{root}/audit/etl_log").orderBy(F.desc("log_id")).first()
    assert (last.step, last.status) == ("verify", "failed")


def test_a_sound_shop_passes_every_check(spark):
    """Ten products, a burst on the focus day, headers that equal their lines: everything holds."""
    products = spark.range(10).selectExpr("id AS product_id", "concat('p', id) AS product_name", "concat('c', id % 5) AS category",
                                          "CAST(id + 1 AS DECIMAL(10,2)) AS price", "1 AS stock")
    region = dims.dim_region(spark)
    users = region.selectExpr("CAST(region_id AS LONG) AS user_id", "concat('u', region_id) AS name", "'e' AS email",
                              "DATE'2024-01-01' AS register_date", "city", "province", "'active' AS status")
    # Days 9-13 November: one order a day, two hundred on the 11th.
    orders = spark.range(204).selectExpr(
        "id + 1 AS order_id", "id % 10 + 1 AS user_id",
        "CASE WHEN id < 200 THEN timestampadd(MINUTE, CAST(id % 120 AS INT), TIMESTAMP_NTZ'2024-11-11 00:00:00') WHEN id = 200 THEN TIMESTAMP_NTZ'2024-11-09 10:00:00' "
        "WHEN id = 201 THEN TIMESTAMP_NTZ'2024-11-10 10:00:00' WHEN id = 202 THEN TIMESTAMP_NTZ'2024-11-12 10:00:00' ELSE TIMESTAMP_NTZ'2024-11-13 10:00:00' END AS order_date",
        "'paid' AS status", "CASE WHEN id < 200 THEN 2 END AS promo_id")
    items = orders.selectExpr("explode(sequence(1, 2 + CAST(order_id % 2 AS INT))) AS n", "order_id", "promo_id").selectExpr(
        "order_id * 10 + n AS item_id", "order_id", "(order_id + n) % 10 AS product_id", "CAST(n AS INT) AS qty",
        "CAST((order_id + n) % 10 + 1 AS DECIMAL(10,2)) AS unit_price", "promo_id")
    totals = items.groupBy("order_id").agg(
        F.sum(F.expr("round(qty * unit_price * CASE WHEN promo_id = 2 THEN 0.75 ELSE 1 END, 2)")).cast("decimal(12,2)").alias("total_amount"))
    orders = orders.join(totals, "order_id")
    payments = orders.selectExpr("order_id AS payment_id", "order_id", "'card' AS method", "order_date AS pay_date",
                                 "total_amount AS amount", "'completed' AS status")
    events = orders.selectExpr("order_id", "order_date", "inline(array(struct(1 AS step, 'created' AS to_status), struct(2 AS step, 'paid' AS to_status)))").selectExpr(
        "order_id * 10 + step AS event_id", "order_id", "CAST(NULL AS STRING) AS from_status", "to_status", "order_date AS event_time", "'user' AS operator_type")
    sources = {"users": users, "products": products, "orders": orders, "order_items": items.drop("promo_id"),
               "payments": payments, "order_status_events": events}
    cfg = WarehouseConfig(segment_high=Decimal("500"), segment_mid=Decimal("200"))
    root = scratch_path(spark, "sound")
    try:
        warehouse.build(spark, sources, root, region, dims.dim_promotion(spark), cfg)
    except warehouse.VerificationFailed:
        pytest.fail(str(spark.read.parquet(f"{root}/audit/verification").where("NOT passed").collect()))
    log = {r.step: r.status for r in spark.read.parquet(f"{root}/audit/etl_log").collect()}
    assert log["verify"] == "success" and len(log) == 9


def test_named_views_answer_sql(spark, house):
    c, _, built = house
    names = register_views(built, c.cfg)
    assert {"daily_gmv", "order_fact", "dim_region", "metric_top_products"} <= set(names)
    got = spark.sql("SELECT SUM(order_cnt) AS n FROM metric_gmv_by_region").first().n
    assert got == c.raw("orders").count()
    assert spark.sql("SELECT * FROM metric_top_products").count() == 10


def test_verification_returns_an_exit_status(house, capsys):
    c, _, built = house
    assert verify.run(built.spark, built.root, c.cfg) == 1
    assert "FAIL  headers match lines" in capsys.readouterr().out


def test_unmatched_places_drop_out_of_the_province_report(house):
    c, _, _ = house
    some = c.region().where("region_id <> 25")
    facts = c.order_core().join(c.users().select("user_id", "city"), "user_id").join(some.select("region_id", "city"), "city", "left").na.fill(0, ["region_id"])
    unknown = facts.where("region_id = 0").count()
    known = metrics.gmv_by_region(facts, some).agg(F.sum("order_cnt")).first()[0]
    assert unknown and known == facts.count() - unknown


def test_gaps_and_orphans_are_found(spark):
    orders = spark.createDataFrame([(1, "completed"), (2, "cancelled"), (3, "completed"), (4, "paid")], "order_id long, status string")
    events = spark.createDataFrame([(1, s) for s in ("created", "paid", "shipped", "completed")] + [(2, "created"), (3, "created")], "order_id long, to_status string").withColumn(
        "event_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert {r.order_id for r in quality.event_chain_gaps(orders, events).collect()} == {2, 3}
    items = spark.createDataFrame([(1,), (9,), (9,)], "order_id long")
    assert [tuple(r) for r in quality.orphan_items(items, orders).collect()] == [(9, 2)]


def test_inverted_and_open_promotion_periods(spark):
    facts = spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 1))], "order_id long, order_date date")
    periods = spark.createDataFrame([(1, Decimal("0.10"), date(2024, 1, 9), date(2024, 1, 1)), (2, Decimal("0.20"), date(2024, 1, 20), date(9999, 12, 31))],
                                    "promo_id int, discount_rate decimal(3,2), start_date date, end_date date")
    got = {r.order_id: r.range_promo_id for r in metrics.promo_by_date_range(facts, periods).collect()}
    assert got == {1: None, 2: 2}
