"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from strataflow.catalog import QUERIES
from strataflow.catalog.canon import Canon
from strataflow.plans import dims, facts
from strataflow.session import RUNTIME_SETTINGS, coarsely, tune
from strataflow.sinks import save_bucketed

WRITERS = {"csv_roundtrip", "strip_crlf", "federated_join", "load_verified", "partition_row_counts", "partitions_touched",
           "mv_equals_direct", "warehouse_rows", "warehouse_audit", "layout_saving", "codec_saving", "upsert_partitions", "views_sql"} | {n for n in QUERIES if n.startswith("stream_")}


@pytest.fixture(autouse=True)
def _coarse(spark):
    """No test begins with the 400 shuffle partitions that a query of the catalog before it has set for its session."""
    coarsely(spark)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_no_cross_join(name, spark, sf_dir):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, node


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = _plan(QUERIES["total_amount_sum"](spark, sf_dir))
    assert "ReadSchema: struct<o_totalprice:double>" in plan
    plan = _plan(QUERIES["range_filter_agg"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_top_k_is_not_a_global_sort(spark, sf_dir):
    for name in ("top_orders", "traffic_peak_minutes", "top_products"):
        assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, sf_dir))


def test_aggregates_combine_before_their_shuffle(spark, sf_dir):
    for name in ("daily_gmv", "minute_traffic", "user_purchase_stats", "product_daily_sales", "status_funnel"):
        assert "partial_" in _plan(QUERIES[name](spark, sf_dir))


def test_joins_on_order_id_share_one_partitioning(spark, sf_dir):
    """Every input of the order fact is shuffled by order_id once; none twice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(Canon(spark, sf_dir).order_fact())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_order = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(by_order) == 5, "orders, payments, events, lines, promoted orders"


SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def _skewed(spark):
    """600,000 lines and orders of which a third share one order, respectively one buyer."""
    rows = spark.range(0, 600_000, 1, 6)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    items = rows.select(
        (F.col("id") + 1).alias("item_id"), hot.alias("order_id"), (F.col("id") % 11).alias("product_id"), F.lit(1).alias("qty"),
        (F.col("id") % 90 + 1).cast("decimal(10,2)").alias("unit_price"))
    day = F.expr("TIMESTAMP_NTZ'2024-11-11 10:00:00'")
    parents = spark.range(5000).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("user_id"), day.alias("order_date"), F.lit("paid").alias("status"),
        F.lit(1).cast("decimal(12,2)").alias("total_amount"), F.lit(1).alias("promo_id"))
    many = rows.select(F.col("id").alias("order_id"), hot.alias("user_id"), day.alias("order_date"), F.lit("paid").alias("status"),
                       F.lit(1).cast("decimal(12,2)").alias("total_amount"), F.lit(1).alias("promo_id"))
    users = spark.range(5000).select(F.col("id").alias("user_id"), F.lit("深圳").alias("city"), F.lit("广东省").alias("province"))
    return items, parents, many, users


@pytest.mark.parametrize("case", ["discount", "detail", "region", "events"])
def test_hot_keys_are_split_in_joins(spark, case):
    """A third of the rows shares one join key: the join still spreads them, aggregated or not, with equal results."""
    items, parents, many, users = _skewed(spark)
    promo = Canon(spark, "").promotions()
    region = dims.dim_region(spark)
    events = items.select(F.col("item_id").alias("event_id"), "order_id", F.lit(None).cast("string").alias("from_status"),
                          F.lit("paid").alias("to_status"), F.expr("TIMESTAMP_NTZ'2024-11-11 10:00:00'").alias("event_time"),
                          F.lit("user").alias("operator_type"))

    def build():
        tune(spark)
        if case == "discount":
            return facts.order_discount(items, parents, promo)
        if case == "detail":
            return facts.detail_lines(items, parents, promo)
        if case == "region":
            return facts.with_region(facts.order_core(many), users, region)
        return facts.status_event_fact(events, parents)

    def run():
        whole = build()
        plan_of = whole.select(F.xxhash64(*whole.columns).alias("h"))
        rows = plan_of.collect()
        return (len(rows), sum(r.h for r in rows)), _plan(plan_of)

    before = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    for k, v in SMALL_PARTITIONS.items():
        spark.conf.set(k, v)
    try:
        split, plan = run()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    plain, _ = run()
    assert split == plain


def test_bucketed_tables_join_without_a_shuffle(spark):
    items, parents, _, _ = _skewed(spark)
    save_bucketed(items, "bucketed_items", "order_id", 4)
    save_bucketed(parents, "bucketed_orders", "order_id", 4, ["order_date"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_items").join(spark.table("bucketed_orders"), "order_id")
        assert "Exchange" not in _plan(joined) and joined.count() == 600_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_items", "bucketed_orders"):
            spark.sql(f"DROP TABLE {name}")


def test_tune_respects_submitted_settings(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    assert tune(spark).conf.get(key) == RUNTIME_SETTINGS[key]
