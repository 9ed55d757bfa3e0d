"""End-to-end build: clean, land, conform, aggregate, verify.

Each layer is written once and the next one reads the written table.  That cuts
the lineage at every layer, so losing an executor costs tasks of the current
layer only, and re-running the whole build replaces every table it owns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.functions import safe_ratio
from strataflow.operators import quality as q
from strataflow.operators.clean import CLEAN_RULES, clean, is_complete
from strataflow.plans import aggregates, dims, facts, metrics
from strataflow.sinks import (
    AuditLog,
    dedupe_stored,
    load_many,
    load_verified,
    refresh,
    save_bucketed,
    stamp_sync_time,
    with_month,
)
from strataflow.session import finely, settle, tidily

# Partition timestamp and sort key of each landed table; None means unpartitioned.
LANDING_LAYOUT: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "users": (None, ("user_id",)),
    "products": (None, ("product_id",)),
    "orders": ("order_date", ("order_date", "order_id")),
    "order_items": (None, ("order_id", "item_id")),
    "payments": ("pay_date", ("pay_date", "payment_id")),
    "order_status_events": ("event_time", ("event_time", "event_id")),
}


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def aggregate(self, name: str) -> DataFrame:
        return self.read("dws", name)


def _stage(house: Warehouse, sources: Mapping[str, DataFrame]) -> int:
    """One read of the operational system; everything after works on the copy."""
    return sum(load_many({n: (df, house.path("stage", n), {}) for n, df in sources.items()}).values())


def _land(house: Warehouse, sources: Mapping[str, DataFrame], seen: dict[str, Observation]) -> int:
    """Cleaned sources, one row per business key, in their storage layout.

    ``seen`` receives, per table, how many rows came in and how many were complete, counted by the search for repeated keys.
    """
    def landing(name: str, df: DataFrame) -> tuple[DataFrame, str, dict]:
        ts, order = LANDING_LAYOUT[name]
        seen[name], keys = Observation(), schemas.KEYS[name]
        counted = df.observe(seen[name], F.count(F.lit(1)).alias("rows"), F.count_if(is_complete(CLEAN_RULES[name])).alias("kept"))
        rows = dedupe_stored(clean(df, CLEAN_RULES[name]), keys, counted=clean(counted, CLEAN_RULES[name]))
        stamped = stamp_sync_time(rows, rows.columns)
        if ts is None:
            # The copy's splits are of one size already; what keeps the order of the source needs no shuffle.
            return stamped, house.path("ods", name), {"sort": order}
        return with_month(stamped, ts), house.path("ods", name), {"part": "ym", "sort": order}

    return sum(load_many({name: landing(name, df) for name, df in sources.items()}).values())


def _conform(house: Warehouse, region: DataFrame, promotion: DataFrame) -> int:
    tables = {
        "dim_product": dims.dim_product(house.read("ods", "products")),
        "dim_user": dims.dim_user(house.read("ods", "users")),
        "dim_region": region,
        "dim_promotion": promotion,
    }
    rows = refresh(house.spark, tables, f"{house.root}/dim")
    bounds = house.read("ods", "orders").agg(
        F.to_date(F.min("order_date")).alias("first_day"), F.to_date(F.max("order_date")).alias("last_day")
    )
    calendar = dims.dim_date(bounds, "first_day", "last_day")
    return sum(rows.values()) + load_verified(calendar, house.path("dim", "dim_date"))


def _facts(house: Warehouse) -> dict[str, tuple[DataFrame, str, tuple[str, ...]]]:
    ods = {name: house.read("ods", name).drop("ym", "sync_time") for name in LANDING_LAYOUT}
    region, promotion = house.read("dim", "dim_region"), house.read("dim", "dim_promotion")
    return {
        "order_fact": (
            facts.order_fact(
                ods["orders"], ods["users"], region, ods["payments"], ods["order_status_events"],
                ods["order_items"], promotion,
            ),
            "order_date", ("order_date", "order_id"),
        ),
        "order_detail_fact": (
            facts.order_detail_fact(ods["order_items"], ods["orders"], ods["users"], region, promotion, with_status=True),
            "order_date", ("order_date", "order_id", "detail_id"),
        ),
        "order_status_event_fact": (
            facts.status_event_fact(ods["order_status_events"], ods["orders"]),
            "event_date", ("event_date", "event_id"),
        ),
    }


BUCKET_ROWS = 500_000


def bucket_facts(house: Warehouse, buckets: int, prefix: str = "") -> dict[str, str]:
    """Both order facts as catalog tables bucketed and sorted by the order: name -> table.  Joins of the two on the order shuffle neither.

    There are ``buckets`` at least, and so many that the lines of one stay about ``BUCKET_ROWS``, which a task sorts in memory.

    For orders with lines of similar numbers; an order that holds a large share of all lines is better joined from the plain facts, where
    adaptive execution splits it.
    """
    tables, lines = {}, house.read("dwd", "order_detail_fact").count()
    buckets = max(buckets, -(-lines // BUCKET_ROWS))
    with tidily(house.spark):
        for name, order in (("order_fact", ("order_date",)), ("order_detail_fact", ("detail_id",))):
            tables[name] = f"{prefix}{name}"
            save_bucketed(house.read("dwd", name).drop("ym"), tables[name], "order_id", buckets, order, house.path("bucketed", name))
    return tables


def verification(house: Warehouse, cfg: WarehouseConfig = DEFAULT, audit: DataFrame | None = None) -> DataFrame:
    """The data-quality suite over the built tables: (check_name, observed, passed)."""
    orders, details, events = (
        house.read("dwd", n) for n in ("order_fact", "order_detail_fact", "order_status_event_fact")
    )
    products, region = house.read("dim", "dim_product"), house.read("dim", "dim_region")
    agg = house.aggregate
    daily, minutes, users = agg("daily_gmv"), agg("minute_traffic"), agg("user_purchase_stats")
    running = metrics.gmv_running_total(minutes, cfg.focus_day)
    # One pass over the order fact for all checks that need no grouping, one by day, one by key.
    whole = settle(orders.agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("region_id") != 0).alias("matched"),
        F.count_if(F.col("order_date") != F.to_date("order_time")).alias("misdated"),
        F.sum(F.when(F.col("status").isin(*cfg.valid_statuses), F.col("total_amount"))).alias("valid_amount"),
    ), "order-totals")
    sizes = whole.select(
        "*", details.agg(F.count(F.lit(1))).scalar().alias("details"), events.agg(F.count(F.lit(1))).scalar().alias("events"),
        house.read("ods", "orders").agg(F.count(F.lit(1))).scalar().alias("landed"), daily.agg(F.sum("gmv")).scalar().alias("daily_amount"))
    per_order = lambda name: F.max(safe_ratio(F.col(name), F.col("orders")))
    span = F.datediff(F.max("dt"), F.min("dt")) + 1
    days = settle(q.per_day_counts(orders, "order_date"), "orders-by-day")
    shares = metrics.category_share(agg("product_daily_sales"), products)
    results = [
        q.evaluate(daily, [
            q.expect("daily series has no missing day", F.count(F.lit(1)) - span, lambda v: v == 0),
            q.expect("focus day above 2x the average amount",
                     safe_ratio(F.sum(F.when(F.to_date("dt") == F.lit(cfg.focus_day), F.col("gmv"))), F.avg(F.col("gmv").cast("double"))),
                     lambda v: v > 2),
        ]),
        q.evaluate(metrics.top_products(agg("product_daily_sales"), products, cfg), [q.expect_count("top products", cfg.top_products)]),
        q.evaluate(shares, [q.expect_sum("category shares total 100", F.col("pct"), 100, 0.2)]),
        q.evaluate(metrics.user_repurchase(users), [q.expect_min("repurchase rate", F.min("repurchase_rate"), cfg.min_repurchase_rate)]),
        q.evaluate(metrics.gmv_by_region(orders, region), [q.expect_min_count("provinces", 5)]),
        q.evaluate(agg("promo_daily_compare"), [q.expect("both periods have amounts", F.count_if(F.col("gmv") > 0), lambda v: v == 2)]),
        q.evaluate(metrics.user_segment(users, cfg), [q.expect_count("segments", 3)]),
        q.evaluate(sizes, [
            q.expect("every landed order is a fact", F.max(safe_ratio(F.col("orders"), F.col("landed"))), lambda v: v == 1),
            q.expect_between("items per order", per_order("details"), cfg.min_item_ratio, cfg.max_item_ratio),
            q.expect_min("events at least orders", per_order("events"), 1),
            q.expect("order day matches order time", F.max("misdated"), lambda v: v == 0),
            q.expect("region match rate", F.max(safe_ratio(F.col("matched"), F.col("orders"), 100)), lambda v: v == 100),
            q.expect("only valid orders in the daily amount", F.max(F.col("daily_amount") - F.col("valid_amount")), lambda v: v == 0),
        ]),
        q.evaluate(days, [q.expect_min("focus day burst", q.burst(days, "day", "n", cfg.focus_day), cfg.min_burst_ratio)]),
        q.evaluate(q.items_per_order(details), [q.expect("items per order vary", F.max("item_count") - F.min("item_count"), lambda v: v > 0)]),
        q.evaluate(products, [q.expect_no_violation("product dimension", F.col("product_name").isNull() | F.col("category").isNull() | (F.col("price") <= 0))]),
        q.evaluate(q.reconcile_amounts(orders, details, cfg), [q.expect_count("headers match lines", 0)]),
        q.evaluate(minutes, [q.expect_min_count("minute series", 1)]),
        q.evaluate(running, [q.expect_min_count("running series", 1)]),
        q.evaluate(q.running_violations(running), [q.expect_count("running amount never falls", 0)]),
        q.expect_unique("one fact per order", orders, ["order_id"]),
    ]
    if audit is not None:
        results.append(q.evaluate(audit, [q.expect_min_count("audit entries", 7)]))
    return q.suite(results)


class VerificationFailed(RuntimeError):
    pass


def build(
    spark: SparkSession, sources: Mapping[str, DataFrame], root: str, region: DataFrame, promotion: DataFrame,
    cfg: WarehouseConfig = DEFAULT, verify: bool = True, stage: bool = True,
) -> Warehouse:
    """Build or rebuild the warehouse under ``root`` from the six source tables.

    ``stage`` copies the sources first, so that a database is read once; leave it
    out where the sources are columnar files already.  Every step is audited,
    failures too; failed checks raise after their verdicts are stored.
    """
    finely(spark)
    house = Warehouse(spark, root)
    log = AuditLog(spark, house.path("audit", "etl_log"))
    with tidily(spark):
        if stage:
            extracted = sources
            log.step("extract", lambda: _stage(house, extracted))
            sources = {name: spark.read.schema(df.schema).parquet(house.path("stage", name)) for name, df in sources.items()}

        seen: dict[str, Observation] = {}
        log.step("load_ods", lambda: _land(house, sources, seen))

        def report_cleaning() -> tuple[int, str]:
            """What the load kept and dropped, without another scan."""
            report = [(name, int(o.get["kept"]), int(o.get["rows"]) - int(o.get["kept"])) for name, o in sorted(seen.items())]
            load_verified(spark.createDataFrame(report, "table_name string, kept long, dropped long"), house.path("audit", "clean_report"))
            dropped = ", ".join(f"{name} {lost}" for name, _, lost in report if lost)
            return sum(kept for _, kept, _ in report), f"dropped: {dropped}" if dropped else ""

        log.step("transform", report_cleaning)
        log.step("load_dim", lambda: _conform(house, region, promotion))
        for name, (frame, day, order) in _facts(house).items():
            log.step(name, lambda f=frame, n=name, d=day, o=order: load_verified(with_month(f, d), house.path("dwd", n), "ym", o))

        def refresh_all() -> int:
            built = aggregates.build_all(
                *[house.read("dwd", n) for n in ("order_fact", "order_detail_fact", "order_status_event_fact")], cfg
            )
            return sum(refresh(spark, built, f"{root}/dws").values())

        log.step("refresh_dws", refresh_all)
        if verify:
            def run_checks() -> int:
                audit = spark.read.parquet(log.path).where(F.col("run_id") == log.run_id)
                rows = load_verified(verification(house, cfg, audit), house.path("audit", "verification"))
                verdict = q.summary(house.read("audit", "verification")).first()
                if not verdict["all_passed"]:
                    raise VerificationFailed(f"{verdict['passed']} of {verdict['total']} checks passed")
                return rows

            log.step("verify", run_checks)
    return house
