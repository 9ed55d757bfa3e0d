"""Every registered query against its oracle on the given tables."""

import pytest

import __spark_entry__ as contract
import oracle
from strataflow.catalog import ORACLES as SQL
from strataflow.catalog import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    pytest.importorskip("duckdb")
    return oracle.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


def test_the_contract_holds_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, sf_dir, duck):
    assert oracle.compare(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


ZONE_SENSITIVE = [
    "gmv_running_total", "range_filter_agg", "out_of_range_rows", "partitions_touched", "fulfilment_latency", "bucket_7d",
    "business_time", "csv_roundtrip", "stream_minute_gmv", "running_total_rows", "event_chain_gaps", "dim_date",
]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_the_session_zone(name, spark, sf_dir, duck):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert oracle.compare(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
