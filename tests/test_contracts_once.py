from datetime import datetime

import pytest

from wayfare.params import Params
from wayfare.plans import contracts
from wayfare.plans.warehouse import Warehouse
from wayfare.sources.testbed import bronze_sql

DAY = datetime(2024, 1, 5)


@pytest.fixture()
def bronze(spark):
    events = [(i, DAY.replace(hour=i % 20), 3 * (i % 4), ("view", "click", "purchase")[i % 3], 1.0 * i, None) for i in range(60)]
    tables = {
        "events": spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "customer": spark.createDataFrame([(3 * i, f"c{i}", i, 1.0) for i in range(4)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
        "orders": spark.createDataFrame([(i, 3 * (i % 5), "F", 2.0) for i in range(30)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"),
    }
    texts = bronze_sql("spark")
    out = {}
    for name in ("ga4_events", "meta_pixel_events", "email_events", "shopify_customers", "shopify_orders"):
        table = next(t for t in tables if f"FROM {t}" in texts[name])
        out[name] = spark.sql(texts[name].replace(f"FROM {table}", "FROM {" + table + "}"), **{table: tables[table]})
    return out


def seen(df):
    return sorted((r.table_name, r.column_name, r.observed, r.passed) for r in df.collect())


@pytest.mark.parametrize("check", ["check_accepted_values", "check_unique_combination", "check_not_null"])
def test_a_check_writes_no_table_that_it_reads_once(spark, bronze, tmp_path, check):
    run = getattr(contracts, check)
    w = Warehouse(spark, bronze, Params(as_of=DAY), str(tmp_path / "fresh"))
    got = seen(run(w))
    assert not any(map(w.is_stored, ("fct_touchpoints", "fct_sessions", "fct_conversions", "dim_users")))
    # Several tables of check_not_null come from the summary.
    assert w.is_stored("session_summary") == (check == "check_not_null")

    built = Warehouse(spark, bronze, Params(as_of=DAY), str(tmp_path / "built"))
    built.publish_marts()
    assert got == seen(run(built))
