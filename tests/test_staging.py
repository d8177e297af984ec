import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wayfare.operators import staging
from wayfare.sources.schemas import BRONZE


def test_missing_consent_counts_as_withdrawn(spark):
    df = spark.createDataFrame(
        [("granted",), ("anonymous",), ("withdrawn",), (None,)], "consent_status string"
    )
    assert {r[0] for r in staging.consented(df).collect()} == {"granted", "anonymous"}


@pytest.mark.parametrize(
    "medium, source, key",
    [
        ("cpc", "meta", "paid_social"),
        ("cpc", "tiktok", "paid_social_tt"),
        ("cpc", "google", "paid_search"),
        ("cpc", "bing", "direct"),
        ("CPC", "google", "direct"),
        ("organic", "bing", "organic_search"),
        ("email", None, "email"),
        ("display", "x", "display"),
        ("referral", "x", "referral"),
        ("social", "x", "social_organic"),
        ("none", "direct", "direct"),
        (None, None, "direct"),
    ],
)
def test_channel_rules(spark, medium, source, key):
    df = spark.createDataFrame([(medium, source)], "medium string, source string")
    assert df.select(staging.channel_key(F.col("medium"), F.col("source"))).first()[0] == key


def customer(i, updated, created, consent="granted", email="a@b.c"):
    return (i, email, None, None, True, updated, "BE", None, None, created, consent)


def test_latest_delivery_wins_then_latest_creation(spark):
    rows = [
        customer(1, "2023-01-01 00:00:00", "2022-01-01 00:00:00", email="old@x.y"),
        customer(1, "2023-02-01 00:00:00", "2021-01-01 00:00:00", email="new@x.y"),
        customer(2, "2023-01-01 00:00:00", "2022-01-01 00:00:00", consent="anonymous"),
        customer(2, "2023-01-01 00:00:00", "2022-01-02 00:00:00"),
        customer(3, "2023-01-01 00:00:00", "2022-01-01 00:00:00"),
        customer(3, "2023-09-01 00:00:00", "2022-01-01 00:00:00", consent="withdrawn"),
    ]
    got = staging.customers(spark.createDataFrame(rows, BRONZE["shopify_customers"])).collect()
    by_id = {r.shopify_customer_id: r for r in got}
    assert len(got) == 3
    assert by_id[1].consent_updated_at == datetime(2023, 2, 1)
    assert by_id[2].consent_status == "granted"
    # A withdrawn delivery is filtered before the choice, so the older one stays.
    assert by_id[3].consent_updated_at == datetime(2023, 1, 1)


def test_redeliveries_shrink_before_the_shuffle(spark):
    plan = (
        staging.customers(spark.createDataFrame([], BRONZE["shopify_customers"]))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_unknown_columns_do_not_reach_silver(spark):
    bronze = spark.createDataFrame([], BRONZE["email_events"]).withColumn("surprise", F.lit(1))
    assert "surprise" not in staging.email_events(bronze).columns


def test_an_order_delivered_again_counts_once(spark):
    day = lambda n: date(2024, 3, n)
    rows = [
        ("o1", 10.0, "granted", day(1)),
        ("o1", 12.0, "granted", day(3)),
        ("o1", 11.0, "granted", day(2)),
        ("o2", 5.0, "granted", day(1)),
        ("o2", 5.0, "granted", day(1)),
        ("o3", 7.0, "withdrawn", day(1)),
        (None, 1.0, "granted", day(1)),
        (None, 1.0, "granted", day(1)),
    ]
    bronze = spark.createDataFrame(
        [(o, 1, "a@b", "2024-03-01 10:00:00", p, "EUR", "paid", "f", "BE", c, d) for o, p, c, d in rows],
        "order_id string, customer_id long, email string, created_at string, total_price_eur double, currency string, "
        "financial_status string, fulfillment_status string, country string, consent_status string, dt date",
    )
    got = staging.orders(bronze)
    assert "dt" not in got.columns
    assert sorted(((r.order_id or "", r.total_price_eur) for r in got.collect())) == [("", 1.0), ("", 1.0), ("o1", 12.0), ("o2", 5.0)]


def test_orders_are_shuffled_with_the_hash_as_bytes(spark):
    """Ties are still decided by the hash's text, and the result holds that text."""
    mails = ["a@b", " A@c ", None, "d@e"]
    bronze = spark.createDataFrame(
        [("o1", 1, m, "2024-03-01 10:00:00", 1.0, "EUR", "paid", "f", "BE", "granted") for m in mails],
        "order_id string, customer_id long, email string, created_at string, total_price_eur double, currency string, "
        "financial_status string, fulfillment_status string, country string, consent_status string",
    )
    got = staging.orders(bronze)
    hashes = [hashlib.sha256(m.strip().lower().encode()).hexdigest() for m in mails if m]
    assert [r.email_hash for r in got.collect()] == [max(hashes)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window") :]
    assert "unhex" in below


@pytest.mark.parametrize("few", [0, 500_000])
def test_orders_delivered_once_go_round_the_sort(spark, monkeypatch, few):
    """With the repeated ids known only their rows are ranked, and the result stays the same."""
    monkeypatch.setattr(staging, "FEW_REPEATED", few)

    def delivered(rows):
        return spark.createDataFrame(
            [(o, k, "a@b", "2024-03-01 10:00:00", p, "EUR", "paid", "f", "BE", c) for o, k, p, c in rows],
            "order_id string, customer_id long, email string, created_at string, total_price_eur double, currency string, "
            "financial_status string, fulfillment_status string, country string, consent_status string",
        )

    once = [("o1", 1, 1.0, "granted"), ("o2", None, 2.0, "granted"), (None, 3, 3.0, "granted"), (None, 3, 3.0, "granted")]
    again = [("o1", 4, 5.0, "granted"), ("o1", 4, 0.5, "anonymous"), ("o2", 9, 9.0, "withdrawn")]
    for rows, repeated in ((once, 0), (once + again, 1)):
        bronze = delivered(rows)
        known = staging.repeated_orders(bronze).localCheckpoint()
        assert known.count() == repeated
        got, want = staging.orders(bronze, known), staging.orders(bronze)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("Window" in plan) == (repeated > 0)
