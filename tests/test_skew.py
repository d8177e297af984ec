"""A key with a third of the rows is divided among tasks wherever rows meet a table."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.functions.grid import in_blocks, running_sums
from wayfare.operators import dimensions, privacy, sessions, touchpoints
from wayfare.sources import bronze
from wayfare.sources.schemas import BRONZE

N = 9000
START = datetime(2024, 1, 1)
GRAPH = "raw_id string, raw_source string, raw_value string, unified_user_id string"


def ids(spark):
    """`i`, and `k`: 'hot' for a third of the rows, else one of many keys."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3000))
    return spark.range(0, N, 1, 12).select(F.col("id").alias("i"), key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def graph(spark, source):
    keys = ids(spark).select("k").distinct().repartition(4)
    return keys.select(
        F.concat(F.lit(source + ":"), "k").alias("raw_id"), F.lit(source).alias("raw_source"),
        F.col("k").alias("raw_value"), F.md5("k").alias("unified_user_id"),
    )


def final_plan(df):
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def at(seconds):
    return F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def web(spark, hot_minute):
    seconds = F.col("i") * 60
    if hot_minute:
        seconds = F.when(F.col("k") == "hot", F.col("i") % 60).otherwise(seconds)
    return ids(spark).select(
        F.col("pad").alias("event_id"), at(seconds).alias("event_ts"), F.lit("page_view").alias("event_name"),
        F.lit("direct").alias("channel_key"), F.lit("/").alias("page_location"), F.lit(None).cast("string").alias("item_sku"),
        F.lit(1.0).alias("value_eur"), F.lit("BE").alias("country"), F.lit("m").alias("device_category"), F.col("k").alias("ga_client_id"),
    )


def case_touches(spark):
    none = web(spark, False).where("false")
    pixel = none.withColumn("fbp", F.lit("")).withColumn("event_name", F.lit(""))
    email = none.withColumn("subscriber_id", F.lit(""))
    return touchpoints.all_touches(web(spark, False), pixel, email, graph(spark, "ga_client"))


def case_buyers(spark):
    orders = ids(spark).select(F.col("pad").alias("order_id"), F.col("k").alias("shopify_customer_id"))
    return touchpoints.with_buyer(orders, graph(spark, "shopify_customer"), "left")


def case_session_of_a_hot_minute(spark):
    return sessions.sessions_stitched(web(spark, True), graph(spark, "ga_client"), 30)


def case_erasure(spark):
    facts = ids(spark).select(F.col("k").alias("unified_user_id"), "pad")
    gone = spark.range(0, 2000, 1, 4).select(F.concat(F.lit("gone"), "id").alias("unified_user_id"))
    return privacy.erase(facts, gone)


def case_unsubscribed(spark):
    events = ids(spark).select(
        F.col("pad").alias("event_id"), F.lit("campaign.sent").alias("event_name"),
        F.lit("2015-01-01 00:00:00").alias("event_ts"), F.lit("c").alias("campaign_id"),
        F.col("k").alias("subscriber_id"), F.lit("h").alias("email_hash"), F.lit(None).cast("string").alias("url"),
        F.lit("granted").alias("consent_status"),
    )
    left = spark.createDataFrame(
        [(f"u{i}", "campaign.unsubscribed", "2015-01-01 00:00:00", "c", f"gone{i}", "h", None, "granted") for i in range(2000)],
        BRONZE["email_events"],
    )
    return bronze.retained_email(events.unionByName(left), date(2024, 1, 1))


def case_version_of_a_hot_day(spark):
    facts = ids(spark).select(
        F.col("pad").alias("conversion_id"), F.col("k").alias("unified_user_id"),
        at(F.floor(F.col("i") / (N / 2)) * 86400).alias("conversion_ts"),
    )
    history = ids(spark).select("k").distinct().select(
        F.col("k").alias("unified_user_id"), F.lit("h").alias("email_hash"), F.lit("granted").alias("consent_status"),
        F.lit(START - timedelta(days=3)).cast("timestamp_ntz").alias("valid_from"),
    )
    return dimensions.facts_asof_user(facts, history)


CASES = [
    case_touches, case_buyers, case_session_of_a_hot_minute, case_erasure, case_unsubscribed, case_version_of_a_hot_day,
]


@pytest.mark.parametrize("case", CASES)
def test_hot_key_is_split(spark, tiny_skew_limits, case):
    rows, plan = final_plan(case(spark))
    assert rows == N
    assert "skew=true" in plan


@pytest.mark.parametrize("spread", [1, 40])
def test_a_full_minute_is_cut_into_blocks(spark, spread):
    """A third of all rows in one minute, at one instant or spread over it; windows stay small, sums the same."""
    rows = ids(spark).select(
        "k", F.col("pad").alias("id"), (F.col("i") % 5).alias("x"),
        at(F.when(F.col("k") == "hot", F.col("i") % spread).otherwise(F.col("i") * 50)).alias("ts"),
    )
    order, measures = ["ts", "id"], {"n": F.lit(1), "total": F.col("x")}
    plain = running_sums(rows, "k", "ts", order, measures, full=N)
    cut = running_sums(rows, "k", "ts", order, measures, full=200)
    assert sorted(cut.collect()) == sorted(plain.collect())
    hot = in_blocks(rows.withColumn("_slot", F.minute("ts")), "k", order, 200).where("k = 'hot'")
    sizes = [r["count"] for r in hot.groupBy("_slot", "_block").count().collect()]
    assert sum(sizes) == N // 3 and max(sizes) <= 4 * 200
