"""Touchpoints, conversions and the interval join between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.keys import node_id
from wayfare.functions.timeutil import day_number
from wayfare.operators.identity import people
from wayfare.params import CUSTOMER, PIXEL_COOKIE, SUBSCRIBER, WEB_COOKIE
from wayfare.session import new_run_dir, store


def all_touches(
    web: DataFrame, pixel: DataFrame, email: DataFrame, graph: DataFrame
) -> DataFrame:
    """Every event of a known person that may have led to a purchase.

    The three sources are united first and meet the graph in one join.
    """

    def touches(df: DataFrame, source: str, prefix: str, value: str) -> DataFrame:
        return df.select(
            F.col("event_id").alias("touchpoint_id"),
            F.col("event_ts").alias("touchpoint_ts"),
            F.lit(source).alias("source"),
            "channel_key",
            node_id(prefix, F.col(value)).alias("raw_id"),
        )

    united = (
        touches(web.where(F.col("event_name") != "purchase"), "ga4", WEB_COOKIE, "ga_client_id")
        .unionByName(
            touches(pixel.where(F.col("event_name") != "Purchase"), "meta", PIXEL_COOKIE, "fbp")
        )
        .unionByName(
            touches(
                email.where(F.col("event_name") == "campaign.clicked"),
                "email",
                SUBSCRIBER,
                "subscriber_id",
            )
        )
    )
    ids = graph.where(F.col("raw_source").isin(WEB_COOKIE, PIXEL_COOKIE, SUBSCRIBER)).select(
        "raw_id", "unified_user_id"
    )
    return united.join(ids, "raw_id").drop("raw_id")


def buyer_orders(orders: DataFrame, graph: DataFrame) -> DataFrame:
    """What the facts ask of an order, and its buyer, NULL where nobody is known."""
    return with_buyer(orders, graph, "left").select(
        "order_id", "order_ts", "country", "total_price_eur", "unified_user_id"
    )


def conversions(orders_with_buyer: DataFrame) -> DataFrame:
    """Orders of known people."""
    return orders_with_buyer.where(F.col("unified_user_id").isNotNull()).select(
        F.col("order_id").alias("conversion_id"),
        F.col("order_ts").alias("conversion_ts"),
        F.col("total_price_eur").alias("conversion_value_eur"),
        "unified_user_id",
    )


def with_buyer(orders: DataFrame, graph: DataFrame, how: str) -> DataFrame:
    buyers = people(graph, CUSTOMER, "buyer")
    return orders.join(buyers, F.col("shopify_customer_id").cast("string") == F.col("buyer"), how).drop(
        "buyer"
    )


def of_both(touches: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The touches and conversions of people who have both: nobody else's can meet.

    People are compared by a hash, which keeps a few more at worst. The hashes
    are written once, so that the engine knows their size when it plans the joins.
    """
    spark, person = touches.sparkSession, F.xxhash64("unified_user_id")
    buyers = convs.select(person.alias("_person")).distinct()
    touched = touches.select(person.alias("_person")).distinct()
    both = store(touched.join(buyers, "_person", "left_semi"), f"{new_run_dir(spark, 'people')}/both")
    kept = [df.withColumn("_person", person).join(both, "_person", "left_semi").drop("_person") for df in (touches, convs)]
    return kept[0], kept[1]


def window_buckets(day: Column, window_days: int) -> Column:
    """The buckets, each one window wide, that a conversion on `day` can reach back into."""
    width = window_days + 1
    return F.array_distinct(
        F.array(F.floor((day - window_days) / width), F.floor(day / width))
    )


def in_window_pairs(
    touches: DataFrame, convs: DataFrame, window_days: int, matches: Column
) -> DataFrame:
    """Equi-join on (person, time bucket) with `matches` as the residual condition.

    A touch sits in one bucket and a conversion in at most two, so each pair
    meets exactly once; a long or hot history is cut by time, and what skew
    remains adaptive execution splits. The pairs themselves are the result:
    they are streamed on and never regrouped here.
    """
    left = touches.withColumn("_day", day_number(F.col("touchpoint_ts"))).withColumn(
        "_bucket", F.floor(F.col("_day") / (window_days + 1))
    )
    right = (
        convs.withColumnRenamed("unified_user_id", "_buyer")
        .withColumn("_conv_day", day_number(F.col("conversion_ts")))
        .withColumn("_conv_bucket", F.explode(window_buckets(F.col("_conv_day"), window_days)))
    )
    return left.join(
        right,
        (F.col("unified_user_id") == F.col("_buyer"))
        & (F.col("_bucket") == F.col("_conv_bucket"))
        & matches,
    ).drop("_day", "_bucket", "_buyer", "_conv_day", "_conv_bucket")


def touchpoints_enriched(touches: DataFrame, convs: DataFrame, window_days: int) -> DataFrame:
    """Touch x conversion: strictly before it, and at most `window_days` calendar days."""
    before = (F.col("touchpoint_ts") < F.col("conversion_ts")) & (
        F.col("_conv_day") - F.col("_day") <= window_days
    )
    return in_window_pairs(*of_both(touches, convs), window_days, before).select(
        "touchpoint_id",
        "touchpoint_ts",
        "source",
        "channel_key",
        "unified_user_id",
        "conversion_id",
        "conversion_ts",
        "conversion_value_eur",
    )


def touchpoint_facts(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "touchpoint_id",
        "touchpoint_ts",
        F.col("touchpoint_ts").cast("date").alias("touchpoint_date"),
        "source",
        "channel_key",
        "unified_user_id",
        "conversion_id",
        "conversion_ts",
        "conversion_value_eur",
    )
