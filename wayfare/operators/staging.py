"""Bronze -> silver: consent filter, typed projection, pseudonyms, latest version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.keys import email_hash
from wayfare.functions.timeutil import from_epoch_seconds
from wayfare.params import CHANNEL_RULES, DEFAULT_CHANNEL, WITHDRAWN

# Repeated order ids up to which their rows are parted from all others: a few megabytes of hashes.
FEW_REPEATED = 500_000


def consented(df: DataFrame) -> DataFrame:
    """Drop withdrawn rows; a missing consent counts as withdrawn."""
    return df.where(F.col("consent_status") != WITHDRAWN)


def channel_key(medium: Column, source: Column) -> Column:
    """Ordered, case-sensitive rules; anything else, NULL included, is the default."""

    def add(chain, rule):
        rule_medium, rule_source, key = rule
        hit = medium == rule_medium
        if rule_source is not None:
            hit = hit & (source == rule_source)
        return F.when(hit, key) if chain is None else chain.when(hit, key)

    return reduce(add, CHANNEL_RULES, None).otherwise(DEFAULT_CHANNEL)


def web_events(bronze: DataFrame) -> DataFrame:
    return consented(bronze).select(
        "event_id",
        "event_name",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        "ga_client_id",
        "ga_user_id",
        "ga_session_id",
        "page_location",
        "page_title",
        "device_category",
        "country",
        F.col("source").alias("utm_source"),
        F.col("medium").alias("utm_medium"),
        F.col("campaign").alias("utm_campaign"),
        F.col("item_id").alias("item_sku"),
        "value_eur",
        "consent_status",
        channel_key(F.col("medium"), F.col("source")).alias("channel_key"),
    )


def pixel_events(bronze: DataFrame) -> DataFrame:
    return consented(bronze).select(
        "event_id",
        "event_name",
        from_epoch_seconds(F.col("event_time")).alias("event_ts"),
        "fbp",
        "fbc",
        F.col("em_hash").alias("email_hash"),
        F.col("ph_hash").alias("phone_hash"),
        F.col("client_ip_prefix").alias("ip_prefix"),
        F.col("client_user_agent").alias("user_agent"),
        "action_source",
        "currency",
        F.col("value").cast("double").alias("value_eur"),
        "content_ids",
        "consent_status",
        F.lit("paid_social").alias("channel_key"),
    )


def email_events(bronze: DataFrame) -> DataFrame:
    return consented(bronze).select(
        "event_id",
        "event_name",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        "campaign_id",
        "subscriber_id",
        "email_hash",
        F.col("url").alias("click_url"),
        "consent_status",
        F.lit("email").alias("channel_key"),
    )


def _order_key() -> Column:
    return F.when(F.col("order_id").isNotNull(), F.xxhash64("order_id"))


def repeated_orders(bronze: DataFrame) -> DataFrame:
    """`(order_key)`: hashes of the order ids with several consented deliveries; ids that share one are among them."""
    keys = consented(bronze).where(F.col("order_id").isNotNull()).select(_order_key().alias("order_key"))
    return keys.groupBy("order_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("order_key")


def orders(bronze: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The latest consented delivery per order, as for customers.

    Shops deliver the same order again on later days, often corrected. The
    delivery day `dt` decides where the table has one; the trailing sort keys
    make the choice total. Orders without an id are all kept. The e-mail's hash
    is shuffled as 32 bytes, which sort like its 64 hexadecimal digits.

    Given the stored `repeated_orders`, all other rows are the latest as they
    are and go round the sort, as long as up to `FEW_REPEATED` ids are repeated.
    """
    delivered = F.col("dt") if "dt" in bronze.columns else F.lit(None).cast("date")
    rows = consented(bronze).select(
        delivered.alias("_delivered"),
        "order_id",
        F.col("customer_id").alias("shopify_customer_id"),
        F.unhex(email_hash(F.col("email"))).alias("email_hash"),
        F.col("created_at").cast("timestamp_ntz").alias("order_ts"),
        F.col("total_price_eur").cast("double").alias("total_price_eur"),
        "currency",
        "financial_status",
        "fulfillment_status",
        "country",
        "consent_status",
    )
    newest = Window.partitionBy("order_id").orderBy(
        *[
            F.desc_nulls_last(c)
            for c in [
                "_delivered", "order_ts", "total_price_eur", "financial_status", "fulfillment_status",
                "email_hash", "shopify_customer_id", "currency", "country", "consent_status",
            ]
        ]
    )

    def latest(some: DataFrame) -> DataFrame:
        return some.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") == 1).drop("_rn")

    named, nameless = rows.where(F.col("order_id").isNotNull()), rows.where(F.col("order_id").isNull())
    times = None if repeated is None else repeated.count()
    if times == 0:
        kept = rows
    elif times is None or times > FEW_REPEATED:
        kept = latest(named).unionByName(nameless)
    else:
        several = _order_key() == F.col("order_key")
        once = rows.join(repeated, several, "left_anti")
        kept = latest(named.join(repeated, several, "left_semi")).unionByName(once)
    kept = kept.drop("_delivered")
    return kept.withColumn("email_hash", F.lower(F.hex("email_hash")))


def customer_versions(bronze: DataFrame) -> DataFrame:
    """Every consented delivery of every customer, typed."""
    return consented(bronze).select(
        F.col("customer_id").alias("shopify_customer_id"),
        email_hash(F.col("email")).alias("email_hash"),
        "first_name",
        "last_name",
        "accepts_marketing",
        F.col("accepts_marketing_updated_at").cast("timestamp_ntz").alias("consent_updated_at"),
        "country",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "consent_status",
    )


def customers(bronze: DataFrame) -> DataFrame:
    """The latest delivery per customer.

    `row_number() = 1` plans as a group limit before and after the shuffle: each
    map task sends at most one row per customer, however often it was delivered.
    The trailing sort keys make the choice total.
    """
    versions = customer_versions(bronze)
    newest = Window.partitionBy("shopify_customer_id").orderBy(
        F.desc_nulls_last("consent_updated_at"),
        F.desc_nulls_last("created_at"),
        F.desc_nulls_last("email_hash"),
        F.desc_nulls_last("consent_status"),
        F.desc_nulls_last("country"),
    )
    return (
        versions.withColumn("_rn", F.row_number().over(newest))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )
