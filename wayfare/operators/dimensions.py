"""Dimensions and their history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.grid import as_of as last_before
from wayfare.functions.grid import neighbour
from wayfare.functions.timeutil import ntz
from wayfare.operators.identity import people
from wayfare.params import ANONYMOUS, CHANNELS, CUSTOMER, GRANTED

OPEN_END = "9999-12-31"


_CHANNEL_SCHEMA = (
    "channel_key string, source string, medium string, channel_display_name string, "
    "channel_group string, is_paid boolean, conversion_multiplier double"
)


def dim_channels(spark: SparkSession, seed: str | None = None) -> DataFrame:
    """The channel list: built in, or from a CSV file with a header line."""
    if seed is None:
        return spark.createDataFrame(CHANNELS, _CHANNEL_SCHEMA)
    return spark.read.schema(_CHANNEL_SCHEMA).option("header", True).csv(seed)


def dim_dates(bounds: DataFrame) -> DataFrame:
    """One row per day from `start_date` up to, not including, `end_date`."""
    days = bounds.select(
        F.explode(F.sequence("start_date", F.date_sub("end_date", 1))).alias("date_day")
    )
    iso = F.weekday("date_day") + 1
    return days.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day_of_month"),
        iso.alias("day_of_week_iso"),
        F.weekofyear("date_day").alias("iso_week"),
        F.quarter("date_day").alias("quarter"),
        (iso >= 6).alias("is_weekend"),
    )


def _person_attributes(customers: DataFrame, graph: DataFrame) -> DataFrame:
    """Customer rows under their person; the hash is kept only under a grant."""
    return customers.join(
        people(graph, CUSTOMER, "buyer"),
        F.col("shopify_customer_id").cast("string") == F.col("buyer"),
    ).withColumn(
        "email_hash", F.when(F.col("consent_status") == GRANTED, F.col("email_hash"))
    )


def dim_users(graph: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """One current row per person; only customer ids take part in the join."""
    known = _person_attributes(customers, graph).select(
        "unified_user_id", "email_hash", "country", "consent_status", "created_at"
    )
    everyone = graph.select("unified_user_id").unionByName(known, allowMissingColumns=True)
    return (
        everyone.groupBy("unified_user_id")
        .agg(
            F.max("email_hash").alias("email_hash"),
            F.max("country").alias("country"),
            # 'granted' outranks 'anonymous' alphabetically.
            F.max("consent_status").alias("consent_status"),
            F.min("created_at").alias("first_seen_at"),
        )
        .select(
            "unified_user_id",
            "email_hash",
            "country",
            F.coalesce("consent_status", F.lit(ANONYMOUS)).alias("consent_status"),
            F.coalesce("first_seen_at", ntz(as_of)).alias("valid_from"),
            F.lit(OPEN_END).cast("timestamp_ntz").alias("valid_to"),
            F.lit(True).alias("is_current"),
        )
    )


def dim_users_scd2(graph: DataFrame, versions: DataFrame) -> DataFrame:
    """Versions of a person, each valid from the instant at which hash or consent changed.

    Deliveries are first reduced to the last state of each instant, however often
    a record is redelivered; a delivery without an update time has no place in
    the history and is left out.
    """
    state = F.struct("created_at", "consent_status", "email_hash")
    states = (
        _person_attributes(versions, graph)
        .where(F.col("consent_updated_at").isNotNull())
        .groupBy("unified_user_id", F.col("consent_updated_at").alias("valid_from"))
        .agg(F.max(state).alias("s"))
        .select("unified_user_id", "valid_from", "s.email_hash", "s.consent_status")
    )
    current = F.struct("email_hash", "consent_status")
    before = neighbour(states, "unified_user_id", "valid_from", current, "before")
    changed = before.where(F.col("before").isNull() | ~F.col("before.value").eqNullSafe(current)).drop("before")
    until = F.col("until.value")
    return neighbour(changed, "unified_user_id", "valid_from", F.col("valid_from"), "until", ahead=True).select(
        "unified_user_id",
        "email_hash",
        "consent_status",
        "valid_from",
        F.coalesce(until, F.lit(OPEN_END).cast("timestamp_ntz")).alias("valid_to"),
        until.isNull().alias("is_current"),
    )


def facts_asof_user(facts: DataFrame, history: DataFrame) -> DataFrame:
    """Facts with the person's version valid at the fact's instant; NULL before the first.

    The distinct instants asked for are found on one axis with the versions,
    and facts take the answer by an equi-join: no fact meets more than one.
    """
    known = history.select(
        "unified_user_id",
        F.col("valid_from").alias("conversion_ts"),
        F.struct("email_hash", "consent_status", "valid_from").alias("version"),
    )
    asked = facts.where(F.col("unified_user_id").isNotNull() & F.col("conversion_ts").isNotNull())
    answers = last_before(asked, known, "unified_user_id", "conversion_ts", "version")
    return facts.join(answers, ["unified_user_id", "conversion_ts"], "left").select(
        "conversion_id",
        "conversion_ts",
        "unified_user_id",
        F.col("version.email_hash").alias("email_hash"),
        F.col("version.consent_status").alias("consent_status"),
        F.col("version.valid_from").alias("valid_from"),
    )
