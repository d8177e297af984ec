"""Session stitching and the funnel.

A gap is counted in minute boundaries, so all events of a person within one
minute share a session whatever their number: sessions are numbered once per
(person, minute) and looked up from there (see functions/grid.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.timeutil import minute_number, seconds_between
from wayfare.operators.identity import people
from wayfare.params import FUNNEL_COUNTS, FUNNEL_STEPS, WEB_COOKIE


# Slot of events without a time: one trailing session per person.
_UNTIMED = 9999 * 366 * 1440


def events_with_user(web: DataFrame, graph: DataFrame) -> DataFrame:
    return web.join(people(graph, WEB_COOKIE, "ga_client_id"), "ga_client_id", "left")


def _slot() -> Column:
    return F.coalesce(minute_number(F.col("event_ts")), F.lit(_UNTIMED))


def _session_lookup(web: DataFrame, graph: DataFrame, timeout: int, known_only: bool) -> DataFrame:
    """(cookie, minute) -> person, session number, gap, and the minute's first event."""
    by_cookie = (
        web.select("ga_client_id", "event_ts", "event_id", _slot().alias("slot"))
        .groupBy("ga_client_id", "slot")
        .agg(F.min(F.struct("event_ts", "event_id")).alias("opening"))
    )
    cookies = people(graph, WEB_COOKIE, "ga_client_id")
    person = F.col("unified_user_id")
    if known_only:
        owned = by_cookie.join(cookies, "ga_client_id").withColumn("owner", person)
    else:
        owned = by_cookie.join(cookies, "ga_client_id", "left").withColumn(
            "owner", F.coalesce(person, F.col("ga_client_id"))
        )

    in_order = Window.partitionBy("owner").orderBy("slot")
    gap = F.col("slot") - F.lag("slot").over(in_order)
    numbered = (
        owned.groupBy("owner", "slot")
        .agg(F.min("opening").alias("owner_opening"))
        .withColumn("gap", gap)
        .withColumn("starts", F.when(F.col("gap") <= timeout, 0).otherwise(1))
        .select(
            F.col("owner").alias("n_owner"),
            F.col("slot").alias("n_slot"),
            "gap",
            "starts",
            "owner_opening",
            F.sum("starts")
            .over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            .cast("long")
            .alias("stitched_session_id"),
        )
    )
    return owned.join(
        numbered,
        _same("owner", "n_owner", known_only) & (F.col("slot") == F.col("n_slot")),
    ).select(
        F.col("ga_client_id").alias("l_cookie"),
        F.col("slot").alias("l_slot"),
        "unified_user_id",
        "stitched_session_id",
        "gap",
        "starts",
        "owner_opening",
    )


def _same(a: str, b: str, never_null: bool) -> Column:
    return F.col(a) == F.col(b) if never_null else F.col(a).eqNullSafe(F.col(b))


def _with_lookup(web: DataFrame, graph: DataFrame, timeout: int, known_only: bool) -> DataFrame:
    """Events with their session: the wide rows are shuffled once, by (cookie, minute)."""
    found = _session_lookup(web, graph, timeout, known_only)
    return web.withColumn("slot", _slot()).join(
        found,
        _same("ga_client_id", "l_cookie", known_only) & (F.col("slot") == F.col("l_slot")),
    )


def session_gaps(web: DataFrame, graph: DataFrame, timeout: int) -> DataFrame:
    """Minutes since the person's previous event, and whether a session starts."""
    opens = (F.col("event_ts") == F.col("owner_opening.event_ts")) & (
        F.col("event_id") == F.col("owner_opening.event_id")
    )
    return _with_lookup(web, graph, timeout, known_only=False).select(
        "event_id",
        "event_ts",
        "unified_user_id",
        F.when(opens, F.col("gap")).otherwise(F.lit(0)).cast("long").alias("mins_since_prev"),
        F.when(opens, F.col("starts")).otherwise(F.lit(0)).cast("int").alias("is_new_session"),
    )


def sessions_stitched(
    web: DataFrame, graph: DataFrame, timeout: int, known_only: bool = False
) -> DataFrame:
    """Events with person and per-person session number.

    Events of unknown people are numbered per cookie. `known_only` leaves them
    out before any shuffle, which is what every mart wants.
    """
    return _with_lookup(web, graph, timeout, known_only).select(
        "event_id",
        "event_ts",
        "event_name",
        "channel_key",
        "page_location",
        "item_sku",
        "value_eur",
        "country",
        "device_category",
        "ga_client_id",
        "unified_user_id",
        "stitched_session_id",
    )


def _reached(event: str) -> Column:
    return F.max(F.when(F.col("event_name") == event, 1).otherwise(0))


def session_summary(stitched: DataFrame) -> DataFrame:
    """One row per session of a known person: its measures and its funnel flags.

    The session facts, the per-session flags and the channel funnel are all
    projections of this one aggregation.
    """
    return (
        stitched.where(F.col("unified_user_id").isNotNull())
        .groupBy("unified_user_id", "stitched_session_id")
        .agg(
            F.min("event_ts").alias("session_started_at"),
            F.max("event_ts").alias("session_ended_at"),
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("page_location").alias("unique_pages"),
            # Alphabetically last, not first seen: the published definition.
            F.max("channel_key").alias("acquisition_channel"),
            F.max("device_category").alias("device_category"),
            F.max("country").alias("country"),
            *[_reached(event).alias(step) for step, event in FUNNEL_STEPS],
        )
    )


def session_facts(summary: DataFrame) -> DataFrame:
    return summary.select(
        "unified_user_id",
        "stitched_session_id",
        "session_started_at",
        "session_ended_at",
        seconds_between(F.col("session_started_at"), F.col("session_ended_at")).alias(
            "session_duration_sec"
        ),
        "event_count",
        "unique_pages",
        "acquisition_channel",
        "device_category",
        "country",
        F.col("step_5_purchase").alias("is_purchase_session"),
    )


def funnel_steps(summary: DataFrame) -> DataFrame:
    return summary.select(
        "unified_user_id", "stitched_session_id", *[step for step, _ in FUNNEL_STEPS]
    )


def channel_funnel(summary: DataFrame) -> DataFrame:
    """People reaching each step, per acquisition channel.

    Flags are reduced to one row per (channel, person) and then summed: two
    small aggregations in place of five distinct counts over expanded rows.
    """
    steps = [step for step, _ in FUNNEL_STEPS]
    per_person = (
        summary.where(F.col("acquisition_channel").isNotNull())
        .groupBy(F.col("acquisition_channel").alias("channel_key"), "unified_user_id")
        .agg(*[F.max(s).alias(s) for s in steps])
    )
    reached = [F.lit(1)] + [F.col(s) for s in steps[1:]]
    return per_person.groupBy("channel_key").agg(
        *[F.sum(flag).cast("long").alias(name) for flag, name in zip(reached, FUNNEL_COUNTS)]
    )
