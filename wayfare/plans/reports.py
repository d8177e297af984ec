"""Business reports over the published marts."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.timeutil import week_start, within_days
from wayfare.params import ANONYMOUS, GRANTED, MODELS, SOURCE_LABELS


def source_keys(displays: list[str] | None) -> list[str]:
    """Display names -> source keys; an unknown name stands for itself, lower-cased."""
    keys: list[str] = []
    for name in displays or []:
        known = [k for k, label in SOURCE_LABELS.items() if label == name]
        keys += known or [name.lower()]
    return keys


def source_filter(sources: list[str] | None, c: Column) -> Column:
    """True for every row when no source is chosen."""
    return F.lower(c).isin(source_keys(sources)) if sources else F.lit(True)


def source_label(c: Column) -> Column:
    """Display name of a source key; unknown keys are shown in capitals."""
    key = F.lower(F.coalesce(c, F.lit("")))
    known = F.create_map(*[F.lit(x) for pair in SOURCE_LABELS.items() for x in pair])
    shown = F.when(key == "", F.lit("?")).otherwise(F.upper(key))
    return F.coalesce(known[key], shown)


def _share(part: Column, whole: Column) -> Column:
    """Percentage, NULL over nothing."""
    return part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0))


def one_row(*frames: DataFrame) -> DataFrame:
    """Single-row frames with distinct columns, side by side."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def kpi_overview(
    users: DataFrame, sessions: DataFrame, touchpoints: DataFrame, conversions: DataFrame,
    per_conversion: bool = False,
) -> DataFrame:
    """Head counts and revenue, one row.

    A conversion stands in its table once per credited channel, and the
    overview counts those rows; `per_conversion` counts each order once.
    """
    rows = conversions
    if per_conversion:
        rows = conversions.groupBy("conversion_id").agg(
            F.max("conversion_value_eur").alias("conversion_value_eur")
        )
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    totals = rows.agg(
        F.count(F.lit(1)).alias("conversions"),
        F.coalesce(F.sum("conversion_value_eur"), F.lit(0.0)).alias("revenue_total"),
    )
    return one_row(
        one(users, "unified_users"),
        one(sessions, "sessions"),
        one(touchpoints, "touchpoints"),
        totals,
    )


def identity_graph_stats(graph: DataFrame) -> DataFrame:
    people = F.count_distinct("unified_user_id")
    return graph.agg(
        F.count(F.lit(1)).alias("raw_ids"), people.alias("unified_users")
    ).withColumn(
        "avg_ids_per_user",
        F.coalesce(
            F.col("raw_ids").cast("double") / F.nullif(F.col("unified_users"), F.lit(0)), F.lit(0.0)
        ),
    )


def identity_cluster_sample(graph: DataFrame, limit: int = 10) -> DataFrame:
    """Members of the `limit` largest people."""
    largest = (
        graph.groupBy("unified_user_id")
        .agg(F.count(F.lit(1)).alias("n_ids"))
        .orderBy(F.desc("n_ids"), "unified_user_id")
        .limit(limit)
    )
    return (
        graph.join(largest, "unified_user_id")
        .select("unified_user_id", "raw_id", "n_ids")
        .orderBy(F.desc("n_ids"), "unified_user_id", "raw_id")
    )


def funnel_by_channel(funnel: DataFrame) -> DataFrame:
    return funnel.orderBy(F.desc("users_visited"), "channel_key")


def _by_channel(conversions: DataFrame) -> DataFrame:
    return (
        conversions.where(F.col("channel_key").isNotNull())
        .groupBy("channel_key")
        .agg(*[F.sum(f"revenue_{m}").alias(m) for m in MODELS])
    )


def attribution_by_channel(conversions: DataFrame) -> DataFrame:
    return _by_channel(conversions).orderBy(F.desc("linear"), "channel_key")


def attribution_delta(conversions: DataFrame) -> DataFrame:
    """What moves when multi-touch replaces last-touch; no percentage of nothing."""
    base, delta = F.col("last_touch"), F.col("position_based") - F.col("last_touch")
    return (
        _by_channel(conversions)
        .select(
            "channel_key",
            "last_touch",
            "position_based",
            delta.alias("delta_eur"),
            F.when(base != 0, delta / base).alias("delta_pct"),
        )
        .orderBy(F.desc("delta_eur"), "channel_key")
    )


def weekly_cohort(conversions: DataFrame, per_conversion: bool = False) -> DataFrame:
    """Revenue by first-conversion week and weeks since, 0 to 12.

    Rows are reduced to (person, week) first; the cohort is the person's
    smallest week, and only person-weeks meet in the join.
    """
    rows = conversions.where(F.col("unified_user_id").isNotNull())
    if per_conversion:
        rows = rows.groupBy("conversion_id", "unified_user_id", "conversion_date").agg(
            F.max("conversion_value_eur").alias("conversion_value_eur")
        )
    weeks = rows.groupBy(
        "unified_user_id", week_start(F.col("conversion_date")).alias("week")
    ).agg(F.sum("conversion_value_eur").alias("revenue"))
    cohorts = weeks.groupBy("unified_user_id").agg(F.min("week").alias("cohort_week"))
    since = (F.datediff("week", "cohort_week") / 7).cast("int")
    return (
        weeks.join(cohorts, "unified_user_id")
        .groupBy("cohort_week", since.alias("weeks_since"))
        .agg(F.sum("revenue").alias("revenue"))
        .where(F.col("weeks_since").between(0, 12))
        .orderBy("cohort_week", "weeks_since")
    )


def _touches_in(
    touchpoints: DataFrame, start: date, end: date, sources: list[str] | None
) -> DataFrame:
    """The report window; the date range prunes partitions, the time range is pushed down."""
    return touchpoints.where(
        F.col("touchpoint_date").between(F.lit(start), F.lit(end))
        & within_days(F.col("touchpoint_ts"), start, end)
        & source_filter(sources, F.col("source"))
    )


def top_metrics(
    touchpoints: DataFrame,
    conversions: DataFrame,
    start: date,
    end: date,
    sources: list[str] | None = None,
) -> DataFrame:
    """Touch rows, people, match rate and linear revenue; revenue knows no source filter."""
    seen = _touches_in(touchpoints, start, end, sources).agg(
        F.count(F.lit(1)).alias("raw_profiles"),
        F.count_distinct("unified_user_id").alias("unified_profiles"),
    )
    revenue = conversions.where(within_days(F.col("conversion_ts"), start, end)).agg(
        F.coalesce(F.sum("revenue_linear"), F.lit(0.0)).alias("revenue_eur")
    )
    rate = F.coalesce(_share(F.col("unified_profiles"), F.col("raw_profiles")), F.lit(0.0))
    band = F.when(rate >= 20, "good").when(rate >= 10, "medium").otherwise("low")
    return one_row(seen, revenue).select(
        "raw_profiles",
        "unified_profiles",
        rate.alias("match_rate_pct"),
        "revenue_eur",
        band.alias("match_band"),
    )


def unification_per_source(
    touchpoints: DataFrame, start: date, end: date, sources: list[str] | None = None
) -> DataFrame:
    rate = F.col("unified_profiles").cast("double") / F.col("raw_profiles") * 100.0
    return (
        _touches_in(touchpoints, start, end, sources)
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("raw_profiles"),
            F.count_distinct("unified_user_id").alias("unified_profiles"),
        )
        .orderBy(F.desc("raw_profiles"), "source")
        .select(
            source_label(F.col("source")).alias("source"),
            "raw_profiles",
            "unified_profiles",
            F.bround(rate, 1).alias("match_rate_pct"),
        )
    )


def consent_registry(
    touchpoints: DataFrame, users: DataFrame, sources: list[str] | None = None
) -> DataFrame:
    """Touch rows per source and consent.

    Touches are counted per (source, person) before they meet the people.
    """
    per_person = (
        touchpoints.where(source_filter(sources, F.col("source")))
        .groupBy("source", "unified_user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("touchpoint_ts").alias("last_ts"))
    )
    # Labels of the register.
    label = (
        F.when(F.col("consent_status") == GRANTED, "Consentement OK")
        .when(F.col("consent_status") == ANONYMOUS, "Anonymisé")
        .otherwise(F.coalesce("consent_status", F.lit("À anonymiser")))
    )
    return (
        per_person.join(users.select("unified_user_id", "consent_status"), "unified_user_id")
        .groupBy("source", "consent_status")
        .agg(F.sum("n").alias("records"), F.max("last_ts").alias("last_update"))
        .orderBy("source", "consent_status")
        .select(
            source_label(F.col("source")).alias("source"),
            label.alias("status"),
            "records",
            "last_update",
        )
    )


def attribution_panel(
    conversions: DataFrame, channels: DataFrame, start: date, end: date, limit: int = 5
) -> DataFrame:
    """Top channels by linear revenue, with each one's share of the rows shown."""
    per_key = (
        conversions.where(
            F.col("channel_key").isNotNull() & within_days(F.col("conversion_ts"), start, end)
        )
        .groupBy("channel_key")
        .agg(F.sum("revenue_linear").alias("revenue"))
    )
    # The list may come from any file: whether it is broadcast is left to the engine's size check.
    names = channels.select("channel_key", "channel_display_name")
    top = (
        per_key.join(names, "channel_key", "left")
        .groupBy(F.coalesce("channel_display_name", "channel_key").alias("channel"))
        .agg(F.sum("revenue").alias("revenue"))
        .where(F.col("revenue") > 0)
        .orderBy(F.desc("revenue"), "channel")
        .limit(limit)
    )
    # Over the `limit` rows on show, nothing more.
    shown = F.sum("revenue").over(Window.partitionBy())
    return top.select(
        "channel", "revenue", F.bround(F.col("revenue") / shown * 100).alias("share_pct")
    ).orderBy(F.desc("revenue"), "channel")


def gdpr_breakdown(users: DataFrame) -> DataFrame:
    score = F.coalesce(F.bround(_share(F.col("consent_ok"), F.col("total"))), F.lit(0.0))
    return users.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("consent_status") == GRANTED).alias("consent_ok"),
        F.count_if(F.col("consent_status") == ANONYMOUS).alias("anonymous"),
        F.count_if(F.col("email_hash").isNotNull()).alias("pseudonymised"),
    ).select("*", score.alias("score_pct"), (score >= 99).alias("compliant"))


def preset_window(as_of: date, days: int) -> tuple[date, date]:
    """The sidebar's presets: from `days` back to today."""
    return as_of - timedelta(days=days), as_of

