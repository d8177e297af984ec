"""Operational reports over the audit table of pipeline runs.

"Now" is always the `as_of` argument. A filter on `start_ts` reaches the scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.timeutil import minutes_elapsed, ntz, seconds_between, within_days
from wayfare.params import DISPLAY_SOURCES, SOURCE_LABELS
from wayfare.plans.reports import _share, one_row, source_label

# The pipelines that deliver.
INGESTS = ["ga4", "meta", "shopify", "mailchimp"]


def _consent_pct(users: DataFrame) -> DataFrame:
    known = F.count_if(F.col("consent_status").isNotNull())
    return users.agg(
        F.coalesce(_share(known, F.count(F.lit(1))), F.lit(0.0)).alias("consent_pct")
    )


def _last_day(runs: DataFrame, as_of: datetime) -> DataFrame:
    return runs.where(F.col("start_ts") >= ntz(as_of - timedelta(days=1)))


def _minutes_ago(ts: Column, as_of: datetime) -> Column:
    return minutes_elapsed(ts, ntz(as_of))


def pipeline_health(runs: DataFrame, users: DataFrame, start: date, end: date) -> DataFrame:
    ok = F.count_if(F.col("status") == "success")
    alerts = F.count_if((F.col("status") == "failed") & (F.col("pipeline") == "soda"))
    health = runs.where(within_days(F.col("start_ts"), start, end)).agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(_share(ok, F.count(F.lit(1))), F.lit(0.0)).alias("success_pct"),
        F.coalesce(F.avg("duration_ms") / 1000.0, F.lit(0.0)).alias("avg_seconds"),
        alerts.alias("quality_alerts"),
        F.max("end_ts").alias("last_run_ts"),
    )
    return one_row(health, _consent_pct(users)).withColumn(
        "operational", (F.col("quality_alerts") == 0) & (F.col("success_pct") >= 90)
    )


def quality_trend_weekly(runs: DataFrame, start: date, end: date) -> DataFrame:
    ok = F.count_if(F.col("status") == "success")
    return (
        runs.where(within_days(F.col("start_ts"), start, end))
        .groupBy(F.trunc(F.col("start_ts").cast("date"), "week").alias("week"))
        .agg(_share(ok, F.count(F.lit(1))).alias("score"))
        .orderBy("week")
    )


def pipeline_logs(
    runs: DataFrame, start: date, end: date, sources: list[str] | None = None, limit: int = 200
) -> DataFrame:
    """The newest `limit` runs; the source filter applies to those."""
    newest = (
        runs.where(within_days(F.col("start_ts"), start, end))
        .orderBy(F.desc("start_ts"), "run_id")
        .limit(limit)
    )
    status = F.upper("status")
    shown = newest.select(
        source_label(F.col("pipeline")).alias("source"),
        "step",
        F.when(status == "WARN", "WARNING").otherwise(status).alias("status"),
        (F.coalesce("duration_ms", F.lit(0)) / 1000.0).alias("duration_s"),
        F.col("start_ts").alias("ts"),
    )
    return shown.where(F.col("source").isin(sources)) if sources else shown


def _latest(runs: DataFrame, name: str) -> DataFrame:
    """Status and end of the run that ended last (one row, NULLs when there is none)."""
    by_end = F.struct("end_ts", "run_id")
    return runs.agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("status", by_end).alias("status"),
        F.max("end_ts").alias("end_ts"),
    ).withColumn("signal", F.lit(name))


def system_signals(runs: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    """Five service signals: (signal, status, detail)."""
    ok_or_warn = F.when(F.col("status") == "success", "ok").otherwise("warn")

    ingest = runs.where(F.lower("step").contains("bronze") | F.col("pipeline").isin(INGESTS))
    # Wording of the signals.
    lake = _latest(ingest, "lakehouse").select(
        "signal",
        F.when(F.col("n") == 0, "error").otherwise(ok_or_warn).alias("status"),
        F.when(F.col("n") == 0, "aucun run trouvé")
        .when(F.col("status") == "success", "3/3 buckets up")
        .otherwise(F.concat(F.lit("dernier write : "), "status"))
        .alias("detail"),
    )

    lag = seconds_between(F.col("end_ts"), ntz(as_of))
    text = lambda n, unit: F.concat(F.lit("lag "), n.cast("string"), F.lit(unit))
    orchestrator = _latest(runs, "orchestrator").select(
        "signal",
        F.when(F.col("end_ts").isNull(), "error")
        .when(lag < 26 * 3600, "ok")
        .when(lag < 48 * 3600, "warn")
        .otherwise("error")
        .alias("status"),
        F.when(F.col("end_ts").isNull(), "aucun run")
        .when(lag < 120, text(lag, "s"))
        .when(lag < 7200, text(F.floor(lag / 60), " min"))
        .otherwise(text(F.floor(lag / 3600), " h"))
        .alias("detail"),
    )

    minutes = _minutes_ago(F.col("end_ts"), as_of)
    build = _latest(runs.where(F.col("pipeline") == "dbt"), "build").select(
        "signal",
        F.when(F.col("end_ts").isNull(), "error").otherwise(ok_or_warn).alias("status"),
        F.when(F.col("end_ts").isNull(), "aucun build")
        .otherwise(F.concat(F.lit("last run, "), _ago(minutes)))
        .alias("detail"),
    )

    checks = quality_status(runs, as_of).select(
        F.lit("quality").alias("signal"),
        F.when((F.col("total") > 0) & (F.col("failed") == 0), "ok").otherwise("warn").alias("status"),
        F.when(F.col("total") == 0, "aucun scan récent")
        .when(F.col("failed") == 0, F.concat(F.col("total").cast("string"), F.lit(" checks OK")))
        .otherwise(F.concat(F.col("failed").cast("string"), F.lit(" check en alerte")))
        .alias("detail"),
    )

    consent = _consent_pct(users).select(
        F.lit("consent").alias("signal"),
        F.when(F.col("consent_pct") >= 99, "ok").otherwise("warn").alias("status"),
        F.concat(F.bround("consent_pct").cast("int").cast("string"), F.lit("% propagé")).alias("detail"),
    )
    return reduce(DataFrame.unionByName, [lake, orchestrator, build, checks, consent])


def _ago(minutes: Column) -> Column:
    # Wording of elapsed time.
    return F.when(minutes == 0, "à l'instant").otherwise(
        F.concat(F.lit("il y a "), minutes.cast("string"), F.lit(" min"))
    )


def quality_status(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Failed and total checks of the last 24 hours."""
    return (
        _last_day(runs, as_of)
        .where(F.col("pipeline") == "soda")
        .agg(
            F.count_if(F.col("status") == "failed").alias("failed"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def source_freshness(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Minutes since each source's last successful ingest; 99 999 when there was none."""
    key = F.lower("pipeline")
    ended = F.coalesce("end_ts", "start_ts")
    last = (
        runs.where((F.col("status") == "success") & key.isin(list(SOURCE_LABELS)))
        .groupBy(key.alias("key"))
        .agg(F.max(ended).alias("last"))
        .select(source_label(F.col("key")).alias("source"), "key", "last")
        # Both e-mail spellings share a label; the first one wins when present.
        .groupBy("source")
        .agg(F.max_by("last", F.when(F.col("key") == "email", 0).otherwise(1)).alias("last"))
    )
    listed = runs.sparkSession.createDataFrame([(s,) for s in DISPLAY_SOURCES], "source string")
    minutes = F.greatest(F.lit(0), _minutes_ago(F.col("last"), as_of))
    return listed.join(last, "source", "left").select(
        "source",
        F.when(F.col("last").isNull(), "jamais reçu").otherwise(_ago(minutes)).alias("label"),
        F.when(F.col("last").isNull(), F.lit(99_999)).otherwise(minutes).cast("long").alias("minutes"),
    )


def quality_alerts(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Failed checks of the last 24 hours, newest first."""
    return (
        _last_day(runs, as_of)
        .where((F.col("pipeline") == "soda") & (F.col("status") == "failed"))
        .select(
            F.coalesce("step", F.lit("check")).alias("check_name"),
            F.coalesce("error", F.lit("")).alias("detail"),
            F.col("start_ts").alias("ts"),
            _minutes_ago(F.col("start_ts"), as_of).alias("minutes"),
        )
        .orderBy(F.desc("ts"))
    )


def pipeline_timeline(runs: DataFrame, as_of: datetime) -> DataFrame:
    """Runs of the last 24 hours as bars: offset and width in percent of the day."""
    span = 24 * 3600.0
    opens, closes = ntz(as_of - timedelta(days=1)), ntz(as_of)
    start = F.greatest("start_ts", opens)
    end = F.greatest(F.least("end_ts", closes), start)
    bars = _last_day(runs, as_of).select(
        source_label(F.col("pipeline")).alias("source"),
        "step",
        F.upper("status").alias("status"),
        "start_ts",
        F.coalesce("end_ts", "start_ts").alias("end_ts"),
    )
    return bars.select(
        "*",
        (seconds_between(opens, start) / F.lit(span) * 100.0).alias("offset_pct"),
        F.greatest(
            F.lit(2.0), seconds_between(start, end) / F.lit(span) * 100.0
        ).alias("width_pct"),
    ).orderBy("start_ts")
