from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wayfare.operators.dimensions import dim_channels
from wayfare.plans import monitoring, reports

FACTS = (
    "conversion_id string, conversion_ts timestamp_ntz, conversion_date date, unified_user_id string, "
    "conversion_value_eur double, channel_key string, revenue_first_touch double, "
    "revenue_last_touch double, revenue_linear double, revenue_position_based double"
)


def conv(i, day, user, value, channel, first=0.0, last=0.0, linear=0.0, position=0.0):
    at = datetime.combine(day, datetime.min.time())
    return (i, at, day, user, value, channel, first, last, linear, position)


@pytest.fixture()
def facts(spark):
    return spark.createDataFrame(
        [
            conv("o1", date(2024, 1, 1), "u", 100.0, "email", 100.0, 0.0, 50.0, 50.0),
            conv("o1", date(2024, 1, 1), "u", 100.0, "direct", 0.0, 100.0, 50.0, 50.0),
            conv("o2", date(2024, 1, 9), "u", 10.0, "direct", 10.0, 10.0, 10.0, 10.0),
            conv("o3", date(2024, 6, 1), "u", 7.0, None, None, None, None, None),
            conv("o4", date(2024, 1, 7), None, 5.0, None, None, None, None, None),
        ],
        FACTS,
    )


def test_delta_has_no_percentage_of_nothing(facts):
    got = {r.channel_key: (r.delta_eur, r.delta_pct) for r in reports.attribution_delta(facts).collect()}
    assert got == {"email": (50.0, None), "direct": (-50.0, pytest.approx(-50 / 110))}


def test_cohorts_literal_and_per_conversion(facts):
    literal = {(r.cohort_week, r.weeks_since): r.revenue for r in reports.weekly_cohort(facts).collect()}
    monday = date(2024, 1, 1)
    # o1 stands on two rows; o3 lies 21 weeks on and is out of range; o4 has no person.
    assert literal == {(monday, 0): 200.0, (monday, 1): 10.0}
    once = {(r.cohort_week, r.weeks_since): r.revenue for r in reports.weekly_cohort(facts, per_conversion=True).collect()}
    assert once == {(monday, 0): 100.0, (monday, 1): 10.0}


def test_overview_literal_and_per_conversion(spark, facts):
    one = spark.range(3)
    row = reports.kpi_overview(one, one, one, facts).first()
    assert (row.unified_users, row.conversions, row.revenue_total) == (3, 5, 222.0)
    row = reports.kpi_overview(one, one, one, facts, per_conversion=True).first()
    assert (row.conversions, row.revenue_total) == (4, 122.0)
    empty = reports.kpi_overview(one, one, one, facts.where("false")).first()
    assert (empty.conversions, empty.revenue_total) == (0, 0.0)


def test_panel_share_is_of_the_rows_shown(spark, facts):
    window = (date(2024, 1, 1), date(2024, 1, 31))
    rows = reports.attribution_panel(facts, dim_channels(spark), *window).collect()
    assert [(r.channel, r.revenue, r.share_pct) for r in rows] == [("Direct", 60.0, 55.0), ("Email Campaigns", 50.0, 45.0)]
    rows = reports.attribution_panel(facts, dim_channels(spark), *window, limit=1).collect()
    assert [(r.channel, r.share_pct) for r in rows] == [("Direct", 100.0)]


@pytest.fixture()
def touches(spark):
    rows = [
        ("ga4", datetime(2024, 1, 1), "u"),
        ("ga4", datetime(2024, 1, 30, 23, 59), "u"),
        ("meta", datetime(2024, 1, 5), "v"),
        ("email", datetime(2024, 1, 5), "v"),
        ("ga4", datetime(2024, 1, 31), "w"),
    ]
    return spark.createDataFrame(rows, "source string, touchpoint_ts timestamp_ntz, unified_user_id string").withColumn(
        "touchpoint_date", F.col("touchpoint_ts").cast("date")
    )


WINDOW = (date(2024, 1, 1), date(2024, 1, 30))


def test_metrics_filter_touches_but_not_revenue(facts, touches):
    row = reports.top_metrics(touches, facts, *WINDOW).first()
    assert (row.raw_profiles, row.unified_profiles, row.match_rate_pct, row.match_band) == (4, 2, 50.0, "good")
    row = reports.top_metrics(touches, facts, *WINDOW, sources=["Mailchimp"]).first()
    assert (row.raw_profiles, row.unified_profiles, row.revenue_eur) == (1, 1, 110.0)
    row = reports.top_metrics(touches, facts, *WINDOW, sources=["Shopify"]).first()
    assert (row.raw_profiles, row.match_rate_pct, row.match_band) == (0, 0.0, "low")


def test_sources_are_labelled(touches):
    rows = reports.unification_per_source(touches, *WINDOW).collect()
    assert {r.source: (r.raw_profiles, r.unified_profiles, r.match_rate_pct) for r in rows} == {
        "GA4": (2, 1, 50.0), "Meta Ads": (1, 1, 100.0), "Mailchimp": (1, 1, 100.0),
    }
    assert reports.source_keys(["Mailchimp", "Other"]) == ["mailchimp", "email", "other"]
    assert reports.preset_window(date(2024, 3, 1), 30) == (date(2024, 1, 31), date(2024, 3, 1))


def test_register_labels_consent(spark, touches):
    users = spark.createDataFrame([("u", "granted"), ("v", "anonymous"), ("w", None)], "unified_user_id string, consent_status string")
    got = {(r.source, r.status): r.records for r in reports.consent_registry(touches, users).collect()}
    assert got == {
        ("GA4", "Consentement OK"): 2, ("GA4", "À anonymiser"): 1, ("Meta Ads", "Anonymisé"): 1, ("Mailchimp", "Anonymisé"): 1,
    }


def test_breakdown_of_nobody(spark):
    row = reports.gdpr_breakdown(spark.createDataFrame([], "email_hash string, consent_status string")).first()
    assert (row.total, row.score_pct, row.compliant) == (0, 0.0, False)


RUNS = (
    "run_id string, pipeline string, step string, start_ts timestamp_ntz, end_ts timestamp_ntz, "
    "duration_ms bigint, status string, error string"
)
NOW = datetime(2024, 2, 1, 12)


def run(i, pipeline, start, end, status="success", step="bronze"):
    return (f"r{i}", pipeline, step, start, end, 1000, status, "boom" if status == "failed" else None)


@pytest.fixture()
def runs(spark):
    return spark.createDataFrame(
        [
            run(1, "ga4", datetime(2024, 2, 1, 10), datetime(2024, 2, 1, 11)),
            run(2, "meta", datetime(2024, 1, 31, 10), datetime(2024, 1, 31, 11), "failed"),
            run(3, "email", datetime(2024, 2, 1, 11), datetime(2024, 2, 1, 11, 59, 30)),
            run(4, "dbt", datetime(2024, 2, 1, 9), datetime(2024, 2, 1, 9, 30), step="build"),
            run(5, "soda", datetime(2024, 2, 1, 9), datetime(2024, 2, 1, 9, 1), "failed", "scan"),
            run(6, "soda", datetime(2024, 2, 1, 8), None, "success", None),
        ],
        RUNS,
    )


@pytest.fixture()
def users(spark):
    return spark.createDataFrame([("granted",), (None,)], "consent_status string")


def test_signals(runs, users):
    got = {r.signal: (r.status, r.detail) for r in monitoring.system_signals(runs, users, NOW).collect()}
    assert got == {
        "lakehouse": ("ok", "3/3 buckets up"),
        "orchestrator": ("ok", "lag 30s"),
        "build": ("ok", "last run, il y a 150 min"),
        "quality": ("warn", "1 check en alerte"),
        "consent": ("warn", "50% propagé"),
    }


@pytest.mark.parametrize("hours, status, detail", [(1, "ok", "lag 60 min"), (25, "ok", "lag 25 h"), (26, "warn", "lag 26 h"), (48, "error", "lag 48 h")])
def test_lag_bands(spark, users, hours, status, detail):
    from datetime import timedelta

    end = NOW - timedelta(hours=hours)
    df = spark.createDataFrame([run(1, "x", end, end)], RUNS)
    got = {r.signal: (r.status, r.detail) for r in monitoring.system_signals(df, users, NOW).collect()}
    assert got["orchestrator"] == (status, detail)


def test_signals_without_any_run(spark, users):
    df = spark.createDataFrame([], RUNS)
    got = {r.signal: (r.status, r.detail) for r in monitoring.system_signals(df, users, NOW).collect()}
    assert got["lakehouse"] == ("error", "aucun run trouvé")
    assert got["orchestrator"] == ("error", "aucun run")
    assert got["build"] == ("error", "aucun build")
    assert got["quality"] == ("warn", "aucun scan récent")


def test_freshness_knows_both_email_spellings(spark, runs):
    got = {r.source: (r.label, r.minutes) for r in monitoring.source_freshness(runs, NOW).collect()}
    assert got == {
        "GA4": ("il y a 60 min", 60),
        "Meta Ads": ("jamais reçu", 99_999),
        "Shopify": ("jamais reçu", 99_999),
        "Mailchimp": ("à l'instant", 0),
    }
    both = runs.union(spark.createDataFrame([run(9, "mailchimp", datetime(2024, 2, 1, 6), datetime(2024, 2, 1, 7))], RUNS))
    got = {r.source: r.minutes for r in monitoring.source_freshness(both, NOW).collect()}
    assert got["Mailchimp"] == 300


def test_health_and_logs(spark, runs, users):
    window = (date(2024, 1, 31), date(2024, 2, 1))
    row = monitoring.pipeline_health(runs, users, *window).first()
    assert (row.runs, row.quality_alerts, row.consent_pct, row.operational) == (6, 1, 50.0, False)
    assert row.success_pct == pytest.approx(400 / 6) and row.avg_seconds == 1.0
    none = monitoring.pipeline_health(runs, users, date(2020, 1, 1), date(2020, 1, 2)).first()
    assert (none.runs, none.success_pct, none.last_run_ts) == (0, 0.0, None)

    # The source filter looks at the newest runs only.
    assert monitoring.pipeline_logs(runs, *window, ["GA4"], limit=1).isEmpty()
    assert [r.source for r in monitoring.pipeline_logs(runs, *window, ["GA4"], limit=2).collect()] == ["GA4"]
    trend = monitoring.quality_trend_weekly(runs, *window).collect()
    assert [(r.week, r.score) for r in trend] == [(date(2024, 1, 29), pytest.approx(400 / 6))]


def test_alerts_and_timeline(runs):
    assert [(r.check_name, r.detail, r.minutes) for r in monitoring.quality_alerts(runs, NOW).collect()] == [("scan", "boom", 180)]
    bars = {r.start_ts: r for r in monitoring.pipeline_timeline(runs, NOW).collect()}
    assert len(bars) == 4  # two runs start at nine
    ga4 = bars[datetime(2024, 2, 1, 10)]
    assert ga4.offset_pct == pytest.approx(22 / 24 * 100) and ga4.width_pct == pytest.approx(100 / 24)
    assert bars[datetime(2024, 2, 1, 8)].width_pct == 2.0
