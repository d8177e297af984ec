"""One SELECT per registered query, over the models."""

from __future__ import annotations

from oracle.models import AS_OF, channel_case, funnel
from wayfare.params import MODELS as ATTRIBUTION_MODELS
from wayfare.params import SOURCE_LABELS
from wayfare.plans import contracts

RUNS_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
CONV_COLS = ["revenue_first_touch", "revenue_last_touch", "revenue_linear", "revenue_position_based"]


def fixed(expr: str, digits: int) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"floor(({expr}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale}"


def days(col: str, first: str, after: str) -> str:
    return f"{col} >= TIMESTAMP '{first} 00:00:00' AND {col} < TIMESTAMP '{after} 00:00:00'"


def label(col: str) -> str:
    arms = "".join(f" WHEN '{k}' THEN '{v}'" for k, v in SOURCE_LABELS.items())
    return f"CASE lower({col}){arms} ELSE upper({col}) END"


WINDOW = ("2024-01-01", "2024-01-31")
LATE = ("2024-01-10", "2024-02-11")
RUNS = "audit_pipeline_runs"
LAST_DAY = f"start_ts >= {RUNS_AS_OF} - INTERVAL 1 DAY"
PCT_OK = "sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) * CAST(100.0 AS DOUBLE) / count(*)"
BY_CHANNEL = "FROM conv_facts WHERE channel_key IS NOT NULL GROUP BY channel_key"


def _credits(digits: int, where: str = "TRUE") -> str:
    return f"""SELECT conversion_id, {fixed('conversion_value_eur', digits)} AS conversion_value_eur, touchpoint_id, channel_key,
 attribution_model, {fixed('weight', digits)} AS weight, {fixed('revenue_share_eur', digits)} AS revenue_share_eur FROM credits WHERE {where}"""


def _kpi(conversions: str) -> str:
    return f"""SELECT (SELECT count(*) FROM users) AS unified_users, (SELECT count(*) FROM sess) AS sessions,
 (SELECT count(*) FROM enriched) AS touchpoints, count(*) AS conversions, {fixed('sum(v)', 2)} AS revenue_total
FROM ({conversions})"""


def _cohort(rows: str) -> str:
    return f"""
SELECT cohort_week, weeks_since, {fixed('sum(v)', 2)} AS revenue FROM (
 SELECT f.cohort_week, CAST(date_diff('day', f.cohort_week, CAST(date_trunc('week', c.conversion_date) AS DATE)) / 7 AS INT) AS weeks_since, c.v
 FROM ({rows}) c JOIN (SELECT unified_user_id, CAST(date_trunc('week', min(conversion_date)) AS DATE) AS cohort_week
  FROM conv_facts GROUP BY 1) f USING (unified_user_id))
WHERE weeks_since BETWEEN 0 AND 12 GROUP BY 1, 2"""


def _top(window: tuple[str, str], keys: str = "") -> str:
    where = days("touchpoint_ts", *window) + (f" AND source IN ({keys})" if keys else "")
    return f"""
SELECT raw_profiles, unified_profiles, {fixed('rate', 2)} AS match_rate_pct, {fixed('revenue', 2)} AS revenue_eur,
 CASE WHEN rate >= 20 THEN 'good' WHEN rate >= 10 THEN 'medium' ELSE 'low' END AS match_band
FROM (SELECT count(*) AS raw_profiles, count(DISTINCT unified_user_id) AS unified_profiles,
  CASE WHEN count(*) = 0 THEN 0 ELSE CAST(count(DISTINCT unified_user_id) AS DOUBLE) * 100.0 / count(*) END AS rate,
  (SELECT coalesce(sum(revenue_linear), 0) FROM conv_facts WHERE {days('conversion_ts', *window)}) AS revenue
 FROM touch_facts WHERE {where})"""


# Table names of the contracts -> models.
TABLES = {
    "stg_ga4_events": "stg_web",
    "stg_meta_pixel_events": "stg_pixel",
    "stg_shopify_customers": "stg_customers",
    "stg_shopify_orders": "stg_orders",
    "stg_email_events": "stg_email",
    "identity_edges": "edges",
    "identity_graph": "graph",
    "sessions_stitched": "stitched",
    "touchpoints_attribution": "credits",
    "funnel_steps": "steps",
    "dim_users": "users",
    "dim_channels": "dim_channels_m",
    "dim_dates": "dim_dates_m",
    "fct_touchpoints": "touch_facts",
    "fct_sessions": "sess",
    "fct_conversions": "conv_facts",
    "fct_funnel_steps": "channel_funnel",
}


def _table(name: str) -> str:
    return name.removeprefix("bronze.") if name.startswith("bronze.") else TABLES[name]


def _check(table: str, check: str, column: str, observed: str, passed: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"observed, {passed} AS passed FROM (SELECT CAST({observed} AS DOUBLE) AS observed FROM {source})"
    )


def _bounds(low, high) -> str:
    parts = []
    if low is not None:
        parts.append(f"observed >= {low}")
    if high is not None:
        parts.append(f"observed <= {high}")
    return " AND ".join(parts)


def _not_null() -> str:
    return " UNION ALL ".join(
        _check(t, "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)", "observed = 0", _table(t))
        for t, cs in contracts.NOT_NULL.items()
        for c in cs
    )


def _unique(table: str, check: str, columns: list[str]) -> str:
    cols = ", ".join(columns)
    where = f"WHERE {cols} IS NOT NULL" if len(columns) == 1 else ""
    repeated = f"(SELECT {cols} FROM {_table(table)} {where} GROUP BY {cols} HAVING count(*) > 1)"
    return _check(table, check, ",".join(columns), "count(*)", "observed = 0", repeated)


def _accepted() -> str:
    return " UNION ALL ".join(
        _check(
            t, "accepted_values", c,
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({', '.join(repr(x) for x in v)}))",
            "observed = 0", _table(t),
        )
        for t, c, v in contracts.ACCEPTED
    )


def _relationships() -> str:
    return " UNION ALL ".join(
        _check(
            t, "relationships", c, "count(*)", "observed = 0",
            f"(SELECT 1 FROM {_table(t)} c WHERE c.{c} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_table(p)} p WHERE p.{k} = c.{c}))",
        )
        for t, c, p, k in contracts.RELATIONSHIPS
    )


def _between() -> str:
    def bad(c, lo, hi):
        return " OR ".join(
            [f"{c} < {lo}"] * (lo is not None) + [f"{c} > {hi}"] * (hi is not None)
        )

    return " UNION ALL ".join(
        _check(t, "between", c, f"count(*) FILTER (WHERE {bad(c, lo, hi)})", "observed = 0", _table(t))
        for t, c, lo, hi in contracts.BETWEEN
    )


def _scan() -> str:
    """The mart scan, check by check."""
    parts = []
    for table, (checks, keys) in contracts.SCAN.items():
        source = _table(table)
        for c in checks:
            col = c.column
            if c.kind == "row_count":
                seen, passed = "count(*)", _bounds(c.low, c.high)
            elif c.kind == "not_null":
                seen, passed = f"count(*) FILTER (WHERE {col} IS NULL)", "observed = 0"
            elif c.kind == "accepted_values":
                listed = ", ".join(repr(v) for v in c.values)
                seen, passed = f"count(*) FILTER (WHERE {col} NOT IN ({listed}))", "observed = 0"
            elif c.kind == "min":
                seen, passed = f"min({col})", _bounds(c.low, None)
            else:
                seen = f"date_diff('second', max({col}), {AS_OF}) / CAST(86400.0 AS DOUBLE)"
                passed = f"observed < {c.high}"
            parts.append(_check(table, c.kind, col, seen, passed, source))
        parts += [_unique(table, "unique", [k]) for k in keys]
    return (
        f"SELECT table_name, check_name, column_name, {fixed('observed', 2)} AS observed, passed FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


def _signals() -> str:
    pick = "SELECT status, end_ts FROM audit_pipeline_runs WHERE {} ORDER BY end_ts DESC NULLS LAST, run_id DESC LIMIT 1"
    lag = f"date_diff('second', max(end_ts), {RUNS_AS_OF})"
    return f"""
SELECT 'lakehouse' AS signal, CASE WHEN status = 'success' THEN 'ok' ELSE 'warn' END AS status,
 CASE WHEN status = 'success' THEN '3/3 buckets up' ELSE 'dernier write : ' || status END AS detail
FROM ({pick.format("step ILIKE '%bronze%' OR pipeline IN ('ga4', 'meta', 'shopify', 'mailchimp')")})
UNION ALL SELECT 'orchestrator', CASE WHEN lag < 93600 THEN 'ok' WHEN lag < 172800 THEN 'warn' ELSE 'error' END,
 CASE WHEN lag < 120 THEN 'lag ' || lag || 's' WHEN lag < 7200 THEN 'lag ' || CAST(floor(lag / 60.0) AS BIGINT) || ' min'
 ELSE 'lag ' || CAST(floor(lag / 3600.0) AS BIGINT) || ' h' END
FROM (SELECT {lag} AS lag FROM audit_pipeline_runs)
UNION ALL SELECT 'build', CASE WHEN status = 'success' THEN 'ok' ELSE 'warn' END,
 'last run, ' || CASE WHEN m = 0 THEN 'à l''instant' ELSE 'il y a ' || m || ' min' END
FROM (SELECT status, CAST(floor(date_diff('microsecond', end_ts, {RUNS_AS_OF}) / 60000000.0) AS BIGINT) AS m FROM ({pick.format("pipeline = 'dbt'")}))
UNION ALL SELECT 'quality', CASE WHEN total > 0 AND failed = 0 THEN 'ok' ELSE 'warn' END,
 CASE WHEN total = 0 THEN 'aucun scan récent' WHEN failed = 0 THEN total || ' checks OK' ELSE failed || ' check en alerte' END
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE status = 'failed') AS failed FROM audit_pipeline_runs
 WHERE pipeline = 'soda' AND {LAST_DAY})
UNION ALL SELECT 'consent', CASE WHEN p >= 99 THEN 'ok' ELSE 'warn' END, CAST(round_even(p, 0) AS INT) || '% propagé'
FROM (SELECT count(consent_status) * 100.0 / count(*) AS p FROM users)"""


SESSION_COLS = "unified_user_id, stitched_session_id"

QUERIES: dict[str, str] = {
    # sources and sinks
    "bronze_roundtrip": "SELECT *, CAST(event_ts AS DATE) AS dt FROM ga4_events",
    "bronze_lookback": """SELECT *, CAST(CAST(event_ts AS TIMESTAMP) AS DATE) AS dt FROM email_events
 WHERE CAST(CAST(event_ts AS TIMESTAMP) AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-31'""",
    "retention_purge": """
SELECT 'ga4' AS source, CAST(event_ts AS DATE) AS dt, count(*) AS rows_kept FROM ga4_events
 WHERE CAST(event_ts AS DATE) >= DATE '2024-01-16' GROUP BY 2
UNION ALL SELECT 'meta', CAST(make_timestamp(event_time * 1000000) AS DATE), count(*) FROM meta_pixel_events
 WHERE CAST(make_timestamp(event_time * 1000000) AS DATE) >= DATE '2025-02-16' GROUP BY 2
UNION ALL SELECT 'shopify', CAST(CAST(created_at AS TIMESTAMP) AS DATE), count(*) FROM shopify_orders GROUP BY 2
UNION ALL SELECT 'email', CAST(CAST(event_ts AS TIMESTAMP) AS DATE), count(*) FROM email_events e
 WHERE NOT EXISTS (SELECT 1 FROM (SELECT subscriber_id, max(CAST(CAST(event_ts AS TIMESTAMP) AS DATE)) AS d FROM email_events
  WHERE event_name = 'campaign.unsubscribed' GROUP BY 1) u WHERE u.subscriber_id = e.subscriber_id AND u.d < DATE '2024-03-16') GROUP BY 2""",
    "publish_roundtrip": "SELECT * FROM sess",
    "json_pages_to_bronze": "SELECT order_id, customer_id, email, created_at, total_price_eur, currency, consent_status FROM shopify_orders",
    "retention_purge_email": """
SELECT *, CAST(CAST(event_ts AS TIMESTAMP) AS DATE) AS dt FROM email_events e
 WHERE NOT EXISTS (SELECT 1 FROM (SELECT subscriber_id, max(CAST(CAST(event_ts AS TIMESTAMP) AS DATE)) AS d FROM email_events
  WHERE event_name = 'campaign.unsubscribed' GROUP BY 1) u WHERE u.subscriber_id = e.subscriber_id AND u.d < DATE '2024-03-16')""",
    "ad_insights_to_bronze": """
SELECT concat_ws('/', CAST(CAST(event_ts AS DATE) AS VARCHAR), campaign, source) AS ad_id, campaign AS campaign_name,
 count(*) AS impressions, CASE WHEN source IS DISTINCT FROM 'google' THEN count(*) END AS clicks,
 count(value_eur) + CAST(0.5 AS DOUBLE) AS spend, CAST(count(*) AS VARCHAR) AS viewed,
 CASE WHEN source = 'google' THEN 'n/a' END AS rescued_clicks, source AS rescued_publisher, 1 AS bad_pages
FROM ga4_events GROUP BY CAST(event_ts AS DATE), campaign, source""",
    "web_report_to_bronze": """
SELECT event_name, device_category, country, source, medium, campaign, page_location, strftime(event_ts, '%Y%m%d') AS event_date,
 count(*) AS event_count, count(DISTINCT ga_session_id) AS sessions,
 CASE WHEN source IS DISTINCT FROM 'google' THEN count(DISTINCT ga_client_id) END AS total_users,
 CASE WHEN source = 'google' THEN '(hidden)' END AS rescued_users, 1 AS bad_pages
FROM ga4_events GROUP BY event_name, device_category, country, source, medium, campaign, page_location, strftime(event_ts, '%Y%m%d')""",
    "publish_silver": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(CAST({at} AS DATE) AS VARCHAR) AS silver_day, count(*) AS rows, {value} AS value_eur FROM {table} GROUP BY CAST({at} AS DATE)"
        for name, table, at, value in (
            ("stg_ga4_events", "stg_web", "event_ts", fixed("sum(value_eur + CASE WHEN CAST(event_ts AS DATE) = DATE '2024-01-10' THEN 1 ELSE 0 END)", 2)),
            ("stg_meta_pixel_events", "stg_pixel", "event_ts", fixed("sum(value_eur)", 2)),
            ("stg_email_events", "stg_email", "event_ts", "CAST(NULL AS DOUBLE)"),
            ("stg_shopify_orders", "stg_orders", "order_ts", "CAST(NULL AS DOUBLE)"),
            ("stg_shopify_customers", "stg_customers", "created_at", "CAST(NULL AS DOUBLE)"),
        )
    ),
    "audit_append": " UNION ALL ".join(
        f"SELECT 'staging' AS pipeline, '{raw}' AS step, 'prod' AS environment, 'success' AS status, "
        f"(SELECT count(*) FROM {raw}) AS rows_in, (SELECT count(*) FROM {stage}) AS rows_out, CAST(NULL AS VARCHAR) AS error"
        for raw, stage in (("ga4_events", "stg_web"), ("meta_pixel_events", "stg_pixel"), ("email_events", "stg_email"))
    ),
    # staging
    "consent_filter": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, consent_status, count(*) AS rows_kept FROM {t} WHERE consent_status <> 'withdrawn' GROUP BY 2"
        for t in ["ga4_events", "meta_pixel_events", "email_events", "shopify_customers", "shopify_orders"]
    ),
    "stg_ga4_events": "SELECT * FROM stg_web",
    "channel_mapping": f"SELECT source, medium, count(*) AS events, {channel_case('medium', 'source')} AS channel_key FROM ga4_events GROUP BY 1, 2",
    "stg_meta_pixel_events": "SELECT * REPLACE (array_to_string(content_ids, ',') AS content_ids) FROM stg_pixel",
    "stg_email_events": "SELECT * FROM stg_email",
    "stg_shopify_orders": "SELECT * FROM stg_orders",
    "stg_shopify_customers": "SELECT * FROM stg_customers",
    "email_hash": "SELECT order_id, sha256(lower(trim(email))) AS email_hash FROM shopify_orders",
    "pii_minimise": """SELECT customer_id, sha256('+3247' || customer_id) AS phone_hash,
 '10.' || (customer_id % 200) || '.' || (customer_id % 50) || '.0' AS ip_prefix FROM shopify_customers""",
    # identity
    "identity_edges": "SELECT * FROM edges",
    "identity_graph": "SELECT * FROM graph",
    "identity_graph_grown": "SELECT * FROM graph",
    "identity_kpass": "SELECT * FROM kpass",
    "identity_candidates": """SELECT DISTINCT 'meta_fbp:' || fbp AS raw_id_src, 'device:' || sha256(ip_prefix || '|' || user_agent) AS raw_id_dst,
 'device_fingerprint' AS match_type, 'probabilistic' AS confidence FROM stg_pixel WHERE consent_status = 'granted'""",
    # sessions and funnel
    "events_with_user": "SELECT event_id, event_ts, event_name, ga_client_id, unified_user_id FROM web_users",
    "session_gaps": """SELECT event_id, event_ts, unified_user_id, mins_since_prev,
 CASE WHEN mins_since_prev IS NULL OR mins_since_prev > 30 THEN 1 ELSE 0 END AS is_new_session FROM gaps""",
    "sessions_stitched": "SELECT * FROM stitched",
    "fct_sessions": "SELECT * FROM sess",
    "fct_sessions_long": "SELECT * FROM sess_long",
    "funnel_steps": "SELECT * FROM steps",
    "funnel_steps_long": "SELECT * FROM steps_long",
    "fct_funnel_steps": "SELECT * FROM channel_funnel",
    "fct_funnel_steps_long": "SELECT * FROM channel_funnel_long",
    "stream_ingest": "SELECT *, CAST(event_ts AS DATE) AS dt FROM ga4_events",
    "stream_sessions": """
SELECT ga_client_id, min(event_ts) AS session_started_at, max(event_ts) + INTERVAL 30 MINUTE AS session_closed_at, count(*) AS event_count,
 max(CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END) AS is_purchase_session
FROM (SELECT *, sum(s) OVER (PARTITION BY ga_client_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS n
 FROM (SELECT *, CASE WHEN event_ts < lag(event_ts) OVER (PARTITION BY ga_client_id ORDER BY event_ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM stg_web))
GROUP BY ga_client_id, n HAVING max(event_ts) + INTERVAL 30 MINUTE <= (SELECT max(event_ts) - INTERVAL 30 MINUTE FROM stg_web)""",
    "stream_session_table": """
SELECT ga_client_id, min(event_ts) AS session_started_at, max(event_ts) + INTERVAL 30 MINUTE AS session_closed_at, count(*) AS event_count,
 max(CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END) AS is_purchase_session,
 max(event_ts) + INTERVAL 30 MINUTE > TIMESTAMP '2024-01-31 00:00:00' AS is_open
FROM (SELECT *, sum(s) OVER (PARTITION BY ga_client_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS n
 FROM (SELECT *, CASE WHEN event_ts < lag(event_ts) OVER (PARTITION BY ga_client_id ORDER BY event_ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s
  FROM stg_web WHERE ga_client_id IS NOT NULL AND event_ts IS NOT NULL))
GROUP BY ga_client_id, n""",
    # touchpoints
    "all_touches": "SELECT * FROM touches",
    "conversions": "SELECT * FROM convs",
    "touchpoints_enriched": "SELECT * FROM enriched",
    "fct_touchpoints": "SELECT * FROM touch_facts",
    # attribution
    "attribution_ranked": "SELECT * FROM ranked",
    **{f"attribution_{m}": _credits(6, f"attribution_model = '{m}'") for m in ATTRIBUTION_MODELS},
    "touchpoints_attribution": _credits(6),
    "attribution_time_decay": f"""
SELECT conversion_id, {fixed('conversion_value_eur', 4)} AS conversion_value_eur, touchpoint_id, channel_key, 'time_decay' AS attribution_model,
 {fixed('w / total', 4)} AS weight, {fixed('conversion_value_eur * (w / total)', 4)} AS revenue_share_eur
FROM (SELECT *, sum(w) OVER (PARTITION BY conversion_id) AS total FROM (SELECT *,
  pow(CAST(2.0 AS DOUBLE), -(date_diff('second', touchpoint_ts, conversion_ts) / CAST(86400.0 AS DOUBLE)) / CAST(7.0 AS DOUBLE)) AS w FROM enriched))""",
    "attribution_time_decay_channels": f"""
SELECT conversion_id, channel_key, {fixed('sum(w) / any_value(total)', 4)} AS weight,
 {fixed('any_value(conversion_value_eur) * (sum(w) / any_value(total))', 4)} AS revenue_time_decay
FROM (SELECT *, sum(w) OVER (PARTITION BY conversion_id) AS total FROM (SELECT *,
  pow(CAST(2.0 AS DOUBLE), -(date_diff('second', touchpoint_ts, conversion_ts) / CAST(86400.0 AS DOUBLE)) / CAST(7.0 AS DOUBLE)) AS w FROM enriched))
GROUP BY conversion_id, channel_key""",
    "attribution_pivot": "SELECT conversion_id, channel_key, "
    + ", ".join(f"{fixed(c, 6)} AS {c}" for c in CONV_COLS)
    + " FROM pivoted",
    "fct_conversions": "SELECT conversion_id, conversion_ts, conversion_date, unified_user_id, country, "
    + f"{fixed('conversion_value_eur', 6)} AS conversion_value_eur, channel_key, "
    + ", ".join(f"{fixed(c, 6)} AS {c}" for c in CONV_COLS)
    + " FROM conv_facts",
    "attribution_reconcile": " UNION ALL ".join(
        f"""SELECT '{m}' AS attribution_model, {fixed('sum(r)', 2)} AS revenue, {fixed('sum(v)', 2)} AS attributed_value,
 abs(sum(r) - sum(v)) < greatest(1.0, 0.001 * sum(v)) AS reconciles
 FROM (SELECT conversion_id, max(conversion_value_eur) AS v, sum(revenue_share_eur) AS r FROM credits WHERE attribution_model = '{m}' GROUP BY 1)"""
        for m in ATTRIBUTION_MODELS
    ),
    "fct_conversions_redelivered": "SELECT conversion_id, conversion_ts, conversion_date, unified_user_id, country, "
    + f"{fixed('conversion_value_eur', 6)} AS conversion_value_eur, channel_key, "
    + ", ".join(f"{fixed(c, 6)} AS {c}" for c in CONV_COLS)
    + " FROM conv_facts_re",
    "attribution_reconcile_redelivered": " UNION ALL ".join(
        f"""SELECT '{m}' AS attribution_model, {fixed('sum(r)', 2)} AS revenue, {fixed('sum(v)', 2)} AS attributed_value,
 abs(sum(r) - sum(v)) < greatest(1.0, 0.001 * sum(v)) AS reconciles
 FROM (SELECT conversion_id, max(conversion_value_eur) AS v, sum(revenue_share_eur) AS r FROM credits_re WHERE attribution_model = '{m}' GROUP BY 1)"""
        for m in ATTRIBUTION_MODELS
    ),
    # dimensions and history
    "dim_users": "SELECT * FROM users",
    "dim_channels": """SELECT c.*, u.web_events FROM dim_channels_m c LEFT JOIN
 (SELECT channel_key, count(*) AS web_events FROM stg_web GROUP BY 1) u USING (channel_key)""",
    "dim_dates": """SELECT date_day, CAST(year(date_day) AS INT) AS year, CAST(month(date_day) AS INT) AS month, CAST(day(date_day) AS INT) AS day_of_month,
 CAST(isodow(date_day) AS INT) AS day_of_week_iso, CAST(week(date_day) AS INT) AS iso_week, CAST(quarter(date_day) AS INT) AS quarter,
 isodow(date_day) IN (6, 7) AS is_weekend FROM calendar""",
    "dim_users_scd2": "SELECT * FROM user_history",
    "facts_asof_user": """SELECT c.conversion_id, c.conversion_ts, c.unified_user_id, h.email_hash, h.consent_status, h.valid_from
FROM convs c LEFT JOIN user_history h ON h.unified_user_id = c.unified_user_id AND c.conversion_ts >= h.valid_from AND c.conversion_ts < h.valid_to""",
    # reports
    "kpi_overview": _kpi("SELECT conversion_value_eur AS v FROM conv_facts"),
    "kpi_overview_dedup": _kpi("SELECT max(conversion_value_eur) AS v FROM conv_facts GROUP BY conversion_id"),
    "identity_graph_stats": f"""SELECT count(*) AS raw_ids, count(DISTINCT unified_user_id) AS unified_users,
 {fixed('CAST(count(*) AS DOUBLE) / count(DISTINCT unified_user_id)', 6)} AS avg_ids_per_user FROM graph""",
    "identity_cluster_sample": """SELECT unified_user_id, raw_id, n_ids FROM graph JOIN
 (SELECT unified_user_id, count(*) AS n_ids FROM graph GROUP BY 1 ORDER BY n_ids DESC, unified_user_id LIMIT 10) USING (unified_user_id)""",
    "funnel_by_channel": "SELECT * FROM channel_funnel",
    "attribution_by_channel": "SELECT channel_key, "
    + ", ".join(f"{fixed(f'sum({c})', 2)} AS {c.removeprefix('revenue_')}" for c in CONV_COLS)
    + f" {BY_CHANNEL}",
    "attribution_delta": f"""SELECT channel_key, {fixed('l', 2)} AS last_touch, {fixed('p', 2)} AS position_based, {fixed('p - l', 2)} AS delta_eur,
 {fixed('CASE WHEN l <> 0 THEN (p - l) / l END', 2)} AS delta_pct
FROM (SELECT channel_key, sum(revenue_last_touch) AS l, sum(revenue_position_based) AS p {BY_CHANNEL})""",
    "weekly_cohort": _cohort("SELECT unified_user_id, conversion_date, conversion_value_eur AS v FROM conv_facts"),
    "weekly_cohort_dedup": _cohort(
        "SELECT unified_user_id, conversion_date, max(conversion_value_eur) AS v FROM conv_facts GROUP BY conversion_id, 1, 2"
    ),
    "top_metrics": _top(WINDOW),
    "top_metrics_filtered": _top(LATE, "'meta', 'mailchimp', 'email'"),
    "unification_per_source": f"""SELECT {label('source')} AS source, count(*) AS raw_profiles, count(DISTINCT unified_user_id) AS unified_profiles,
 round_even(CAST(count(DISTINCT unified_user_id) AS DOUBLE) / count(*) * 100.0, 1) AS match_rate_pct
FROM touch_facts WHERE {days('touchpoint_ts', *WINDOW)} GROUP BY touch_facts.source""",
    "consent_registry": f"""SELECT {label('t.source')} AS source, CASE u.consent_status WHEN 'granted' THEN 'Consentement OK'
 WHEN 'anonymous' THEN 'Anonymisé' ELSE u.consent_status END AS status, count(*) AS records, max(touchpoint_ts) AS last_update
FROM touch_facts t JOIN users u USING (unified_user_id) GROUP BY t.source, u.consent_status""",
    "attribution_panel": f"""SELECT channel, {fixed('revenue', 2)} AS revenue, {fixed('round_even(revenue / sum(revenue) OVER () * 100, 0)', 2)} AS share_pct
FROM (SELECT coalesce(d.channel_display_name, c.channel_key) AS channel, sum(c.revenue_linear) AS revenue
 FROM conv_facts c LEFT JOIN dim_channels_m d USING (channel_key)
 WHERE c.channel_key IS NOT NULL AND {days('c.conversion_ts', *LATE)} GROUP BY 1 HAVING sum(c.revenue_linear) > 0
 ORDER BY revenue DESC, channel LIMIT 5)""",
    "gdpr_breakdown": """SELECT *, score_pct >= 99 AS compliant FROM (SELECT count(*) AS total,
 count(*) FILTER (WHERE consent_status = 'granted') AS consent_ok, count(*) FILTER (WHERE consent_status = 'anonymous') AS anonymous,
 count(email_hash) AS pseudonymised, round_even(count(*) FILTER (WHERE consent_status = 'granted') * CAST(100.0 AS DOUBLE) / count(*), 0) AS score_pct FROM users)""",
    # operations
    "pipeline_health": f"""SELECT runs, {fixed('ok_pct', 4)} AS success_pct, {fixed('secs', 4)} AS avg_seconds, quality_alerts, last_run_ts,
 {fixed('consent', 4)} AS consent_pct, quality_alerts = 0 AND ok_pct >= 90 AS operational
FROM (SELECT count(*) AS runs, {PCT_OK} AS ok_pct, avg(duration_ms) / 1000.0 AS secs,
  count(*) FILTER (WHERE status = 'failed' AND pipeline = 'soda') AS quality_alerts, max(end_ts) AS last_run_ts,
  (SELECT count(consent_status) * CAST(100.0 AS DOUBLE) / count(*) FROM users) AS consent
 FROM {RUNS} WHERE {days('start_ts', *WINDOW)})""",
    "quality_trend_weekly": f"""SELECT CAST(date_trunc('week', start_ts) AS DATE) AS week, {fixed(PCT_OK, 4)} AS score
FROM {RUNS} WHERE {days('start_ts', *WINDOW)} GROUP BY 1""",
    "pipeline_logs": f"""SELECT * FROM (SELECT {label('pipeline')} AS source, step, upper(status) AS status,
 coalesce(duration_ms, 0) / CAST(1000.0 AS DOUBLE) AS duration_s, start_ts AS ts
 FROM {RUNS} WHERE {days('start_ts', *WINDOW)} ORDER BY start_ts DESC, run_id LIMIT 200) WHERE source IN ('GA4', 'Mailchimp')""",
    "system_signals": _signals(),
    "source_freshness": f"""SELECT source, CASE WHEN m IS NULL THEN 'jamais reçu' WHEN m = 0 THEN 'à l''instant' ELSE 'il y a ' || m || ' min' END AS label,
 coalesce(m, 99999) AS minutes
FROM (SELECT v.source, CAST(greatest(0, floor(date_diff('microsecond', max(coalesce(r.end_ts, r.start_ts)), {RUNS_AS_OF}) / 60000000.0)) AS BIGINT) AS m
 FROM (VALUES ('GA4', 'ga4'), ('Meta Ads', 'meta'), ('Shopify', 'shopify'), ('Mailchimp', 'mailchimp')) v(source, key)
 LEFT JOIN {RUNS} r ON lower(r.pipeline) = v.key AND r.status = 'success' GROUP BY 1)""",
    "quality_status": f"""SELECT count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total FROM {RUNS} WHERE pipeline = 'soda' AND {LAST_DAY}""",
    "quality_alerts": f"""SELECT coalesce(step, 'check') AS check_name, coalesce(error, '') AS detail, start_ts AS ts,
 CAST(floor(date_diff('microsecond', start_ts, {RUNS_AS_OF}) / 60000000.0) AS BIGINT) AS minutes
FROM {RUNS} WHERE pipeline = 'soda' AND status = 'failed' AND {LAST_DAY}""",
    "pipeline_timeline": f"""SELECT {label('pipeline')} AS source, step, upper(status) AS status, start_ts, coalesce(end_ts, start_ts) AS end_ts,
 {fixed(f"date_diff('second', {RUNS_AS_OF} - INTERVAL 1 DAY, s) / CAST(86400.0 AS DOUBLE) * CAST(100.0 AS DOUBLE)", 6)} AS offset_pct,
 {fixed("greatest(CAST(2.0 AS DOUBLE), date_diff('second', s, e) / CAST(86400.0 AS DOUBLE) * CAST(100.0 AS DOUBLE))", 6)} AS width_pct
FROM (SELECT *, greatest(start_ts, {RUNS_AS_OF} - INTERVAL 1 DAY) AS s, greatest(least(coalesce(end_ts, start_ts), {RUNS_AS_OF}), start_ts) AS e
 FROM {RUNS} WHERE {LAST_DAY})""",
    # quality
    "check_not_null": _not_null(),
    "check_unique": " UNION ALL ".join(_unique(t, "unique", [c]) for t, c in contracts.UNIQUE),
    "check_accepted_values": _accepted(),
    "check_relationships": _relationships(),
    "check_unique_combination": " UNION ALL ".join(
        _unique(t, "unique_combination", cs) for t, cs in contracts.UNIQUE_COMBINATION
    ),
    "check_between": _between(),
    "check_row_count": " UNION ALL ".join(
        _check(t, "row_count", "*", "count(*)", _bounds(lo, hi), _table(t))
        for t, lo, hi in contracts.ROW_COUNT
    ),
    "check_min": " UNION ALL ".join(
        f"SELECT table_name, check_name, column_name, {fixed('observed', 2)} AS observed, passed FROM ("
        + _check(t, "min", c, f"min({c})", _bounds(lo, None), _table(t))
        + ")"
        for t, c, lo in contracts.MINIMUM
    ),
    "check_freshness": " UNION ALL ".join(
        f"SELECT table_name, check_name, column_name, {fixed('observed', 6)} AS observed, passed FROM ("
        + _check(
            t, "freshness", c, f"date_diff('second', max({c}), {AS_OF}) / CAST(86400.0 AS DOUBLE)",
            f"observed < {d}", _table(t),
        )
        + ")"
        for t, c, d in contracts.FRESHNESS
    ),
    "quality_scan": _scan(),
    "check_funnel_monotonic": """SELECT * FROM channel_funnel WHERE users_pdp > users_visited OR users_add_to_cart > users_pdp
 OR users_checkout > users_add_to_cart OR users_purchased > users_checkout""",
    "check_graph_orphans": "SELECT raw_id, unified_user_id FROM graph WHERE raw_id IS NULL OR unified_user_id IS NULL",
    "check_weights_sum_to_one": f"""SELECT conversion_id, attribution_model, {fixed('sum(weight)', 6)} AS total_weight
FROM credits GROUP BY 1, 2 HAVING abs(sum(weight) - 1.0) > 0.001""",
    # erasure
    "forget_resolve": "SELECT * FROM gone",
    "forget_cascade": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS rows_before,
 count(*) FILTER (WHERE unified_user_id IS NULL OR unified_user_id NOT IN (SELECT unified_user_id FROM gone)) AS rows_after FROM {TABLES[t]}"""
        for t in ["fct_touchpoints", "fct_sessions", "fct_conversions", "dim_users"]
    )
    + f""" UNION ALL SELECT 'fct_funnel_steps', (SELECT count(*) FROM channel_funnel), count(*)
 FROM ({funnel('sess', 'steps', 'f.unified_user_id NOT IN (SELECT unified_user_id FROM gone)')})""",
    "forget_funnel": funnel("sess", "steps", "f.unified_user_id NOT IN (SELECT unified_user_id FROM gone)"),
    "forget_two_batches": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS rows_before,
 count(*) FILTER (WHERE unified_user_id IS NULL OR unified_user_id NOT IN (SELECT unified_user_id FROM gone_twice)) AS rows_after FROM {model}"""
        for name, model in {
            "fct_touchpoints": "touch_facts", "fct_sessions": "sess", "fct_conversions": "conv_facts", "dim_users": "users",
            "identity_graph": "graph", "all_touches": "touches", "conversions": "convs", "session_summary": "sess",
            "identity_edges": "(SELECT g.unified_user_id FROM edges e JOIN graph g ON g.raw_id = e.raw_id_src)",
        }.items()
    )
    + f""" UNION ALL SELECT 'fct_funnel_steps', (SELECT count(*) FROM channel_funnel), count(*)
 FROM ({funnel('sess', 'steps', 'f.unified_user_id NOT IN (SELECT unified_user_id FROM gone_twice)')})
UNION ALL SELECT 'forgotten_users', 0, count(*) FROM gone_twice""",
    "forget_tombstones": f"""SELECT unified_user_id, email_hash, {AS_OF} AS forgotten_at, 'req_' || substr(unified_user_id, 1, 8) AS request_id FROM gone""",
}

# Columns handed out as text: days, and the open end of a validity.
AS_TEXT = {
    "bronze_roundtrip": ["dt"],
    "bronze_lookback": ["dt"],
    "stream_ingest": ["dt"],
    "fct_conversions_redelivered": ["conversion_date"],
    "retention_purge": ["dt"],
    "retention_purge_email": ["dt"],
    "fct_touchpoints": ["touchpoint_date"],
    "fct_conversions": ["conversion_date"],
    "dim_dates": ["date_day"],
    "dim_users": ["valid_to"],
    "dim_users_scd2": ["valid_to"],
    "weekly_cohort": ["cohort_week"],
    "weekly_cohort_dedup": ["cohort_week"],
    "quality_trend_weekly": ["week"],
}
for _name, _columns in AS_TEXT.items():
    _texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _columns)
    QUERIES[_name] = f"SELECT * REPLACE ({_texts}) FROM ({QUERIES[_name]})"
