"""Models as SELECT texts, in dependency order."""

from __future__ import annotations

import re

from wayfare.params import CHANNEL_RULES, CHANNELS, DEFAULT_CHANNEL, FUNNEL_COUNTS, FUNNEL_STEPS
from wayfare.sources.testbed import bronze_sql

WINDOW_DAYS = 30
TIMEOUT = 30
LONG_TIMEOUT = 720
AS_OF = "TIMESTAMP '2024-03-01 00:00:00'"


def channel_case(medium: str, source: str) -> str:
    arms = "".join(
        f" WHEN {medium} = '{m}'" + (f" AND {source} = '{s}'" if s else "") + f" THEN '{key}'"
        for m, s, key in CHANNEL_RULES
    )
    return f"CASE{arms} ELSE '{DEFAULT_CHANNEL}' END"


def _literal(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"


MODELS: dict[str, str] = dict(bronze_sql("duckdb"))

MODELS["dim_channels_m"] = (
    "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in CHANNELS)
    + ") v(channel_key, source, medium, channel_display_name, channel_group, is_paid, conversion_multiplier)"
)

MODELS["stg_web"] = f"""
SELECT event_id, event_name, event_ts, ga_client_id, ga_user_id, ga_session_id, page_location, page_title,
 device_category, country, source AS utm_source, medium AS utm_medium, campaign AS utm_campaign,
 item_id AS item_sku, value_eur, consent_status, {channel_case('medium', 'source')} AS channel_key
FROM ga4_events WHERE consent_status <> 'withdrawn'"""

MODELS["stg_pixel"] = """
SELECT event_id, event_name, make_timestamp(event_time * 1000000) AS event_ts, fbp, fbc, em_hash AS email_hash,
 ph_hash AS phone_hash, client_ip_prefix AS ip_prefix, client_user_agent AS user_agent, action_source, currency,
 CAST(value AS DOUBLE) AS value_eur, content_ids, consent_status, 'paid_social' AS channel_key
FROM meta_pixel_events WHERE consent_status <> 'withdrawn'"""

MODELS["stg_email"] = """
SELECT event_id, event_name, CAST(event_ts AS TIMESTAMP) AS event_ts, campaign_id, subscriber_id, email_hash,
 url AS click_url, consent_status, 'email' AS channel_key
FROM email_events WHERE consent_status <> 'withdrawn'"""

MODELS["stg_orders"] = """
SELECT order_id, customer_id AS shopify_customer_id, sha256(lower(trim(email))) AS email_hash,
 CAST(created_at AS TIMESTAMP) AS order_ts, CAST(total_price_eur AS DOUBLE) AS total_price_eur, currency,
 financial_status, fulfillment_status, country, consent_status
FROM shopify_orders WHERE consent_status <> 'withdrawn'"""

MODELS["stg_deliveries"] = """
SELECT customer_id AS shopify_customer_id, sha256(lower(trim(email))) AS email_hash, first_name, last_name,
 accepts_marketing, CAST(accepts_marketing_updated_at AS TIMESTAMP) AS consent_updated_at, country,
 CAST(created_at AS TIMESTAMP) AS created_at, consent_status
FROM shopify_customers WHERE consent_status <> 'withdrawn'"""

MODELS["stg_customers"] = """
SELECT * FROM stg_deliveries
QUALIFY row_number() OVER (PARTITION BY shopify_customer_id ORDER BY consent_updated_at DESC, created_at DESC) = 1"""

MODELS["matches"] = """
SELECT 'shopify_customer:' || shopify_customer_id AS a, 'email_hash:' || email_hash AS b, 'email_hash' AS t
 FROM stg_customers WHERE consent_status = 'granted'
UNION SELECT 'meta_fbp:' || fbp, 'email_hash:' || email_hash, 'email_hash' FROM stg_pixel WHERE consent_status = 'granted'
UNION SELECT 'email_subscriber:' || subscriber_id, 'email_hash:' || email_hash, 'email_hash' FROM stg_email WHERE consent_status = 'granted'
UNION SELECT 'ga_client:' || ga_client_id, 'shopify_customer:' || ga_user_id, 'logged_in_user_id' FROM stg_web WHERE consent_status = 'granted'
UNION SELECT 'ga_client:' || ga_client_id, 'ga_client:' || ga_client_id, 'self' FROM stg_web WHERE consent_status = 'granted'
UNION SELECT 'shopify_customer:' || shopify_customer_id, 'shopify_customer:' || shopify_customer_id, 'self' FROM stg_orders"""

MODELS["edges"] = """
SELECT DISTINCT raw_id_src, raw_id_dst, match_type, 'high' AS confidence FROM (
 SELECT a AS raw_id_src, b AS raw_id_dst, t AS match_type FROM matches
 UNION ALL SELECT b, a, t FROM matches) WHERE raw_id_src IS NOT NULL AND raw_id_dst IS NOT NULL"""

MODELS["reach"] = """
SELECT DISTINCT raw_id_src AS id, raw_id_src AS label FROM edges
UNION SELECT e.raw_id_src, r.label FROM reach r JOIN edges e ON e.raw_id_dst = r.id"""

_NODE = """raw_id, split_part(raw_id, ':', 1) AS raw_source,
 substr(raw_id, length(split_part(raw_id, ':', 1)) + 2) AS raw_value, md5(label) AS unified_user_id"""

MODELS["graph"] = f"SELECT {_NODE} FROM (SELECT id AS raw_id, min(label) AS label FROM reach GROUP BY id)"

MODELS["pass_1"] = "SELECT raw_id_src AS raw_id, min(raw_id_dst) AS label FROM edges GROUP BY 1"
for _k in range(2, 6):
    MODELS[f"pass_{_k}"] = (
        f"SELECT e.raw_id_src AS raw_id, min(p.label) AS label FROM edges e "
        f"JOIN pass_{_k - 1} p ON p.raw_id = e.raw_id_dst GROUP BY 1"
    )
MODELS["kpass"] = f"SELECT {_NODE} FROM pass_5"

MODELS["web_users"] = """
SELECT w.*, g.unified_user_id FROM stg_web w
LEFT JOIN graph g ON g.raw_id = 'ga_client:' || w.ga_client_id"""

MODELS["gaps"] = """
SELECT *, date_diff('minute', lag(event_ts) OVER (PARTITION BY coalesce(unified_user_id, ga_client_id) ORDER BY event_ts, event_id),
 event_ts) AS mins_since_prev FROM web_users"""

for _name, _limit in (("stitched", TIMEOUT), ("stitched_long", LONG_TIMEOUT)):
    _starts = f"CASE WHEN mins_since_prev IS NULL OR mins_since_prev > {_limit} THEN 1 ELSE 0 END"
    MODELS[_name] = f"""
SELECT event_id, event_ts, event_name, channel_key, page_location, item_sku, value_eur, country, device_category,
 ga_client_id, unified_user_id, CAST(sum({_starts}) OVER (PARTITION BY coalesce(unified_user_id, ga_client_id)
  ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stitched_session_id FROM gaps"""

for _suffix in ("", "_long"):
    MODELS[f"sess{_suffix}"] = f"""
SELECT unified_user_id, stitched_session_id, min(event_ts) AS session_started_at, max(event_ts) AS session_ended_at,
 date_diff('second', min(event_ts), max(event_ts)) AS session_duration_sec, count(*) AS event_count,
 count(DISTINCT page_location) AS unique_pages, max(channel_key) AS acquisition_channel,
 max(device_category) AS device_category, max(country) AS country,
 max(CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END) AS is_purchase_session
FROM stitched{_suffix} WHERE unified_user_id IS NOT NULL GROUP BY 1, 2"""
    _flags = ", ".join(
        f"max(CASE WHEN event_name = '{e}' THEN 1 ELSE 0 END) AS {s}" for s, e in FUNNEL_STEPS
    )
    MODELS[f"steps{_suffix}"] = f"""
SELECT unified_user_id, stitched_session_id, {_flags}
FROM stitched{_suffix} WHERE unified_user_id IS NOT NULL GROUP BY 1, 2"""


def funnel(sess: str, steps: str, where: str = "TRUE") -> str:
    counts = ["count(DISTINCT f.unified_user_id)"] + [
        f"count(DISTINCT CASE WHEN f.{s} = 1 THEN f.unified_user_id END)" for s, _ in FUNNEL_STEPS[1:]
    ]
    cols = ", ".join(f"{c} AS {n}" for c, n in zip(counts, FUNNEL_COUNTS))
    return f"""
SELECT s.acquisition_channel AS channel_key, {cols} FROM {steps} f
JOIN {sess} s ON s.unified_user_id = f.unified_user_id AND s.stitched_session_id = f.stitched_session_id
WHERE s.acquisition_channel IS NOT NULL AND {where} GROUP BY 1"""


MODELS["channel_funnel"] = funnel("sess", "steps")
MODELS["channel_funnel_long"] = funnel("sess_long", "steps_long")

MODELS["touches"] = """
SELECT event_id AS touchpoint_id, event_ts AS touchpoint_ts, 'ga4' AS source, channel_key, unified_user_id
 FROM web_users WHERE event_name <> 'purchase' AND unified_user_id IS NOT NULL
UNION ALL SELECT m.event_id, m.event_ts, 'meta', m.channel_key, g.unified_user_id
 FROM stg_pixel m JOIN graph g ON g.raw_id = 'meta_fbp:' || m.fbp WHERE m.event_name <> 'Purchase'
UNION ALL SELECT e.event_id, e.event_ts, 'email', e.channel_key, g.unified_user_id
 FROM stg_email e JOIN graph g ON g.raw_id = 'email_subscriber:' || e.subscriber_id WHERE e.event_name = 'campaign.clicked'"""

MODELS["buyer_orders"] = """
SELECT o.*, g.unified_user_id FROM stg_orders o
LEFT JOIN graph g ON g.raw_id = 'shopify_customer:' || o.shopify_customer_id"""

MODELS["convs"] = """
SELECT order_id AS conversion_id, order_ts AS conversion_ts, total_price_eur AS conversion_value_eur, unified_user_id
FROM buyer_orders WHERE unified_user_id IS NOT NULL"""

MODELS["enriched"] = f"""
SELECT t.touchpoint_id, t.touchpoint_ts, t.source, t.channel_key, t.unified_user_id,
 c.conversion_id, c.conversion_ts, c.conversion_value_eur
FROM touches t JOIN convs c ON c.unified_user_id = t.unified_user_id AND t.touchpoint_ts < c.conversion_ts
 AND date_diff('day', t.touchpoint_ts, c.conversion_ts) <= {WINDOW_DAYS}"""

MODELS["touch_facts"] = "SELECT *, CAST(touchpoint_ts AS DATE) AS touchpoint_date FROM enriched"

MODELS["ranked"] = """
SELECT conversion_id, conversion_value_eur, touchpoint_id, touchpoint_ts, source, channel_key, unified_user_id,
 row_number() OVER (PARTITION BY conversion_id ORDER BY touchpoint_ts, source, touchpoint_id) AS pos_asc,
 row_number() OVER (PARTITION BY conversion_id ORDER BY touchpoint_ts DESC, source DESC, touchpoint_id DESC) AS pos_desc,
 count(*) OVER (PARTITION BY conversion_id) AS n_touches FROM enriched"""

_POSITION = """CASE WHEN n_touches = 1 THEN CAST(1.0 AS DOUBLE) WHEN n_touches = 2 THEN CAST(0.5 AS DOUBLE)
 WHEN pos_asc = 1 OR pos_desc = 1 THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) / (CAST(n_touches AS DOUBLE) - 2) END"""

MODELS["credits"] = f"""
SELECT conversion_id, conversion_value_eur, touchpoint_id, channel_key, 'first_touch' AS attribution_model,
 CAST(1.0 AS DOUBLE) AS weight, conversion_value_eur AS revenue_share_eur FROM ranked WHERE pos_asc = 1
UNION ALL SELECT conversion_id, conversion_value_eur, touchpoint_id, channel_key, 'last_touch',
 CAST(1.0 AS DOUBLE), conversion_value_eur FROM ranked WHERE pos_desc = 1
UNION ALL SELECT conversion_id, conversion_value_eur, touchpoint_id, channel_key, 'linear',
 CAST(1.0 AS DOUBLE) / n_touches, conversion_value_eur / n_touches FROM ranked
UNION ALL SELECT conversion_id, conversion_value_eur, touchpoint_id, channel_key, 'position_based',
 {_POSITION}, conversion_value_eur * {_POSITION} FROM ranked"""

# Counts per conversion and channel, then the closed form of each model: a sum
# of n equal doubles is not n times the double to the last bit.
MODELS["channel_counts"] = """
SELECT conversion_id, channel_key, any_value(conversion_value_eur) AS v, CAST(count(*) AS DOUBLE) AS k,
 CAST(any_value(n_touches) AS DOUBLE) AS n, CAST(max(CASE WHEN pos_asc = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS f,
 CAST(max(CASE WHEN pos_desc = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS l
FROM ranked GROUP BY 1, 2"""

MODELS["pivoted"] = """
SELECT conversion_id, channel_key, v * f AS revenue_first_touch, v * l AS revenue_last_touch, v * k / n AS revenue_linear,
 v * CASE WHEN n = 1 THEN CAST(1.0 AS DOUBLE) WHEN n = 2 THEN k * CAST(0.5 AS DOUBLE)
  ELSE (f + l) * CAST(0.4 AS DOUBLE) + (k - (f + l)) * CAST(0.2 AS DOUBLE) / (n - 2) END AS revenue_position_based
FROM channel_counts"""

MODELS["conv_facts"] = """
SELECT o.order_id AS conversion_id, o.order_ts AS conversion_ts, CAST(o.order_ts AS DATE) AS conversion_date,
 o.unified_user_id, o.country, o.total_price_eur AS conversion_value_eur, p.channel_key, p.revenue_first_touch,
 p.revenue_last_touch, p.revenue_linear, p.revenue_position_based
FROM buyer_orders o LEFT JOIN pivoted p ON p.conversion_id = o.order_id"""

MODELS["users"] = f"""
SELECT unified_user_id, max(CASE WHEN c.consent_status = 'granted' THEN c.email_hash END) AS email_hash,
 max(c.country) AS country, coalesce(max(c.consent_status), 'anonymous') AS consent_status,
 coalesce(min(c.created_at), {AS_OF}) AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to, TRUE AS is_current
FROM graph g LEFT JOIN stg_customers c ON g.raw_id = 'shopify_customer:' || c.shopify_customer_id GROUP BY 1"""

MODELS["instant_state"] = """
SELECT g.unified_user_id, d.consent_updated_at AS since, d.consent_status,
 CASE WHEN d.consent_status = 'granted' THEN d.email_hash END AS email_hash
FROM stg_deliveries d JOIN graph g ON g.raw_id = 'shopify_customer:' || d.shopify_customer_id
WHERE d.consent_updated_at IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY g.unified_user_id, d.consent_updated_at
 ORDER BY d.created_at DESC NULLS LAST, d.consent_status DESC, email_hash DESC NULLS LAST) = 1"""

MODELS["state_changes"] = """
SELECT * FROM (SELECT *, row_number() OVER w AS rn, lag(email_hash) OVER w AS was_hash, lag(consent_status) OVER w AS was_consent
 FROM instant_state WINDOW w AS (PARTITION BY unified_user_id ORDER BY since))
WHERE rn = 1 OR was_hash IS DISTINCT FROM email_hash OR was_consent IS DISTINCT FROM consent_status"""

MODELS["user_history"] = """
SELECT unified_user_id, email_hash, consent_status, since AS valid_from,
 coalesce(lead(since) OVER w, TIMESTAMP '9999-12-31 00:00:00') AS valid_to, lead(since) OVER w IS NULL AS is_current
FROM state_changes WINDOW w AS (PARTITION BY unified_user_id ORDER BY since)"""

MODELS["calendar"] = """
SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series(
 CAST((SELECT min(order_ts) FROM stg_orders) AS DATE), CAST((SELECT max(order_ts) FROM stg_orders) AS DATE), INTERVAL 1 DAY)) AS d)"""

# The published date dimension, over the default analysis window.
MODELS["dim_dates_m"] = """
SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series(DATE '2025-10-01', DATE '2026-06-29', INTERVAL 1 DAY)) AS d)"""

MODELS["requests"] = "SELECT DISTINCT email FROM shopify_orders WHERE financial_status = 'refunded'"

MODELS["gone"] = """
SELECT DISTINCT u.unified_user_id, u.email_hash FROM requests r JOIN users u ON u.email_hash = sha256(lower(trim(r.email)))"""

# The models after every order was delivered a second time, pending ones dearer by five.
MODELS["stg_orders_re"] = """
SELECT order_id, customer_id AS shopify_customer_id, sha256(lower(trim(email))) AS email_hash,
 CAST(created_at AS TIMESTAMP) AS order_ts, CAST(total_price_eur AS DOUBLE) AS total_price_eur, currency,
 financial_status, fulfillment_status, country, consent_status
FROM (SELECT *, 1 AS delivery FROM shopify_orders UNION ALL
 SELECT * REPLACE (total_price_eur + CASE WHEN financial_status = 'pending' THEN 5.0 ELSE 0.0 END AS total_price_eur), 2 FROM shopify_orders)
WHERE consent_status <> 'withdrawn' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY delivery DESC) = 1"""

_AFTER_ORDERS = ["buyer_orders", "convs", "enriched", "ranked", "credits", "channel_counts", "pivoted", "conv_facts"]
for _name in _AFTER_ORDERS:
    MODELS[f"{_name}_re"] = re.sub(rf"\b(stg_orders|{'|'.join(_AFTER_ORDERS)})\b", r"\1_re", MODELS[_name])

MODELS["gone_twice"] = """
SELECT DISTINCT u.unified_user_id FROM users u JOIN shopify_orders o ON u.email_hash = sha256(lower(trim(o.email)))
WHERE o.financial_status = 'refunded' OR o.country = 'DE'"""
