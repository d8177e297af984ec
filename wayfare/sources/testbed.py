"""The six bronze tables and the audit table, derived from the driver's tables.

Every row of `events` is a web event, a pixel event fired along with it, an
e-mail event and a pipeline run; every row of `customer`, `orders` and
`lineitem` becomes a shop record. No row is left out. The texts are shared by
both engines; only the tokens in DIALECT differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIALECT = {
    "spark": {
        "EPOCH": "(datediff(cast(ts AS DATE), DATE '1970-01-01') * 86400L + hour(ts) * 3600L + minute(ts) * 60L + second(ts))",
        "SHA": "sha2({}, 256)",
        "TS": "TIMESTAMP_NTZ",
        "LIST": "array({})",
        "STAMP": "date_format({}, 'yyyy-MM-dd HH:mm:ss')",
        "MICROS": "date_format({}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    },
    "duckdb": {
        "EPOCH": "CAST(floor(epoch(ts)) AS BIGINT)",
        "SHA": "sha256({})",
        "TS": "TIMESTAMP",
        "LIST": "[{}]",
        "STAMP": "strftime({}, '%Y-%m-%d %H:%M:%S')",
        "MICROS": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')",
    },
}


def _consent(n: str) -> str:
    return (
        f"CASE WHEN {n} % 10 = 9 THEN 'withdrawn' "
        f"WHEN {n} % 10 IN (7, 8) THEN 'anonymous' ELSE 'granted' END"
    )


def _country(n: str) -> str:
    return f"CASE {n} % 4 WHEN 0 THEN 'BE' WHEN 1 THEN 'DE' ELSE 'FR' END"


# Every third web visitor is known to the shop under the same number.
_PERSON_EMAIL = (
    "CONCAT(CASE WHEN user_id % 3 = 0 THEN 'user' ELSE 'guest' END, "
    "CAST(user_id AS STRING), '@example.com')"
)


def bronze_sql(dialect: str) -> dict[str, str]:
    """Bronze table -> SELECT over the driver's tables."""
    d = DIALECT[dialect]
    sha, stamp, micros, many = d["SHA"].format, d["STAMP"].format, d["MICROS"].format, d["LIST"].format
    ts = d["TS"]
    created = f"{ts} '2023-01-01 00:00:00' + (c_custkey % 180) * INTERVAL '1' DAY"
    delivery = f"{ts} '2023-06-01 00:00:00' + (c_custkey % 28) * INTERVAL '1' DAY"
    order_time = (
        f"{ts} '2024-01-01 00:00:00' + (o_orderkey % 60) * INTERVAL '1' DAY "
        "+ ((o_orderkey * 7919) % 86400) * INTERVAL '1' SECOND"
    )
    return {
        "ga4_events": f"""
SELECT CAST(event_id AS STRING) AS event_id,
 CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'view_item' WHEN 'signup' THEN 'add_to_cart'
  WHEN 'error' THEN 'begin_checkout' ELSE 'purchase' END AS event_name,
 ts AS event_ts,
 CASE WHEN event_id % 97 <> 0 THEN CONCAT('GA1.2.', CAST(user_id AS STRING), '.', CAST(event_id % 2 AS STRING)) END AS ga_client_id,
 CASE WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN CAST(user_id AS STRING) END AS ga_user_id,
 CONCAT('s', CAST(user_id AS STRING)) AS ga_session_id,
 CONCAT('/catalog/', CAST(event_id % 8 AS STRING)) AS page_location,
 CONCAT('Catalog ', CAST(event_id % 8 AS STRING)) AS page_title,
 CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_category,
 {_country('user_id')} AS country,
 CASE event_id % 10 WHEN 0 THEN 'meta' WHEN 1 THEN 'tiktok' WHEN 2 THEN 'google' WHEN 3 THEN 'google' WHEN 4 THEN 'mailchimp'
  WHEN 5 THEN 'direct' WHEN 6 THEN 'google' WHEN 7 THEN 'partner' WHEN 8 THEN 'instagram' END AS source,
 CASE event_id % 10 WHEN 0 THEN 'cpc' WHEN 1 THEN 'cpc' WHEN 2 THEN 'cpc' WHEN 3 THEN 'organic' WHEN 4 THEN 'email'
  WHEN 5 THEN 'none' WHEN 6 THEN 'display' WHEN 7 THEN 'referral' WHEN 8 THEN 'social' END AS medium,
 CONCAT('c', CAST(event_id % 5 AS STRING)) AS campaign,
 CASE WHEN event_type <> 'view' THEN CONCAT('SKU-', CAST(event_id % 40 AS STRING)) END AS item_id,
 value AS value_eur,
 CASE WHEN event_id % 101 <> 0 THEN {_consent('user_id')} END AS consent_status
FROM events""",
        "meta_pixel_events": f"""
SELECT CONCAT('m', CAST(event_id AS STRING)) AS event_id,
 CASE event_type WHEN 'purchase' THEN 'Purchase' WHEN 'signup' THEN 'AddToCart' WHEN 'error' THEN 'InitiateCheckout'
  WHEN 'click' THEN 'ViewContent' ELSE 'PageView' END AS event_name,
 {d['EPOCH']} AS event_time,
 CONCAT('fb.1.', CAST(user_id AS STRING), '.', CAST(event_id % 3 AS STRING)) AS fbp,
 CASE WHEN event_type = 'click' THEN CONCAT('fb.1.c', CAST(event_id AS STRING)) END AS fbc,
 CASE WHEN event_id % 5 < 3 THEN {sha(_PERSON_EMAIL)} END AS em_hash,
 CASE WHEN event_id % 5 = 0 THEN {sha("CONCAT('+3247', CAST(user_id AS STRING))")} END AS ph_hash,
 CONCAT('10.', CAST(user_id % 7 AS STRING), '.', CAST(user_id % 50 AS STRING), '.0') AS client_ip_prefix,
 CASE event_id % 3 WHEN 0 THEN 'Mobile Safari' WHEN 1 THEN 'Chrome' ELSE 'Firefox' END AS client_user_agent,
 'website' AS action_source, 'EUR' AS currency, value AS value,
 {many("CONCAT('SKU-', CAST(event_id % 40 AS STRING))")} AS content_ids,
 {_consent('user_id')} AS consent_status
FROM events""",
        "email_events": f"""
SELECT CONCAT('e', CAST(event_id AS STRING)) AS event_id,
 CASE WHEN event_type = 'click' THEN 'campaign.clicked' WHEN event_type = 'view' THEN 'campaign.opened'
  WHEN event_type = 'error' AND user_id % 5 = 3 THEN 'campaign.unsubscribed' ELSE 'campaign.sent' END AS event_name,
 {micros('ts')} AS event_ts,
 CONCAT('camp_', CAST(event_id % 6 AS STRING)) AS campaign_id,
 CASE WHEN user_id % 5 <> 4 THEN CONCAT('sub_', CAST(user_id AS STRING)) END AS subscriber_id,
 {sha(_PERSON_EMAIL)} AS email_hash,
 CASE WHEN event_type = 'click' THEN CONCAT('https://shop.example.com/', CAST(event_id % 8 AS STRING)) END AS url,
 {_consent('user_id')} AS consent_status
FROM events""",
        # Each customer is delivered twice; the second delivery may change e-mail,
        # consent or country, and for every fourth customer only the creation time.
        "shopify_customers": f"""
SELECT c_custkey AS customer_id, CONCAT(' User', CAST(c_custkey AS STRING), '@Example.com ') AS email,
 CAST(NULL AS STRING) AS first_name, c_name AS last_name, TRUE AS accepts_marketing,
 {stamp(delivery)} AS accepts_marketing_updated_at,
 {_country('c_nationkey')} AS country, CAST(NULL AS BIGINT) AS orders_count, CAST(NULL AS DOUBLE) AS total_spent,
 {stamp(created)} AS created_at,
 CASE WHEN c_custkey % 10 IN (5, 6) THEN 'anonymous' ELSE {_consent('c_custkey')} END AS consent_status
FROM customer
UNION ALL
SELECT c_custkey, CONCAT(CASE WHEN c_custkey % 7 = 0 THEN 'moved' ELSE 'User' END, CAST(c_custkey AS STRING), '@Example.com ') AS email,
 CAST(NULL AS STRING) AS first_name, c_name AS last_name, c_acctbal > 0 AS accepts_marketing,
 {stamp(f"{delivery} + CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 40 END * INTERVAL '1' DAY")} AS accepts_marketing_updated_at,
 {_country('(c_nationkey + c_custkey)')} AS country, CAST(NULL AS BIGINT) AS orders_count, CAST(NULL AS DOUBLE) AS total_spent,
 {stamp(f"{created} + INTERVAL '1' DAY")} AS created_at,
 {_consent('c_custkey')} AS consent_status
FROM customer""",
        "shopify_orders": f"""
SELECT CONCAT('ord_', CAST(o_orderkey AS STRING)) AS order_id, o_custkey AS customer_id,
 CONCAT(' User', CAST(o_custkey AS STRING), '@Example.com ') AS email,
 {stamp(order_time)} AS created_at, o_totalprice AS total_price_eur, 'EUR' AS currency,
 CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'refunded' END AS financial_status,
 CASE o_orderstatus WHEN 'F' THEN 'fulfilled' ELSE 'unfulfilled' END AS fulfillment_status,
 {_country('o_custkey')} AS country, {_consent('o_custkey')} AS consent_status
FROM orders""",
        "shopify_line_items": """
SELECT CONCAT('ord_', CAST(l_orderkey AS STRING)) AS order_id, CONCAT('SKU-', CAST(l_partkey AS STRING)) AS sku,
 CONCAT('Part ', CAST(l_partkey AS STRING)) AS title, CAST(l_returnflag AS STRING) AS product_type,
 CAST(l_quantity AS INT) AS quantity, l_extendedprice AS price_eur
FROM lineitem""",
        "audit_pipeline_runs": f"""
SELECT CONCAT('run_', CAST(event_id AS STRING)) AS run_id,
 CASE event_id % 6 WHEN 0 THEN 'ga4' WHEN 1 THEN 'meta' WHEN 2 THEN 'shopify' WHEN 3 THEN 'mailchimp' WHEN 4 THEN 'dbt' ELSE 'soda' END AS pipeline,
 CASE WHEN event_id % 6 < 4 THEN 'bronze' WHEN event_id % 6 = 4 THEN 'build' ELSE 'soda scan' END AS step,
 'dev' AS environment, ts AS start_ts,
 CASE WHEN event_id % 50 <> 1 THEN ts + CAST(floor(value) AS INT) * INTERVAL '1' SECOND END AS end_ts,
 CASE WHEN event_id % 50 <> 1 THEN CAST(floor(value) AS BIGINT) * 1000 END AS duration_ms,
 CASE WHEN event_id % 50 = 1 THEN 'running' WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
 CAST(NULL AS BIGINT) AS rows_in, CAST(user_id AS BIGINT) AS rows_out,
 CASE WHEN event_type = 'error' THEN 'boom' END AS error, props AS extra
FROM events""",
    }


BASE_TABLE = {
    "ga4_events": "events",
    "meta_pixel_events": "events",
    "email_events": "events",
    "shopify_customers": "customer",
    "shopify_orders": "orders",
    "shopify_line_items": "lineitem",
    "audit_pipeline_runs": "events",
}


def load_bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy bronze frames over the parquet files in `sf_dir`."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(BASE_TABLE.values())}
    out = {}
    for name, text in bronze_sql("spark").items():
        base = BASE_TABLE[name]
        out[name] = spark.sql(text.replace(f"FROM {base}", "FROM {base}"), base=frames[base])
    return out
