"""Bronze schemas, as delivered. Reads never infer."""

# Column names and types of the bronze tables.
BRONZE = {
    "ga4_events": (
        "event_id string, event_name string, event_ts timestamp_ntz, ga_client_id string, "
        "ga_user_id string, ga_session_id string, page_location string, page_title string, "
        "device_category string, country string, source string, medium string, "
        "campaign string, item_id string, value_eur double, consent_status string"
    ),
    "meta_pixel_events": (
        "event_id string, event_name string, event_time bigint, fbp string, fbc string, "
        "em_hash string, ph_hash string, client_ip_prefix string, client_user_agent string, "
        "action_source string, currency string, value double, content_ids array<string>, "
        "consent_status string"
    ),
    "shopify_customers": (
        "customer_id bigint, email string, first_name string, last_name string, "
        "accepts_marketing boolean, accepts_marketing_updated_at string, country string, "
        "orders_count bigint, total_spent double, created_at string, consent_status string"
    ),
    "shopify_orders": (
        "order_id string, customer_id bigint, email string, created_at string, "
        "total_price_eur double, currency string, financial_status string, "
        "fulfillment_status string, country string, consent_status string"
    ),
    "shopify_line_items": (
        "order_id string, sku string, title string, product_type string, "
        "quantity int, price_eur double"
    ),
    "email_events": (
        "event_id string, event_name string, event_ts string, campaign_id string, "
        "subscriber_id string, email_hash string, url string, consent_status string"
    ),
    "meta_ad_insights": (
        "ad_id string, ad_name string, campaign_id string, campaign_name string, "
        "adset_id string, adset_name string, impressions bigint, reach bigint, clicks bigint, "
        "spend double, ctr double, cpc double, actions array<struct<action_type:string,value:string>>, "
        "rescued map<string,string>"
    ),
    "ga4_report": (
        "event_name string, device_category string, country string, source string, medium string, "
        "campaign string, page_location string, event_date string, event_count bigint, sessions bigint, "
        "total_users bigint, rescued map<string,string>"
    ),
    "audit_pipeline_runs": (
        "run_id string, pipeline string, step string, environment string, "
        "start_ts timestamp_ntz, end_ts timestamp_ntz, duration_ms bigint, status string, "
        "rows_in bigint, rows_out bigint, error string, extra string"
    ),
}

# Where each bronze table lives: <root>/<source>/<table>/dt=YYYY-MM-DD/
LAYOUT = {
    "ga4_events": ("ga4", "events"),
    "meta_pixel_events": ("meta", "pixel_events"),
    "shopify_customers": ("shopify", "customers"),
    "shopify_orders": ("shopify", "orders"),
    "shopify_line_items": ("shopify", "line_items"),
    "email_events": ("email", "events"),
    "meta_ad_insights": ("meta", "ad_insights"),
    "ga4_report": ("ga4", "report"),
}
