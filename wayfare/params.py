"""Model parameters and the fixed values every layer shares."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime


@dataclass(frozen=True)
class Params:
    attribution_window_days: int = 30
    session_timeout_minutes: int = 30
    identity_passes: int = 5
    half_life_days: float = 7.0
    lookback_days: int = 90
    start_date: date = date(2025, 10, 1)
    end_date: date = date(2026, 6, 30)
    # The clock. Reports and defaults read this, never the wall clock, so a
    # rerun over the same input gives the same rows.
    as_of: datetime = datetime(2026, 6, 30)
    # When set, the login edge also asks for a granted customer record.
    strict_consent: bool = False


# Consent domain.
GRANTED = "granted"
ANONYMOUS = "anonymous"
WITHDRAWN = "withdrawn"

# Node prefixes of the identity graph.
WEB_COOKIE = "ga_client"
CUSTOMER = "shopify_customer"
PIXEL_COOKIE = "meta_fbp"
SUBSCRIBER = "email_subscriber"
EMAIL_HASH = "email_hash"
NODE_SOURCES = [WEB_COOKIE, CUSTOMER, PIXEL_COOKIE, SUBSCRIBER, EMAIL_HASH]
DEVICE = "device"

# Channel dimension (key, source, medium, display name, group,
# paid, conversion multiplier).
CHANNELS = [
    ("paid_social", "meta", "cpc", "Meta Ads", "Paid Social", True, 1.0),
    ("paid_social_tt", "tiktok", "cpc", "TikTok Ads", "Paid Social", True, 0.7),
    ("paid_search", "google", "cpc", "Google Ads Search", "Paid Search", True, 1.4),
    ("organic_search", "google", "organic", "Google Organic", "Organic Search", False, 1.2),
    ("email", "mailchimp", "email", "Email Campaigns", "Email", False, 2.8),
    ("direct", "direct", "none", "Direct", "Direct", False, 2.0),
    ("display", "google", "display", "Google Display", "Display", True, 0.5),
    ("referral", "partner", "referral", "Partner Referral", "Referral", False, 1.3),
    ("social_organic", "instagram", "social", "Instagram Organic", "Organic Social", False, 0.8),
]
CHANNEL_KEYS = [c[0] for c in CHANNELS]

# Fixed values: (medium, source or any) -> channel, first match wins.
CHANNEL_RULES = [
    ("cpc", "meta", "paid_social"),
    ("cpc", "tiktok", "paid_social_tt"),
    ("cpc", "google", "paid_search"),
    ("organic", None, "organic_search"),
    ("email", None, "email"),
    ("display", None, "display"),
    ("referral", None, "referral"),
    ("social", None, "social_organic"),
]
DEFAULT_CHANNEL = "direct"

# Funnel steps, in order, and the web event that reaches each.
FUNNEL_STEPS = [
    ("step_1_viewed", "page_view"),
    ("step_2_pdp", "view_item"),
    ("step_3_atc", "add_to_cart"),
    ("step_4_checkout", "begin_checkout"),
    ("step_5_purchase", "purchase"),
]
FUNNEL_COUNTS = [
    "users_visited",
    "users_pdp",
    "users_add_to_cart",
    "users_checkout",
    "users_purchased",
]

# Attribution models.
MODELS = ["first_touch", "last_touch", "linear", "position_based"]

# Source key -> display name, and the keys a display name covers.
SOURCE_LABELS = {
    "ga4": "GA4",
    "meta": "Meta Ads",
    "shopify": "Shopify",
    "mailchimp": "Mailchimp",
    "email": "Mailchimp",
}
DISPLAY_SOURCES = ["GA4", "Meta Ads", "Shopify", "Mailchimp"]

# Months a bronze delivery is kept, per source.
RETENTION_MONTHS = {"ga4": 26, "meta": 13}
UNSUBSCRIBED_MONTHS = 36
