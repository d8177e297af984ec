"""The data contracts: which checks hold for which table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from wayfare.operators import quality, sessions
from wayfare.operators.quality import Check
from wayfare.params import ANONYMOUS, GRANTED, MODELS, NODE_SOURCES
from wayfare.plans.warehouse import Warehouse

# Columns that are never NULL.
NOT_NULL = {
    "bronze.ga4_events": ["event_id", "event_name"],
    "bronze.meta_pixel_events": ["event_id"],
    "bronze.shopify_customers": ["customer_id"],
    "bronze.shopify_orders": ["order_id", "customer_id"],
    "bronze.email_events": ["event_id"],
    "stg_ga4_events": ["event_id", "channel_key"],
    "stg_meta_pixel_events": ["event_id"],
    "stg_shopify_customers": ["shopify_customer_id"],
    "stg_shopify_orders": ["order_id", "shopify_customer_id"],
    "stg_email_events": ["event_id"],
    "identity_edges": ["raw_id_src", "raw_id_dst", "match_type"],
    "identity_graph": ["raw_id", "raw_source", "unified_user_id"],
    "sessions_stitched": ["event_id", "channel_key", "stitched_session_id"],
    "touchpoints_attribution": ["conversion_id", "touchpoint_id", "attribution_model"],
    "funnel_steps": ["unified_user_id"],
    "dim_users": ["unified_user_id", "consent_status"],
    "dim_channels": ["channel_key"],
    "dim_dates": ["date_day"],
    "fct_touchpoints": [
        "touchpoint_id", "source", "unified_user_id", "conversion_id", "channel_key",
    ],
    "fct_sessions": ["stitched_session_id"],
    "fct_conversions": ["conversion_id", "unified_user_id"],
    "fct_funnel_steps": ["channel_key"],
}

# Closed value lists.
ACCEPTED = [
    (
        "bronze.ga4_events",
        "event_name",
        ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase", "session_start"),
    ),
    ("identity_edges", "match_type", ("email_hash", "logged_in_user_id", "self")),
    ("identity_edges", "confidence", ("high", "medium")),
    ("identity_graph", "raw_source", tuple(NODE_SOURCES)),
    ("fct_touchpoints", "source", ("ga4", "meta", "email")),
    ("touchpoints_attribution", "attribution_model", tuple(MODELS)),
    ("funnel_steps", "step_5_purchase", (0, 1)),
    ("dim_users", "consent_status", (GRANTED, ANONYMOUS)),
]

# Keys that occur once.
UNIQUE = [
    ("bronze.ga4_events", "event_id"),
    ("bronze.meta_pixel_events", "event_id"),
    ("bronze.shopify_customers", "customer_id"),
    ("bronze.shopify_orders", "order_id"),
    ("bronze.email_events", "event_id"),
    ("stg_ga4_events", "event_id"),
    ("stg_meta_pixel_events", "event_id"),
    ("stg_shopify_customers", "shopify_customer_id"),
    ("stg_shopify_orders", "order_id"),
    ("stg_email_events", "event_id"),
    ("identity_graph", "raw_id"),
    ("sessions_stitched", "event_id"),
    ("dim_users", "unified_user_id"),
    ("dim_channels", "channel_key"),
    ("dim_dates", "date_day"),
    ("fct_funnel_steps", "channel_key"),
]

# Child column -> parent column.
RELATIONSHIPS = [
    ("bronze.shopify_orders", "customer_id", "bronze.shopify_customers", "customer_id"),
    ("stg_ga4_events", "channel_key", "dim_channels", "channel_key"),
    ("stg_shopify_orders", "shopify_customer_id", "stg_shopify_customers", "shopify_customer_id"),
    ("fct_touchpoints", "channel_key", "dim_channels", "channel_key"),
    ("fct_sessions", "unified_user_id", "dim_users", "unified_user_id"),
    ("fct_conversions", "unified_user_id", "dim_users", "unified_user_id"),
    ("fct_funnel_steps", "channel_key", "dim_channels", "channel_key"),
]

# Combinations that occur once.
UNIQUE_COMBINATION = [("funnel_steps", ["unified_user_id", "stitched_session_id"])]

# Value ranges.
BETWEEN = [
    ("touchpoints_attribution", "weight", 0.0, 1.0),
    ("fct_conversions", "revenue_linear", 0.0, None),
]

# Table sizes.
ROW_COUNT = [
    ("dim_users", 1, None),
    ("dim_channels", 5, 50),
    ("dim_dates", 1, None),
    ("fct_touchpoints", 1, None),
    ("fct_sessions", 1, None),
    ("fct_conversions", 1, None),
    ("fct_funnel_steps", 5, 50),
]

# Smallest allowed minimum.
MINIMUM = [
    ("fct_conversions", "conversion_value_eur", 0.0),
    ("fct_sessions", "session_duration_sec", 0.0),
    ("fct_funnel_steps", "users_visited", 1.0),
]

# Greatest age, in days, of the newest row.
FRESHNESS = [("fct_conversions", "conversion_ts", 32.0)]

# The mart scan, per table: row-level checks and unique keys.
SCAN = {
    "dim_users": (
        [
            Check("row_count", low=1),
            Check("not_null", "consent_status"),
            Check("accepted_values", "consent_status", values=(GRANTED, ANONYMOUS)),
        ],
        ["unified_user_id"],
    ),
    "dim_channels": ([Check("row_count", low=5, high=50)], ["channel_key"]),
    "fct_conversions": (
        [
            Check("row_count", low=1),
            Check("not_null", "conversion_id"),
            Check("not_null", "unified_user_id"),
            Check("min", "conversion_value_eur", low=0.0),
            Check("freshness", "conversion_ts", high=32.0),
        ],
        [],
    ),
    "fct_touchpoints": (
        [
            Check("row_count", low=1),
            Check("not_null", "touchpoint_id"),
            Check("not_null", "channel_key"),
        ],
        [],
    ),
    "fct_sessions": (
        [
            Check("row_count", low=1),
            Check("not_null", "stitched_session_id"),
            Check("min", "session_duration_sec", low=0.0),
        ],
        [],
    ),
    "fct_funnel_steps": (
        [Check("row_count", low=5, high=50), Check("min", "users_visited", low=1.0)],
        [],
    ),
}

# Models that stay views: checked where they are computed, not stored.
_VIEWS = ("stg_", "sessions_stitched", "touchpoints_attribution", "funnel_steps")


def _source(w: Warehouse, table: str) -> DataFrame:
    if table.startswith("bronze."):
        return w.bronze[table.removeprefix("bronze.")]
    return w.build(table) if table.startswith(_VIEWS) else w.table(table)


# Tables that other models read: stored for any check.
_STORED = ("identity_edges", "identity_graph")

# The models that are projections and sums of the session summary.
_OF_SUMMARY = {
    "fct_sessions": sessions.session_facts,
    "funnel_steps": sessions.funnel_steps,
    "fct_funnel_steps": sessions.channel_funnel,
}


def _once(w: Warehouse, tables: list[str]) -> dict[str, DataFrame]:
    """`tables` for a check that reads each of them once.

    What is stored is read. Any other table is computed for the few columns that
    are checked, and not gathered and written with all of them first. The session
    summary is stored where several of the tables come from it.
    """

    def fresh(table: str) -> bool:
        return not w.is_stored(table)

    of_summary = [t for t in tables if t in _OF_SUMMARY and fresh(t)]

    def source(table: str) -> DataFrame:
        if table.startswith("bronze.") or table in _STORED or not fresh(table):
            return _source(w, table)
        if of_summary == [table] and fresh("session_summary"):
            return _OF_SUMMARY[table](w.build("session_summary"))
        return w.build(table)

    return {t: source(t) for t in tables}


def _row_checks(w: Warehouse, checks: dict[str, list[Check]]) -> DataFrame:
    parts = [
        quality.run_checks(df, t, checks[t], w.params.as_of)
        for t, df in _once(w, list(checks)).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _grouped(rows) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for table, check in rows:
        out.setdefault(table, []).append(check)
    return out


def check_not_null(w: Warehouse) -> DataFrame:
    return _row_checks(w, {t: [Check("not_null", c) for c in cs] for t, cs in NOT_NULL.items()})


def check_accepted_values(w: Warehouse) -> DataFrame:
    return _row_checks(
        w, _grouped((t, Check("accepted_values", c, values=v)) for t, c, v in ACCEPTED)
    )


def check_between(w: Warehouse) -> DataFrame:
    return _row_checks(
        w, _grouped((t, Check("between", c, low=lo, high=hi)) for t, c, lo, hi in BETWEEN)
    )


def check_row_count(w: Warehouse) -> DataFrame:
    return _row_checks(
        w, _grouped((t, Check("row_count", low=lo, high=hi)) for t, lo, hi in ROW_COUNT)
    )


def check_min(w: Warehouse) -> DataFrame:
    return _row_checks(w, _grouped((t, Check("min", c, low=lo)) for t, c, lo in MINIMUM))


def check_freshness(w: Warehouse) -> DataFrame:
    return _row_checks(w, _grouped((t, Check("freshness", c, high=d)) for t, c, d in FRESHNESS))


def check_unique(w: Warehouse) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [quality.check_unique(_source(w, t), t, [c]) for t, c in UNIQUE]
    )


def check_unique_combination(w: Warehouse) -> DataFrame:
    sources = _once(w, [t for t, _ in UNIQUE_COMBINATION])
    return reduce(
        DataFrame.unionByName,
        [quality.check_unique(sources[t], t, cs) for t, cs in UNIQUE_COMBINATION],
    )


def check_relationships(w: Warehouse) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            quality.check_relationship(_source(w, t), t, c, _source(w, p), k)
            for t, c, p, k in RELATIONSHIPS
        ],
    )


def quality_scan(w: Warehouse) -> DataFrame:
    """The whole mart scan: every table is read once for all its row-level checks."""
    parts = []
    for table, (checks, keys) in SCAN.items():
        parts.append(quality.run_checks(_source(w, table), table, checks, w.params.as_of))
        parts += [quality.check_unique(_source(w, table), table, [k]) for k in keys]
    return reduce(DataFrame.unionByName, parts)
