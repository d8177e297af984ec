"""The models, wired together.

`build(name)` is the lazy plan of a model over bronze and the stored tables;
`table(name)` is the same model written once under this warehouse's folder and
read back. Edges, graph, touches, orders with their buyers, the touch axis, the channels of a
conversion and the session summary are taken from storage, since several models read each of them;
everything else is inlined, and Catalyst prunes what a query does not use.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from wayfare.operators import attribution, dimensions, identity, sessions, staging, touchpoints
from wayfare.params import Params
from wayfare.session import new_run_dir
from wayfare.sources.bronze import read_bronze
from wayfare.sources.published import publish

MARTS = [
    "dim_users",
    "dim_channels",
    "dim_dates",
    "fct_touchpoints",
    "fct_sessions",
    "fct_conversions",
    "fct_funnel_steps",
]


# Each line reads only tables of the lines above it.
BUILD_ORDER = [
    ["repeated_orders", "dim_channels", "dim_dates"],
    ["identity_edges"],
    ["identity_graph"],
    ["all_touches", "buyer_orders", "session_summary", "dim_users"],
    ["touch_axis", "fct_touchpoints", "fct_sessions", "fct_funnel_steps"],
    ["conversion_channels"],
    ["fct_conversions"],
]

# Bronze tables the models read.
MODELLED = [
    "ga4_events",
    "meta_pixel_events",
    "shopify_customers",
    "shopify_orders",
    "email_events",
]


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        bronze: dict[str, DataFrame],
        params: Params = Params(),
        root: str | None = None,
    ):
        self.spark = spark
        self.bronze = bronze
        self.params = params
        self.root = root or new_run_dir(spark, "warehouse")
        self._stored: dict[str, DataFrame] = {}

    @classmethod
    def over_folder(
        cls, spark: SparkSession, bronze_root: str, root: str, params: Params = Params()
    ) -> Warehouse:
        """A warehouse over delivered bronze folders, publishing under `root`.

        The delivery day stays on the rows: it orders the deliveries of an order.
        """
        bronze = {name: read_bronze(spark, bronze_root, name) for name in MODELLED}
        return cls(spark, bronze, params, root)

    def build(self, name: str) -> DataFrame:
        return MODELS[name](self)

    def table(self, name: str) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = publish(self.build(name), self.root, name)
        return self._stored[name]

    def is_stored(self, name: str) -> bool:
        return name in self._stored

    def share(self, other: Warehouse, *names: str) -> None:
        """Take stored tables that would come out the same from another warehouse."""
        self._stored |= {name: other.table(name) for name in names}

    def publish_marts(self) -> dict[str, DataFrame]:
        """Build everything; tables that do not read each other are written side by side,
        so that one job's last tasks do not leave the cluster idle."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            for tables in BUILD_ORDER:
                list(pool.map(self.table, tables))
        return {name: self._stored[name] for name in MARTS}


def _date_bounds(w: Warehouse) -> DataFrame:
    return w.spark.sql(
        "SELECT :first AS start_date, :last AS end_date",
        args={"first": w.params.start_date, "last": w.params.end_date},
    )


MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_ga4_events": lambda w: staging.web_events(w.bronze["ga4_events"]),
    "stg_meta_pixel_events": lambda w: staging.pixel_events(w.bronze["meta_pixel_events"]),
    "stg_email_events": lambda w: staging.email_events(w.bronze["email_events"]),
    "repeated_orders": lambda w: staging.repeated_orders(w.bronze["shopify_orders"]),
    "stg_shopify_orders": lambda w: staging.orders(w.bronze["shopify_orders"], w.table("repeated_orders")),
    "stg_shopify_customers": lambda w: staging.customers(w.bronze["shopify_customers"]),
    "identity_edges": lambda w: identity.identity_edges(
        w.build("stg_ga4_events"),
        w.build("stg_meta_pixel_events"),
        w.build("stg_email_events"),
        w.build("stg_shopify_customers"),
        w.build("stg_shopify_orders"),
        w.params.strict_consent,
    ),
    "identity_graph": lambda w: identity.identity_graph(w.table("identity_edges")),
    "identity_kpass": lambda w: identity.identity_kpass(
        w.table("identity_edges"), w.params.identity_passes
    ),
    "events_with_user": lambda w: sessions.events_with_user(
        w.build("stg_ga4_events"), w.table("identity_graph")
    ),
    "session_gaps": lambda w: sessions.session_gaps(
        w.build("stg_ga4_events"), w.table("identity_graph"), w.params.session_timeout_minutes
    ),
    "sessions_stitched": lambda w: sessions.sessions_stitched(
        w.build("stg_ga4_events"), w.table("identity_graph"), w.params.session_timeout_minutes
    ),
    "sessions_known": lambda w: sessions.sessions_stitched(
        w.build("stg_ga4_events"),
        w.table("identity_graph"),
        w.params.session_timeout_minutes,
        known_only=True,
    ),
    "session_summary": lambda w: sessions.session_summary(w.build("sessions_known")),
    "fct_sessions": lambda w: sessions.session_facts(w.table("session_summary")),
    "funnel_steps": lambda w: sessions.funnel_steps(w.table("session_summary")),
    "fct_funnel_steps": lambda w: sessions.channel_funnel(w.table("session_summary")),
    "all_touches": lambda w: touchpoints.all_touches(
        w.build("stg_ga4_events"),
        w.build("stg_meta_pixel_events"),
        w.build("stg_email_events"),
        w.table("identity_graph"),
    ),
    "buyer_orders": lambda w: touchpoints.buyer_orders(
        w.build("stg_shopify_orders"), w.table("identity_graph")
    ),
    "conversions": lambda w: touchpoints.conversions(w.table("buyer_orders")),
    "touchpoints_enriched": lambda w: touchpoints.touchpoints_enriched(
        w.table("all_touches"), w.build("conversions"), w.params.attribution_window_days
    ),
    "fct_touchpoints": lambda w: touchpoints.touchpoint_facts(w.build("touchpoints_enriched")),
    "touch_axis": lambda w: attribution.touch_axis(
        w.table("all_touches"), w.build("conversions"), w.params.attribution_window_days
    ),
    "attribution_ranked": lambda w: attribution.attribution_ranked(
        w.table("touch_axis"), w.params.attribution_window_days
    ),
    "touchpoints_attribution": lambda w: attribution.touchpoints_attribution(
        w.build("attribution_ranked")
    ),
    "attribution_time_decay": lambda w: attribution.time_decay(
        w.table("all_touches"),
        w.build("conversions"),
        w.table("touch_axis"),
        w.params.attribution_window_days,
        w.params.half_life_days,
    ),
    "attribution_time_decay_channels": lambda w: attribution.time_decay_channels(
        w.table("touch_axis"), w.params.attribution_window_days, w.params.half_life_days
    ),
    "attribution_first_touch": lambda w: attribution.end_touch(w.table("touch_axis"), "first_touch"),
    "attribution_last_touch": lambda w: attribution.end_touch(w.table("touch_axis"), "last_touch"),
    "conversion_channels": lambda w: attribution.conversion_channels(w.table("touch_axis")),
    "attribution_pivot": lambda w: attribution.pivot_channels(w.table("conversion_channels")),
    "fct_conversions": lambda w: attribution.conversion_facts(
        w.table("buyer_orders"), w.build("attribution_pivot")
    ),
    "dim_users": lambda w: dimensions.dim_users(
        w.table("identity_graph"), w.build("stg_shopify_customers"), w.params.as_of
    ),
    "dim_users_scd2": lambda w: dimensions.dim_users_scd2(
        w.table("identity_graph"), staging.customer_versions(w.bronze["shopify_customers"])
    ),
    "facts_asof_user": lambda w: dimensions.facts_asof_user(
        w.build("conversions"), w.build("dim_users_scd2")
    ),
    "dim_channels": lambda w: dimensions.dim_channels(w.spark),
    "dim_dates": lambda w: dimensions.dim_dates(_date_bounds(w)),
    "identity_candidates": lambda w: identity.identity_candidates(w.build("stg_meta_pixel_events")),
}
