"""Identity resolution: match rules -> edges -> people."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.keys import node_id
from wayfare.functions.skew import splittable
from wayfare.operators.components import connected_components, merged_roots
from wayfare.params import (
    CUSTOMER,
    DEVICE,
    EMAIL_HASH,
    GRANTED,
    PIXEL_COOKIE,
    SUBSCRIBER,
    WEB_COOKIE,
)
from wayfare.session import new_run_dir, store

EDGE_COLUMNS = ["raw_id_src", "raw_id_dst", "match_type", "confidence"]


def _rule(df: DataFrame, a: Column, b: Column, match_type: str) -> DataFrame:
    return df.select(a.alias("id_a"), b.alias("id_b"), F.lit(match_type).alias("match_type"))


def _granted(df: DataFrame) -> DataFrame:
    return df.where(F.col("consent_status") == GRANTED)


def _web_rules(web: DataFrame, allowed: DataFrame | None) -> DataFrame:
    """The cookie itself and, once logged in, its customer: two rules from one scan."""
    login = F.col("ga_user_id")
    if allowed is not None:
        ids = allowed.select(
            F.col("shopify_customer_id").cast("string").alias("ga_user_id"),
            F.lit(True).alias("_allowed"),
        )
        web = web.join(ids, "ga_user_id", "left")
        login = F.when(F.col("_allowed"), login)
    cookie = node_id(WEB_COOKIE, F.col("ga_client_id"))
    ends = F.array(
        F.struct(cookie.alias("id_b"), F.lit("self").alias("match_type")),
        F.struct(
            node_id(CUSTOMER, login).alias("id_b"), F.lit("logged_in_user_id").alias("match_type")
        ),
    )
    return web.select(cookie.alias("id_a"), F.explode(ends).alias("e")).select("id_a", "e.*")


def identity_edges(
    web: DataFrame,
    pixel: DataFrame,
    email: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    strict_consent: bool = False,
) -> DataFrame:
    """All deterministic matches, in both directions, without duplicates.

    The rules run over raw events, so the one shuffle is a distinct that each
    map task has already combined; mirroring afterwards needs no second one,
    since a rule always points from one kind of id to another.
    """
    hashed = node_id(EMAIL_HASH, F.col("email_hash"))
    buyer = node_id(CUSTOMER, F.col("shopify_customer_id"))
    rules = [
        _rule(_granted(customers), buyer, hashed, "email_hash"),
        _rule(_granted(pixel), node_id(PIXEL_COOKIE, F.col("fbp")), hashed, "email_hash"),
        _rule(_granted(email), node_id(SUBSCRIBER, F.col("subscriber_id")), hashed, "email_hash"),
        _web_rules(_granted(web), _granted(customers) if strict_consent else None),
        # Every buyer is at least a node of its own, whatever the consent: the
        # grant governs linking, not the existence of a pseudonymous id.
        _rule(orders, buyer, buyer, "self"),
    ]
    matches = (
        reduce(DataFrame.unionByName, rules)
        .where(F.col("id_a").isNotNull() & F.col("id_b").isNotNull())
        .distinct()
    )
    forward = F.struct(F.col("id_a").alias("raw_id_src"), F.col("id_b").alias("raw_id_dst"))
    backward = F.struct(F.col("id_b").alias("raw_id_src"), F.col("id_a").alias("raw_id_dst"))
    ends = F.when(F.col("id_a") == F.col("id_b"), F.array(forward)).otherwise(
        F.array(forward, backward)
    )
    return matches.select(F.explode(ends).alias("e"), "match_type").select(
        "e.raw_id_src", "e.raw_id_dst", "match_type", F.lit("high").alias("confidence")
    )


def person_columns(raw_id: Column, label: Column) -> list[Column]:
    """Source and value parsed from the id, and the pseudonymous person id."""
    prefix = F.split_part(raw_id, F.lit(":"), F.lit(1))
    return [
        raw_id.alias("raw_id"),
        prefix.alias("raw_source"),
        F.substring(raw_id, F.length(prefix) + 2, F.length(raw_id)).alias("raw_value"),
        F.md5(label).alias("unified_user_id"),
    ]


def identity_graph(edges: DataFrame) -> DataFrame:
    """One row per identifier with the person it belongs to, at any distance."""
    pairs = edges.select(F.col("raw_id_src").alias("src"), F.col("raw_id_dst").alias("dst"))
    parts = connected_components(pairs)
    return parts.select(*person_columns(F.col("id"), F.col("root")))


def grown_graph(graph: DataFrame, edges: DataFrame) -> DataFrame:
    """The stored graph after further edges: the same as a rebuild over all edges.

    Edges may repeat known ones. A person is named after their smallest id, so
    the row whose own pseudonym is the person's holds the root. The stored graph
    is only scanned: it meets the ends of the new edges, and the people that
    were merged, both as small as the delivery.
    """
    run = new_run_dir(graph.sparkSession, "grown")
    person = F.col("unified_user_id")
    pairs = edges.select(F.col("raw_id_src").alias("src"), F.col("raw_id_dst").alias("dst"))
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("raw_id")).distinct()
    met = store(graph.join(ends, "raw_id").select("raw_id", "unified_user_id"), f"{run}/met")
    roots = graph.where(F.md5("raw_id") == person).select(
        F.col("raw_id").alias("root"), "unified_user_id"
    )
    labels = store(
        met.join(roots, "unified_user_id").select(F.col("raw_id").alias("id"), "root"), f"{run}/labels"
    )
    parts = store(merged_roots(pairs, labels), f"{run}/parts")

    moved = parts.where(F.col("was_root") & (F.col("id") != F.col("root"))).select(
        F.md5("id").alias("unified_user_id"), F.md5("root").alias("_now")
    )
    kept = graph.join(moved, "unified_user_id", "left").withColumn(
        "unified_user_id", F.coalesce("_now", "unified_user_id")
    )
    fresh = parts.where(~F.col("was_root")).select(*person_columns(F.col("id"), F.col("root")))
    return kept.select(*graph.columns).unionByName(fresh.select(*graph.columns))


def identity_kpass(edges: DataFrame, passes: int) -> DataFrame:
    """Exactly `passes` rounds of "take the smallest label among the neighbours".

    Kept for parity with label propagation cut off after a fixed number of
    rounds: a node's own label counts only if it has a self-edge, so the result
    is the minimum over walks of exactly that length, not the component.
    """
    links = edges.select("raw_id_src", "raw_id_dst").distinct()
    labels = links.groupBy("raw_id_src").agg(F.min("raw_id_dst").alias("label"))
    for _ in range(passes - 1):
        seen = labels.select(F.col("raw_id_src").alias("id"), "label")
        labels = (
            links.join(seen, splittable(F.col("raw_id_dst"), F.col("id")))
            .groupBy("raw_id_src")
            .agg(F.min("label").alias("label"))
        )
    return labels.select(*person_columns(F.col("raw_id_src"), F.col("label")))


def identity_candidates(pixel: DataFrame) -> DataFrame:
    """Device-fingerprint hints, recorded as probabilistic and never merged.

    Each cookie points at its device, so a device shared by many cookies gives
    one row per cookie rather than one per pair of cookies.
    """
    device = F.sha2(F.concat_ws("|", F.col("ip_prefix"), F.col("user_agent")), 256)
    return (
        _granted(pixel)
        .where(
            F.col("fbp").isNotNull()
            & F.col("ip_prefix").isNotNull()
            & F.col("user_agent").isNotNull()
        )
        .select(
            node_id(PIXEL_COOKIE, F.col("fbp")).alias("raw_id_src"),
            node_id(DEVICE, device).alias("raw_id_dst"),
        )
        .distinct()
        .select(
            "raw_id_src",
            "raw_id_dst",
            F.lit("device_fingerprint").alias("match_type"),
            F.lit("probabilistic").alias("confidence"),
        )
    )


def people(graph: DataFrame, source: str, as_name: str) -> DataFrame:
    """Lookup from one kind of identifier to the person."""
    known = (
        (F.col("raw_source") == source)
        & F.col("raw_value").isNotNull()
        & F.col("unified_user_id").isNotNull()
    )
    return graph.where(known).select(F.col("raw_value").alias(as_name), "unified_user_id")
