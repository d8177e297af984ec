import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare.operators import components as rounds
from wayfare.operators import identity, staging
from wayfare.operators.components import _large_star, _small_star, connected_components
from wayfare.session import store
from wayfare.sources.schemas import BRONZE


def components(spark, pairs):
    df = spark.createDataFrame(pairs, "src string, dst string")
    return {r.id: r.root for r in connected_components(df).collect()}


def reference(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


CHAIN = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
SHAPES = {
    "chain": CHAIN,
    "star": [("hub", f"leaf{i}") for i in range(40)],
    "star_of_large_ids": [("zz", f"a{i}") for i in range(40)],
    "clique": [(f"c{i}", f"c{j}") for i in range(8) for j in range(8)],
    "loners": [("x", "x"), ("y", "y")],
    "no_self_edges": [("sub", "mail"), ("pix", "mail")],
    "two_cliques_one_bridge": [("a1", "a2"), ("a2", "a3"), ("b1", "b2"), ("b2", "b3"), ("a3", "b1")],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_components_of_shape(spark, shape):
    assert components(spark, SHAPES[shape]) == reference(SHAPES[shape])


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graph_in_any_edge_order(spark, seed):
    rng = random.Random(seed)
    nodes = [f"v{i}" for i in range(150)]
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(120)]
    # A hub that holds a third of all edges.
    pairs += [("v77", rng.choice(nodes)) for _ in range(60)]
    want = reference(pairs)
    assert components(spark, pairs) == want
    rng.shuffle(pairs)
    assert components(spark, [(b, a) for a, b in pairs]) == want


def test_person_id_and_parsing(spark):
    edges = spark.createDataFrame(
        [("ga_client:GA:1:2", "shopify_customer:7", "logged_in_user_id", "high")],
        identity.EDGE_COLUMNS,
    )
    got = {r.raw_id: r for r in identity.identity_graph(edges).collect()}
    cookie = got["ga_client:GA:1:2"]
    assert (cookie.raw_source, cookie.raw_value) == ("ga_client", "GA:1:2")
    assert cookie.unified_user_id == hashlib.md5(b"ga_client:GA:1:2").hexdigest()
    assert got["shopify_customer:7"].unified_user_id == cookie.unified_user_id


def edge_rows(spark, pairs):
    return spark.createDataFrame(
        [(a, b, "t", "high") for a, b in pairs], "raw_id_src string, raw_id_dst string, match_type string, confidence string"
    )


def people_of(graph):
    rows = [(r.raw_id, r.raw_source, r.raw_value, r.unified_user_id) for r in graph.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return set(rows)


CHAIN_OF_CHAINS = [(f"k:{c}{i:02d}", f"k:{c}{i + 1:02d}") for c in "abc" for i in range(20)]
GROWTH = {
    "new_people_only": ([("k:a", "k:b")], [("k:c", "k:d"), ("k:e", "k:e")]),
    "two_people_become_one": ([("k:m", "k:n"), ("k:p", "k:q")], [("k:q", "k:n")]),
    "a_smaller_id_renames": ([("k:m", "k:n"), ("k:x", "k:x")], [("k:a", "k:n")]),
    "known_edges_again": ([("k:a", "k:b"), ("k:b", "k:c")], [("k:b", "k:a"), ("k:c", "k:b")]),
    "chains_joined_end_to_start": (CHAIN_OF_CHAINS, [("k:a20", "k:b00"), ("k:b20", "k:c10"), ("k:c20", "k:new")]),
    "nothing_new": ([("k:a", "k:b")], []),
    "nothing_known": ([], [("k:a", "k:b"), ("k:b", "k:c")]),
    "missing_ids": ([("k:a", "k:b")], [(None, "k:b"), ("k:b", None), (None, None)]),
}


@pytest.mark.parametrize("case", GROWTH)
def test_grown_graph_equals_a_rebuild(spark, case):
    old, new = GROWTH[case]
    graph = identity.identity_graph(edge_rows(spark, old))
    got = people_of(identity.grown_graph(graph, edge_rows(spark, new)))
    assert got == people_of(identity.identity_graph(edge_rows(spark, old + new)))


@pytest.mark.parametrize("seed", [3, 4])
def test_a_graph_grown_day_by_day_equals_a_rebuild(spark, seed):
    rng = random.Random(seed)
    nodes = [f"k:{i:03d}" for i in range(200)]
    days = [[(rng.choice(nodes), rng.choice(nodes)) for _ in range(50)] for _ in range(3)]
    # One id meets a third of all others on the second day.
    days[1] += [("k:150", n) for n in rng.sample(nodes, 60)]
    graph = identity.identity_graph(edge_rows(spark, days[0]))
    for day in days[1:]:
        graph = identity.grown_graph(graph, edge_rows(spark, day))
    assert people_of(graph) == people_of(identity.identity_graph(edge_rows(spark, sum(days, []))))


def test_growth_takes_fewer_rounds_than_a_rebuild(spark, monkeypatch):
    written = []

    def counted(df, path, *rest):
        if "/round-" in path:
            written.append(path)
        return store(df, path, *rest)

    old = [(f"k:{i:03d}", f"k:{i + 1:03d}") for i in range(300)]
    new = [("k:300", "k:301")]
    graph = identity.identity_graph(edge_rows(spark, old))
    monkeypatch.setattr(rounds, "store", counted)
    rebuilt = people_of(identity.identity_graph(edge_rows(spark, old + new)))
    whole = len(written)
    assert people_of(identity.grown_graph(graph, edge_rows(spark, new))) == rebuilt
    assert len(written) - whole == 1 < whole


def test_kpass_stops_short_and_swaps_labels_without_self_edges(spark):
    def kpass(pairs):
        both = {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}
        df = spark.createDataFrame(
            [(a, b, "t", "high") for a, b in both], identity.EDGE_COLUMNS
        )
        return {r.raw_id: r.unified_user_id for r in identity.identity_kpass(df, 5).collect()}

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    star = kpass([("S", "H"), ("F", "H")])
    assert star["S"] == star["F"] == md5("H") and star["H"] == md5("F")
    looped = CHAIN[:9] + [(n, n) for n in {x for p in CHAIN[:9] for x in p}]
    assert len(set(kpass(looped).values())) == 5


@pytest.fixture()
def staged(spark):
    ts = datetime(2024, 1, 1)
    web = spark.createDataFrame(
        [
            ("1", "page_view", ts, "A", "100", "granted"),
            ("2", "page_view", ts, "B", "200", "granted"),
            ("3", "page_view", ts, "C", "100", "anonymous"),
            ("4", "page_view", ts, None, "100", "granted"),
            ("5", "page_view", ts, None, None, "granted"),
        ],
        "event_id string, event_name string, event_ts timestamp_ntz, ga_client_id string, "
        "ga_user_id string, consent_status string",
    )
    pixel = spark.createDataFrame(
        [("F", "h100", "granted"), ("G", None, "granted"), (None, "h100", "granted"), ("K", "h100", "anonymous")],
        "fbp string, email_hash string, consent_status string",
    )
    email = spark.createDataFrame(
        [("S1", "h100", "granted")], "subscriber_id string, email_hash string, consent_status string"
    )
    customers = spark.createDataFrame(
        [(100, "h100", "granted"), (200, "h200", "anonymous")],
        "shopify_customer_id bigint, email_hash string, consent_status string",
    )
    orders = spark.createDataFrame([(100,), (300,), (None,)], "shopify_customer_id bigint")
    return web, pixel, email, customers, orders


def people(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.unified_user_id, set()).add(r.raw_id)
    return sorted(sorted(g) for g in groups.values())


def test_rules_make_one_person_and_respect_consent(spark, staged):
    edges = identity.identity_edges(*staged)
    assert people(identity.identity_graph(edges)) == [
        ["email_hash:h100", "email_subscriber:S1", "ga_client:A", "meta_fbp:F", "shopify_customer:100"],
        ["ga_client:B", "shopify_customer:200"],
        ["shopify_customer:300"],
    ]
    rows = [tuple(r) for r in edges.collect()]
    assert len(rows) == len(set(rows))
    assert {(b, a) for a, b, _, _ in rows} == {(a, b) for a, b, _, _ in rows}


def test_strict_consent_needs_a_granted_customer(spark, staged):
    edges = identity.identity_edges(*staged, strict_consent=True)
    logins = {r.raw_id_src for r in edges.where(F.col("match_type") == "logged_in_user_id").collect()}
    assert "ga_client:A" in logins and "ga_client:B" not in logins
    assert "ga_client:B" in {r.raw_id_src for r in edges.collect()}


def test_device_hints_are_linear_and_stay_out_of_the_graph(spark):
    rows = [(f"f{i}", "10.0.0.0", "UA", "granted") for i in range(50)] + [("x", None, "UA", "granted")]
    pixel = spark.createDataFrame(
        rows, "fbp string, ip_prefix string, user_agent string, consent_status string"
    )
    hints = identity.identity_candidates(pixel)
    assert hints.count() == 50
    assert {r.confidence for r in hints.collect()} == {"probabilistic"}


def test_bronze_to_edges_reads_only_what_the_rules_need(spark, tmp_path):
    spark.createDataFrame([], BRONZE["ga4_events"]).write.parquet(f"{tmp_path}/w")
    web = staging.web_events(spark.read.schema(BRONZE["ga4_events"]).parquet(f"{tmp_path}/w"))
    plan = identity._web_rules(web, None)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ga_client_id:string,ga_user_id:string,consent_status:string>" in plan
    assert "PushedFilters: [IsNotNull(consent_status), Not(EqualTo(consent_status,withdrawn))]" in plan


@pytest.mark.parametrize("step", [_large_star, _small_star])
def test_a_hub_is_split_in_the_star_joins(spark, tiny_skew_limits, step):
    rest = [(f"z{i:05d}", f"r{i:05d}") for i in range(6000)]
    if step is _large_star:
        hub = [(f"x{i:05d}", "hub") for i in range(6000)]
    else:
        hub = [("zzz", f"x{i:05d}") for i in range(6000)]
    stars = step(spark.createDataFrame(hub + rest, "node string, parent string").repartition(12))
    stars.collect()
    plan = stars._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "skew=true" in plan
