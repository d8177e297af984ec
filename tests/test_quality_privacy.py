import hashlib
import os
from datetime import datetime

import pytest

from wayfare.operators import attribution, privacy, quality
from wayfare.operators.quality import Check
from wayfare.params import Params
from wayfare.plans import erasure
from wayfare.plans.warehouse import Warehouse
from wayfare.session import new_run_dir, store
from wayfare.sources import published
from wayfare.sources.published import drop_replaced, files_of, publish, publish_without, read_published
from wayfare.sources.testbed import load_bronze

TINY = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 3, 1)


def by_check(df):
    return {(r.check_name, r.column_name): (r.observed, r.passed) for r in df.collect()}


def test_row_checks_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0, datetime(2024, 2, 1)), (None, "b", -1.0, datetime(2024, 2, 20)), (3, None, None, None)],
        "k int, v string, x double, t timestamp_ntz",
    )
    got = by_check(
        quality.run_checks(
            df,
            "t",
            [
                Check("not_null", "k"),
                Check("accepted_values", "v", values=("a",)),
                Check("between", "x", low=0.0),
                Check("row_count", low=1, high=2),
                Check("min", "x", low=0.0),
                Check("freshness", "t", high=32.0),
            ],
            AS_OF,
        )
    )
    assert got == {
        ("not_null", "k"): (1.0, False),
        ("accepted_values", "v"): (1.0, False),
        ("between", "x"): (1.0, False),
        ("row_count", "*"): (3.0, False),
        ("min", "x"): (-1.0, False),
        ("freshness", "t"): (10.0, True),
    }


def test_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, t timestamp_ntz")
    checks = [Check("not_null", "k"), Check("row_count", low=1), Check("min", "k", low=0), Check("freshness", "t", high=1.0)]
    got = by_check(quality.run_checks(df, "t", checks, AS_OF))
    assert got[("not_null", "k")] == (0.0, True)
    assert got[("row_count", "*")] == (0.0, False)
    assert got[("min", "k")] == (None, False)
    assert got[("freshness", "t")] == (None, False)


def test_unique_and_combination(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (None, 3), (None, 3)], "a int, b int")
    assert by_check(quality.check_unique(df, "t", ["a"])) == {("unique", "a"): (1.0, False)}
    assert by_check(quality.check_unique(df, "t", ["a", "b"])) == {("unique_combination", "a,b"): (1.0, False)}
    assert by_check(quality.check_unique(df.where("a = 2"), "t", ["a"])) == {("unique", "a"): (0.0, True)}


def test_relationships_count_child_rows(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert by_check(quality.check_relationship(child, "t", "k", parent, "id")) == {("relationships", "k"): (2.0, False)}


def test_invariants_return_their_violations(spark):
    funnel = spark.createDataFrame(
        [("good", 5, 4, 4, 1, 0), ("bad", 5, 4, 4, 1, 2)],
        "channel_key string, users_visited long, users_pdp long, users_add_to_cart long, users_checkout long, users_purchased long",
    )
    assert [r.channel_key for r in quality.funnel_violations(funnel).collect()] == ["bad"]
    graph = spark.createDataFrame([("a", "u"), (None, "u"), ("b", None)], "raw_id string, unified_user_id string")
    assert quality.graph_orphans(graph).count() == 2
    weights = spark.createDataFrame(
        [("o", "linear", 0.5), ("o", "linear", 0.5), ("p", "linear", 0.9)],
        "conversion_id string, attribution_model string, weight double",
    )
    assert [r.conversion_id for r in attribution.weight_violations(weights).collect()] == ["p"]


@pytest.fixture(scope="module")
def marts(spark):
    w = Warehouse(spark, load_bronze(spark, TINY), Params(as_of=AS_OF))
    w.publish_marts()
    return w


def test_marts_are_not_empty_and_reconcile(marts):
    for name in ("dim_users", "dim_channels", "dim_dates", "fct_touchpoints", "fct_sessions", "fct_conversions", "fct_funnel_steps"):
        assert marts.table(name).count() > 0, name
    assert all(r.reconciles for r in attribution.reconcile(marts.table("fct_conversions")).collect())


def test_unknown_email_forgets_nobody(spark, marts):
    requests = spark.createDataFrame([("nobody@nowhere.example",)], "email string")
    assert privacy.resolve(requests, marts.table("dim_users")).isEmpty()
    after = erasure.forget(marts, requests, new_run_dir(spark, "erased"))
    assert after["forgotten_users"].isEmpty()
    for name in erasure.PERSONAL:
        assert after[name].count() == marts.table(name).count()


def test_forgetting_cascades_and_repeats_safely(spark, marts):
    requests = spark.createDataFrame([(" USER3@Example.com",), ("user3@example.com ",)], "email string")
    person = privacy.resolve(requests, marts.table("dim_users")).collect()
    assert len(person) == 1
    uid = person[0].unified_user_id
    assert person[0].email_hash == hashlib.sha256(b"user3@example.com").hexdigest()

    once = erasure.forget(marts, requests, new_run_dir(spark, "erased"))
    for name in erasure.PERSONAL:
        gone = marts.table(name).where(f"unified_user_id = '{uid}'").count()
        assert gone > 0
        assert once[name].count() == marts.table(name).count() - gone
        assert once[name].where(f"unified_user_id = '{uid}'").isEmpty()
    stone = once["forgotten_users"].collect()
    assert [(r.unified_user_id, r.request_id, r.forgotten_at) for r in stone] == [(uid, "req_" + uid[:8], AS_OF)]

    # The funnel is the one of the people left, not the old one.
    before = sum(r.users_visited for r in marts.table("fct_funnel_steps").collect())
    assert sum(r.users_visited for r in once["fct_funnel_steps"].collect()) < before

    # Against the rewritten users the same request finds nobody.
    assert privacy.resolve(requests, once["dim_users"]).isEmpty()


def test_earlier_batches_stay_forgotten(spark, marts):
    root = new_run_dir(spark, "erased")
    people = []
    for address in ("user3@example.com", "user6@example.com", "user3@example.com"):
        requests = spark.createDataFrame([(address,)], "email string")
        people += [r.unified_user_id for r in privacy.resolve(requests, marts.table("dim_users")).collect()]
        erasure.forget(marts, requests, root)
    folder = erasure.current(spark, root)
    assert folder.endswith("v000003") and len(set(people)) == 2
    for name in erasure.PERSONAL + erasure.STORED:
        left = read_published(spark, folder, name)
        assert left.where(left.unified_user_id.isin(people)).isEmpty(), name
        assert left.columns == marts.table(name).columns or set(left.columns) == set(marts.table(name).columns)
    ids = marts.table("identity_graph")
    gone = {r.raw_id for r in ids.where(ids.unified_user_id.isin(people)).collect()}
    edges = read_published(spark, folder, "identity_edges")
    assert gone and edges.where(edges.raw_id_src.isin(gone) | edges.raw_id_dst.isin(gone)).isEmpty()
    stones = [r.unified_user_id for r in read_published(spark, folder, "forgotten_users").collect()]
    assert sorted(stones) == sorted(set(people))


def test_rows_without_a_person_survive_erasure(spark):
    df = spark.createDataFrame([("u", 1), (None, 2)], "unified_user_id string, x int")
    gone = spark.createDataFrame([("u",)], "unified_user_id string")
    assert [r.x for r in privacy.erase(df, gone).collect()] == [2]


def kept_rows(df):
    return sorted((tuple(r) for r in df.select("unified_user_id", "raw_source", "x").collect()), key=str)


def test_erasure_writes_only_files_that_hold_the_person(spark, tmp_path):
    rows = [(f"u{i}", f"s{i % 5}", i) for i in range(50)] + [(None, "s1", 100), ("u7", "s 3:x", 7), ("u9", None, 9)]
    df = spark.createDataFrame(rows, "unified_user_id string, raw_source string, x int")
    # Foldered by raw_source, one file in each folder.
    table = publish(df.coalesce(1), f"{tmp_path}/v0", "identity_graph")
    gone = spark.createDataFrame([("u7",), ("nobody",)], "unified_user_id string")
    after = publish_without(table, "identity_graph", gone, f"{tmp_path}/v1")
    before, now = set(files_of(table)), set(files_of(after))
    assert len(before) == 7 and len(before & now) == 5
    # u7 was alone in one folder, and one of several people in another.
    assert len(now - before) == 1
    assert kept_rows(after) == sorted((r for r in rows if r[0] != "u7"), key=str)

    again = publish_without(after, "identity_graph", spark.createDataFrame([("u9",)], gone.schema), f"{tmp_path}/v2")
    want = sorted((r for r in rows if r[0] not in ("u7", "u9")), key=str)
    assert kept_rows(again) == want
    assert len(set(files_of(again)) & now) == len(now) - 2
    assert drop_replaced(spark, f"{tmp_path}/v1", "identity_graph") == 2
    assert drop_replaced(spark, f"{tmp_path}/v2", "identity_graph") == 2
    assert kept_rows(read_published(spark, f"{tmp_path}/v2", "identity_graph")) == want
    left = spark.read.parquet(f"{tmp_path}/v0/identity_graph").select("unified_user_id").collect()
    assert {"u7", "u9"}.isdisjoint(r[0] for r in left)


def test_files_with_forgotten_people_are_found_by_a_few_of_them(spark, tmp_path, monkeypatch):
    """Where people lie in all files, a few keys settle all; where not, the other keys find the rest."""
    df = spark.range(400).selectExpr("concat('u', id % 40) AS unified_user_id", "concat('s', id div 40 % 4) AS raw_source", "id AS x")
    lone = spark.range(1).selectExpr("'u99' AS unified_user_id", "'s9' AS raw_source", "id AS x")
    table = publish(df.unionByName(lone).coalesce(1), f"{tmp_path}/v0", "identity_graph")
    files, passes, scan = files_of(table), [], published._scan
    monkeypatch.setattr(published, "PROBED", 3)
    monkeypatch.setattr(published, "_scan", lambda *a: passes.append(len(a[3])) or scan(*a))
    keys = spark.createDataFrame([(f"u{i}",) for i in [*range(20), 99]], "unified_user_id string").coalesce(1)
    spread = [f for f in files if "raw_source=s9" not in f]
    assert published._files_with(table, "identity_graph", spread, keys) == set(spread) and passes == [4]
    passes.clear()
    assert published._files_with(table, "identity_graph", files, keys) == set(files) and passes == [5, 1]
    after = publish_without(table, "identity_graph", keys, f"{tmp_path}/v1")
    assert {r.unified_user_id for r in after.collect()} == {f"u{i}" for i in range(20, 40)}


def test_erasure_of_nobody_writes_no_rows_and_of_all_leaves_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([("u", "s", 1)], "unified_user_id string, raw_source string, x int")
    table = publish(df, f"{tmp_path}/v0", "identity_graph")
    nobody = spark.createDataFrame([(None,), ("w",)], "unified_user_id string")
    same = publish_without(table, "identity_graph", nobody, f"{tmp_path}/v1")
    assert files_of(same) == files_of(table) and not os.path.exists(f"{tmp_path}/v1/identity_graph")
    none = publish_without(same, "identity_graph", df.select("unified_user_id"), f"{tmp_path}/v2")
    assert none.collect() == [] and none.columns == table.columns
    empty = publish_without(none, "identity_graph", nobody, f"{tmp_path}/v3")
    assert empty.collect() == [] and empty.schema == none.schema


def test_one_person_leaves_most_files_shared(spark, marts):
    root = new_run_dir(spark, "erased")
    requests = spark.createDataFrame([("user3@example.com",)], "email string")
    uid = privacy.resolve(requests, marts.table("dim_users")).first().unified_user_id
    facts = marts.table("fct_touchpoints").repartitionByRange(16, "unified_user_id")
    ranged = store(facts, f"{root}/fct_touchpoints")
    keys = spark.createDataFrame([(uid,)], "unified_user_id string")
    after = publish_without(ranged, "fct_touchpoints", keys, f"{root}/v1")
    assert len(set(files_of(ranged)) - set(files_of(after))) == 1
    assert after.count() == ranged.where(ranged.unified_user_id != uid).count() < ranged.count()


def test_replaced_files_go_and_the_current_version_stays(spark):
    w = Warehouse(spark, load_bronze(spark, TINY), Params(as_of=AS_OF))
    root, people = new_run_dir(spark, "erased"), []
    for address in ("user3@example.com", "user6@example.com"):
        requests = spark.createDataFrame([(address,)], "email string")
        people += [r.unified_user_id for r in privacy.resolve(requests, w.table("dim_users")).collect()]
        erasure.forget(w, requests, root)
    folder = erasure.current(spark, root)
    names = [*erasure.PERSONAL, *erasure.STORED]
    counts = {n: read_published(spark, folder, n).count() for n in names}
    assert erasure.remove_replaced(spark, root) > 0
    for n in names:
        left = read_published(spark, folder, n)
        assert left.count() == counts[n] and left.where(left.unified_user_id.isin(people)).isEmpty(), n
    # A later batch starts from the current version and needs none of the files that are gone.
    requests = spark.createDataFrame([("user12@example.com",)], "email string")
    assert privacy.resolve(requests, read_published(spark, folder, "dim_users")).count() == 1
    after = erasure.forget(w, requests, root)
    assert after["dim_users"].count() == counts["dim_users"] - 1
