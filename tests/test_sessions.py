import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wayfare.operators import sessions

WEB = (
    "event_id string, event_ts timestamp_ntz, event_name string, channel_key string, "
    "page_location string, item_sku string, value_eur double, country string, "
    "device_category string, ga_client_id string"
)
GRAPH = "raw_id string, raw_source string, raw_value string, unified_user_id string"
START = datetime(2024, 1, 1)


def event(i, at, cookie, name="page_view", channel="direct", page="/a"):
    return (str(i), at, name, channel, page, None, 1.0, "BE", "mobile", cookie)


def graph_of(spark, people):
    return spark.createDataFrame(
        [(f"ga_client:{c}", "ga_client", c, u) for c, u in people.items()], GRAPH
    )


def stitched(spark, rows, people, timeout=30, **kw):
    df = sessions.sessions_stitched(
        spark.createDataFrame(rows, WEB), graph_of(spark, people), timeout, **kw
    )
    return {r.event_id: r.stitched_session_id for r in df.collect()}


def test_gap_counts_minute_boundaries(spark):
    rows = [
        event(1, START + timedelta(seconds=59), "A"),
        event(2, START + timedelta(minutes=31), "A"),  # 31 boundaries, 30 min 1 s elapsed
        event(3, START + timedelta(minutes=61, seconds=59), "A"),  # 30 boundaries
    ]
    assert stitched(spark, rows, {"A": "u"}) == {"1": 1, "2": 2, "3": 2}


def plain_sessions(rows, people, timeout):
    out, last, number = {}, {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        owner = people.get(r[9], r[9])
        minute = int((r[1] - START).total_seconds() // 60)
        if owner not in last or minute - last[owner] > timeout:
            number[owner] = number.get(owner, 0) + 1
        last[owner] = minute
        out[r[0]] = number[owner]
    return out


def skewed_events(n=2500, seed=3):
    rng = random.Random(seed)
    people = {f"c{i}": f"u{i % 20}" for i in range(60)}
    people |= {f"h{i}": "hot" for i in range(3)}
    rows = []
    for i in range(n):
        if i % 3 == 0:
            cookie = f"h{rng.randrange(3)}"
        else:
            cookie = rng.choice([f"c{rng.randrange(60)}", f"anon{rng.randrange(5)}", None])
        at = START + timedelta(seconds=rng.randrange(20) if rng.random() < 0.2 else rng.randrange(900_000))
        rows.append(event(f"{i:05d}", at, cookie, rng.choice(["page_view", "view_item", "purchase"]), rng.choice(["direct", "email"]), f"/p{rng.randrange(4)}"))
    return rows, people


def test_sessions_equal_a_plain_scan_under_a_hot_person(spark):
    rows, people = skewed_events()
    assert stitched(spark, rows, people) == plain_sessions(rows, people, 30)


def test_known_only_is_the_known_part(spark):
    rows, people = skewed_events(900, 4)
    every = stitched(spark, rows, people)
    known = stitched(spark, rows, people, known_only=True)
    assert known == {r[0]: every[r[0]] for r in rows if r[9] in people}


def test_longer_timeout_never_adds_sessions(spark):
    rows, people = skewed_events(600, 5)
    counts = [len({(people.get(r[9], r[9]), s) for r, s in zip(rows, map(stitched(spark, rows, people, t).get, [r[0] for r in rows]))}) for t in (10, 30, 720)]
    assert counts == sorted(counts, reverse=True)


def test_gaps_and_flags_per_event(spark):
    rows, people = skewed_events(900, 6)
    df = sessions.session_gaps(spark.createDataFrame(rows, WEB), graph_of(spark, people), 30)
    last, want = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        owner = people.get(r[9], r[9])
        minute = int((r[1] - START).total_seconds() // 60)
        gap = minute - last[owner] if owner in last else None
        want[r[0]] = (gap, int(gap is None or gap > 30))
        last[owner] = minute
    assert {r.event_id: (r.mins_since_prev, r.is_new_session) for r in df.collect()} == want


def test_untimed_events_are_kept_in_a_trailing_session(spark):
    rows = [event(1, START, "A"), event(2, None, "A"), event(3, None, "A")]
    assert stitched(spark, rows, {"A": "u"}) == {"1": 1, "2": 2, "3": 2}


def test_facts_and_funnel(spark):
    rows = [
        event(1, START, "A", "page_view", "direct", "/a"),
        event(2, START + timedelta(seconds=90), "A", "view_item", "email", "/b"),
        event(3, START + timedelta(seconds=95), "A2", "purchase", "direct", "/a"),
        event(4, START + timedelta(hours=5), "A", "page_view", "direct"),
        event(5, START, "B", "page_view", "direct"),
        event(6, START, "nobody", "page_view", "direct"),
    ]
    people = {"A": "u", "A2": "u", "B": "v"}
    df = sessions.sessions_stitched(spark.createDataFrame(rows, WEB), graph_of(spark, people), 30)
    summary = sessions.session_summary(df)
    facts = {(r.unified_user_id, r.stitched_session_id): r for r in sessions.session_facts(summary).collect()}
    assert len(facts) == 3
    first = facts[("u", 1)]
    assert (first.event_count, first.unique_pages, first.session_duration_sec) == (3, 2, 95)
    assert (first.acquisition_channel, first.is_purchase_session) == ("email", 1)

    funnel = {r.channel_key: r for r in sessions.channel_funnel(summary).collect()}
    assert (funnel["email"].users_visited, funnel["email"].users_pdp, funnel["email"].users_purchased) == (1, 1, 1)
    # The person counts once however many sessions reach the step.
    assert (funnel["direct"].users_visited, funnel["direct"].users_pdp) == (2, 0)
    steps = sessions.funnel_steps(summary).where(F.col("stitched_session_id") == 1)
    assert steps.where("unified_user_id = 'u'").first().step_5_purchase == 1
