import random
from datetime import date, datetime, timedelta

from wayfare.operators import dimensions

GRAPH = "raw_id string, raw_source string, raw_value string, unified_user_id string"
CUSTOMERS = (
    "shopify_customer_id bigint, email_hash string, country string, created_at timestamp_ntz, "
    "consent_updated_at timestamp_ntz, consent_status string"
)
AS_OF = datetime(2024, 6, 1)


def graph(spark):
    ids = [("shopify_customer", "1", "u"), ("shopify_customer", "2", "u"), ("ga_client", "1", "v"), ("shopify_customer", "3", "w")]
    return spark.createDataFrame([(f"{s}:{i}", s, i, u) for s, i, u in ids], GRAPH)


def test_dates_end_before_the_end(spark):
    bounds = spark.createDataFrame([(date(2025, 10, 1), date(2026, 6, 30))], "start_date date, end_date date")
    rows = {r.date_day: r for r in dimensions.dim_dates(bounds).collect()}
    assert len(rows) == 272 and max(rows) == date(2026, 6, 29)
    for day, r in rows.items():
        iso = day.isocalendar()
        assert (r.year, r.month, r.day_of_month) == (day.year, day.month, day.day)
        assert (r.iso_week, r.day_of_week_iso) == (iso.week, iso.weekday)
        assert (r.quarter, r.is_weekend) == ((day.month + 2) // 3, iso.weekday > 5)


def test_users_keep_a_hash_only_under_a_grant(spark):
    customers = spark.createDataFrame(
        [
            (1, "h1", "BE", datetime(2024, 1, 5), None, "granted"),
            (2, "h2", "FR", datetime(2024, 1, 2), None, "anonymous"),
            (3, "h3", "DE", None, None, "anonymous"),
        ],
        CUSTOMERS,
    )
    got = {r.unified_user_id: r for r in dimensions.dim_users(graph(spark), customers, AS_OF).collect()}
    assert set(got) == {"u", "v", "w"}
    u, v, w = got["u"], got["v"], got["w"]
    assert (u.email_hash, u.country, u.consent_status, u.valid_from) == ("h1", "FR", "granted", datetime(2024, 1, 2))
    assert (v.email_hash, v.consent_status, v.valid_from, v.is_current) == (None, "anonymous", AS_OF, True)
    assert (w.email_hash, w.valid_from) == (None, AS_OF)


def history(spark):
    rows = [
        (1, "old", "BE", datetime(2024, 1, 1), datetime(2024, 1, 10, 8), "granted"),
        (1, "old", "BE", datetime(2024, 1, 1), datetime(2024, 1, 10, 8), "granted"),  # redelivered
        (1, "old", "BE", datetime(2024, 1, 1), datetime(2024, 2, 1, 8), "granted"),  # nothing changed
        (1, "mid", "BE", datetime(2024, 1, 1), datetime(2024, 3, 1, 8), "granted"),
        (1, "new", "BE", datetime(2024, 1, 1), datetime(2024, 3, 1, 9), "granted"),  # same day, later
        (1, "new", "BE", datetime(2024, 1, 1), datetime(2024, 4, 1, 9), "anonymous"),
    ]
    return dimensions.dim_users_scd2(graph(spark), spark.createDataFrame(rows, CUSTOMERS))


def test_versions_open_and_close_on_change(spark):
    rows = history(spark).orderBy("valid_from").collect()
    assert [(r.email_hash, r.consent_status, r.valid_from, r.valid_to, r.is_current) for r in rows] == [
        ("old", "granted", datetime(2024, 1, 10, 8), datetime(2024, 3, 1, 8), False),
        ("mid", "granted", datetime(2024, 3, 1, 8), datetime(2024, 3, 1, 9), False),
        ("new", "granted", datetime(2024, 3, 1, 9), datetime(2024, 4, 1, 9), False),
        (None, "anonymous", datetime(2024, 4, 1, 9), datetime(9999, 12, 31), True),
    ]


def test_facts_meet_the_version_of_their_time(spark):
    facts = spark.createDataFrame(
        [
            ("before", datetime(2024, 1, 9, 23, 59), "u"),
            ("same_day_before", datetime(2024, 1, 10, 7, 59), "u"),
            ("first_instant", datetime(2024, 1, 10, 8), "u"),
            ("last_day", datetime(2024, 2, 29, 23, 59), "u"),
            ("between", datetime(2024, 3, 1, 8, 30), "u"),
            ("boundary", datetime(2024, 3, 1, 9), "u"),
            ("withdrawn_later_that_day", datetime(2024, 4, 1, 8, 59), "u"),
            ("now", datetime(2024, 5, 1), "u"),
            ("unknown", datetime(2024, 5, 1), "zz"),
            ("nobody", datetime(2024, 5, 1), None),
        ],
        "conversion_id string, conversion_ts timestamp_ntz, unified_user_id string",
    )
    got = {r.conversion_id: (r.email_hash, r.consent_status) for r in dimensions.facts_asof_user(facts, history(spark)).collect()}
    assert got == {
        "before": (None, None),
        "same_day_before": (None, None),
        "first_instant": ("old", "granted"),
        "last_day": ("old", "granted"),
        "between": ("mid", "granted"),
        "boundary": ("new", "granted"),
        "withdrawn_later_that_day": ("new", "granted"),
        "now": (None, "anonymous"),
        "unknown": (None, None),
        "nobody": (None, None),
    }


def test_history_against_brute_force(spark):
    """Many versions and facts a day, several persons, values that come back."""
    rng = random.Random(2)
    start = datetime(2024, 1, 1)
    when = lambda: start + timedelta(minutes=rng.randrange(6 * 1440))
    rows = [(1, rng.choice(["a", "b"]), "BE", start, when(), rng.choice(["granted", "anonymous"])) for _ in range(300)]
    facts = [(f"f{i}", when(), "u") for i in range(400)]
    states = {}
    for r in rows:
        key = (r[5], r[1] if r[5] == "granted" else None)
        states[r[4]] = max(states.get(r[4], key), key, key=lambda x: (x[0], x[1] or ""))
    versions, last = [], None
    for at, state in sorted(states.items()):
        if state != last:
            versions.append((at, state))
            last = state
    history = dimensions.dim_users_scd2(graph(spark), spark.createDataFrame(rows, CUSTOMERS))
    got = [(r.valid_from, (r.consent_status, r.email_hash), r.valid_to) for r in history.orderBy("valid_from").collect()]
    ends = [at for at, _ in versions[1:]] + [datetime(9999, 12, 31)]
    assert got == [(at, state, end) for (at, state), end in zip(versions, ends)]
    frame = spark.createDataFrame(facts, "conversion_id string, conversion_ts timestamp_ntz, unified_user_id string")
    found = {r.conversion_id: (r.consent_status, r.email_hash) for r in dimensions.facts_asof_user(frame, history).collect()}
    for name, at, _ in facts:
        assert found[name] == next((s for v, s in reversed(versions) if v <= at), (None, None))


def test_channels_from_a_seed_file(spark, tmp_path):
    built_in = dimensions.dim_channels(spark)
    assert built_in.count() == 9
    built_in.coalesce(1).write.option("header", True).csv(f"{tmp_path}/seed")
    read = dimensions.dim_channels(spark, f"{tmp_path}/seed")
    assert sorted(read.collect()) == sorted(built_in.collect())
