import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.operators import attribution, touchpoints
from wayfare.params import CHANNEL_KEYS
from wayfare.plans.warehouse import Warehouse

TOUCH = "touchpoint_id string, touchpoint_ts timestamp_ntz, source string, channel_key string, unified_user_id string"
CONV = "conversion_id string, conversion_ts timestamp_ntz, conversion_value_eur double, unified_user_id string"
ORDER = datetime(2024, 3, 1, 23, 30)


def frames(spark, touches, convs):
    return spark.createDataFrame(touches, TOUCH), spark.createDataFrame(convs, CONV)


def credits(spark, touches, convs, days=30):
    t, c = frames(spark, touches, convs)
    ranked = attribution.attribution_ranked(attribution.touch_axis(t, c, days), days)
    return attribution.touchpoints_attribution(ranked)


def pivot(spark, touches, convs, days=30):
    t, c = frames(spark, touches, convs)
    rows = attribution.attribution_pivot(attribution.touch_axis(t, c, days)).collect()
    return {
        (r.conversion_id, r.channel_key): (
            r.revenue_first_touch, r.revenue_last_touch, r.revenue_linear, r.revenue_position_based,
        )
        for r in rows
    }


def test_worked_journey_of_180_euro(spark):
    channels = ["paid_social", "paid_search", "organic_search", "email"]
    touches = [
        (f"t{i}", ORDER - timedelta(days=9 - i), "ga4", c, "marie") for i, c in enumerate(channels)
    ]
    got = pivot(spark, touches, [("o", ORDER, 180.0, "marie")])
    want = {
        "paid_social": (180, 0, 45, 72),
        "paid_search": (0, 0, 45, 18),
        "organic_search": (0, 0, 45, 18),
        "email": (0, 180, 45, 72),
    }
    for c in channels:
        assert got[("o", c)] == pytest.approx(want[c])


def test_window_is_calendar_days_and_strictly_before(spark):
    midnight = datetime(2024, 1, 31)
    touches = [
        ("too_old", midnight - timedelta(microseconds=1), "ga4", "email", "u"),
        ("first_instant", midnight, "ga4", "email", "u"),
        ("just_before", ORDER - timedelta(microseconds=1), "ga4", "direct", "u"),
        ("same_instant", ORDER, "ga4", "direct", "u"),
        ("stranger", ORDER - timedelta(days=1), "ga4", "direct", "v"),
    ]
    t, c = frames(spark, touches, [("o", ORDER, 10.0, "u")])
    pairs = touchpoints.touchpoints_enriched(t, c, 30)
    assert {r.touchpoint_id for r in pairs.collect()} == {"first_instant", "just_before"}
    ranked = attribution.attribution_ranked(attribution.touch_axis(t, c, 30), 30)
    assert {r.touchpoint_id: r.pos_asc for r in ranked.collect()} == {"first_instant": 1, "just_before": 2}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 37])
def test_weights_sum_to_one_even_when_touches_tie(spark, n):
    at = ORDER - timedelta(days=2)
    touches = [(f"t{i:02d}", at, ["ga4", "meta"][i % 2], "direct", "u") for i in range(n)]
    df = credits(spark, touches, [("o", ORDER, 99.0, "u")])
    sums = {r.attribution_model: r.w for r in df.groupBy("attribution_model").agg(F.sum("weight").alias("w")).collect()}
    assert len(sums) == 4 and all(w == pytest.approx(1.0) for w in sums.values())
    assert attribution.weight_violations(df).isEmpty()
    ends = sorted(r.weight for r in df.where("attribution_model = 'position_based'").collect())
    if n >= 3:
        assert ends[-2:] == [0.4, 0.4]


def skewed(seed=11, n=1500):
    rng = random.Random(seed)
    touches, convs = [], []
    base = datetime(2024, 1, 1)
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(30)}"
        at = base + timedelta(seconds=rng.randrange(100 * 86400))
        if rng.random() < 0.2:
            at = at.replace(hour=0, minute=0, second=0)
        touches.append((f"t{i:05d}", at, rng.choice(["ga4", "meta", "email"]), rng.choice(CHANNEL_KEYS), user))
    for i in range(n // 10):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(35)}"
        at = rng.choice(touches)[1] if rng.random() < 0.3 else base + timedelta(seconds=rng.randrange(120 * 86400))
        convs.append((f"o{i:04d}", at, float(rng.randrange(100, 9999)) / 100, user))
    return touches, convs


def brute_pairs(touches, convs, days):
    by_user = defaultdict(list)
    for t in touches:
        by_user[t[4]].append(t)
    out = {}
    for c in convs:
        hits = [
            t for t in by_user[c[3]]
            if t[1] < c[1] and (c[1].date() - t[1].date()).days <= days
        ]
        if hits:
            out[c] = sorted(hits, key=lambda t: (t[1], t[2], t[0]))
    return out


@pytest.mark.parametrize("days", [30, 3])
def test_everything_equals_brute_force_under_a_hot_person(spark, days):
    touches, convs = skewed()
    want = brute_pairs(touches, convs, days)
    t, c = frames(spark, touches, convs)

    pairs = {(r.touchpoint_id, r.conversion_id) for r in touchpoints.touchpoints_enriched(t, c, days).collect()}
    assert pairs == {(x[0], o[0]) for o, hits in want.items() for x in hits}

    ranked = attribution.attribution_ranked(attribution.touch_axis(t, c, days), days).collect()
    assert len(ranked) == len(pairs)
    assert {(r.conversion_id, r.touchpoint_id): (r.pos_asc, r.pos_desc, r.n_touches) for r in ranked} == {
        (o[0], x[0]): (i + 1, len(hits) - i, len(hits)) for o, hits in want.items() for i, x in enumerate(hits)
    }

    revenue = defaultdict(lambda: [0.0] * 4)
    for o, hits in want.items():
        n = len(hits)
        for i, x in enumerate(hits):
            row = revenue[(o[0], x[3])]
            row[0] += o[2] * (i == 0)
            row[1] += o[2] * (i == n - 1)
            row[2] += o[2] / n
            row[3] += o[2] * (1 if n == 1 else 0.5 if n == 2 else 0.4 if i in (0, n - 1) else 0.2 / (n - 2))
    got = pivot(spark, touches, convs, days)
    assert got.keys() == revenue.keys()
    for k, v in got.items():
        assert v == pytest.approx(revenue[k])


def test_channels_outside_the_list_have_ranks_and_credit(spark):
    """A channel nobody listed, and none at all, count as any other."""
    touches, convs = skewed(seed=5, n=900)
    other = ["affiliate", None, "email"]
    touches = [(*t[:3], other[i % 3] if i % 2 else t[3], t[4]) for i, t in enumerate(touches)]
    t, c = frames(spark, touches, convs)
    want = brute_pairs(touches, convs, 30)
    ranked = attribution.attribution_ranked(attribution.touch_axis(t, c, 30), 30).collect()
    assert {(r.conversion_id, r.touchpoint_id): (r.pos_asc, r.pos_desc) for r in ranked} == {
        (o[0], x[0]): (i + 1, len(hits) - i) for o, hits in want.items() for i, x in enumerate(hits)
    }
    linear, first = defaultdict(float), defaultdict(float)
    for o, hits in want.items():
        for i, x in enumerate(hits):
            linear[(o[0], x[3])] += o[2] / len(hits)
            first[(o[0], x[3])] += o[2] * (i == 0)
    rows = attribution.attribution_pivot(attribution.touch_axis(t, c, 30)).collect()
    got = {(r.conversion_id, r.channel_key): r for r in rows}
    assert len(rows) == len(got) and got.keys() == linear.keys()
    assert any(k[1] is None for k in got) and any(k[1] == "affiliate" for k in got)
    for k, r in got.items():
        assert r.revenue_linear == pytest.approx(linear[k]) and r.revenue_first_touch == pytest.approx(first[k])


def test_conversions_of_a_day_open_with_one_marker(spark):
    """A hot buyer's orders do not pile up on the opening midnight."""
    convs = [(f"o{i:03d}", ORDER - timedelta(minutes=i), 1.0, "hot") for i in range(500)]
    touches = [("t1", ORDER - timedelta(days=2), "ga4", "email", "hot")]
    t, c = frames(spark, touches, convs)
    axis = attribution.touch_axis(t, c, 30)
    assert axis.where("mark = 'lo'").count() == 1 and axis.where("mark = 'hi'").count() == 500
    assert attribution.conversion_spans(axis).where("n_touches = 1").count() == 500


def test_the_axis_holds_only_people_with_touches_and_conversions(spark):
    """Others can never meet, so their rows are not shuffled, counted and stored."""
    touches = [(f"t{u}", ORDER - timedelta(days=2), "ga4", "email", u) for u in ("both", "visitor", None)]
    t, c = frames(spark, touches, [("o1", ORDER, 1.0, "both"), ("o2", ORDER, 1.0, "buyer"), ("o3", ORDER, 1.0, None)])
    axis = attribution.touch_axis(t, c, 30)
    assert sorted((r.unified_user_id, r.mark) for r in axis.collect()) == [("both", "hi"), ("both", "lo"), ("both", "touch")]
    assert [r.conversion_id for r in attribution.conversion_channels(axis).collect()] == ["o1"]


def test_only_people_with_both_enter_the_interval_join(spark):
    touches = [(f"t{u}", ORDER - timedelta(days=2), "ga4", "email", u) for u in ("both", "visitor", None)]
    t, c = frames(spark, touches, [("o1", ORDER, 1.0, "both"), ("o2", ORDER, 1.0, "buyer"), ("o3", ORDER, 1.0, None)])
    left, right = touchpoints.of_both(t, c)
    assert "visitor" not in {r.unified_user_id for r in left.collect()}
    assert "buyer" not in {r.unified_user_id for r in right.collect()}
    pairs = touchpoints.touchpoints_enriched(t, c, 30)
    assert [(r.touchpoint_id, r.conversion_id) for r in pairs.collect()] == [("tboth", "o1")]


def test_pairs_are_not_regrouped(spark):
    touches, convs = skewed(n=60)
    t, c = frames(spark, touches, convs)
    plan = credits(spark, touches, convs)._jdf.queryExecution().executedPlan().toString()
    above_join = plan[: plan.index("Join")]
    assert "Exchange" not in above_join and "Window" not in above_join


def test_time_decay_halves_per_half_life(spark):
    touches = [
        ("old", ORDER - timedelta(days=8), "ga4", "email", "u"),
        ("new", ORDER - timedelta(days=1), "ga4", "direct", "u"),
    ]
    t, c = frames(spark, touches, [("o", ORDER, 90.0, "u")])
    got = {r.touchpoint_id: r for r in attribution.time_decay(t, c, attribution.touch_axis(t, c, 30), 30, 7.0).collect()}
    assert got["new"].weight == pytest.approx(2 / 3) and got["old"].weight == pytest.approx(1 / 3)
    assert got["new"].revenue_share_eur == pytest.approx(60)


def test_end_touches_need_no_pairs(spark):
    touches, convs = skewed(seed=9, n=400)
    t, c = frames(spark, touches, convs)
    axis = attribution.touch_axis(t, c, 30)
    for model, end in (("first_touch", 0), ("last_touch", -1)):
        found = attribution.end_touch(axis, model)
        want = {o[0]: (hits[end][0], o[2]) for o, hits in brute_pairs(touches, convs, 30).items() if hits}
        assert {r.conversion_id: (r.touchpoint_id, r.revenue_share_eur) for r in found.collect()} == want
        assert "_conv_bucket" not in found._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("days", [1, 30])
def test_time_decay_from_prefix_sums(spark, days):
    """Totals and channel shares against sums over pairs, over 40 years, channels outside the list included."""
    touches, convs = skewed(seed=6, n=600)
    other = ["affiliate", None]
    touches = [(*t[:3], other[i % 2] if i % 7 == 0 else t[3], t[4]) for i, t in enumerate(touches)]
    back = lambda rows, at: [(f"{r[0]}-old", r[1] - timedelta(days=14600), *r[2:at], r[at]) for r in rows]
    touches, convs = touches + back(touches, 4), convs + back(convs, 3)
    t, c = frames(spark, touches, convs)
    axis = attribution.touch_axis(t, c, days)
    pairs, shares, value = {}, defaultdict(float), {}
    for o, hits in brute_pairs(touches, convs, days).items():
        mass = [2.0 ** (-(o[1].replace(microsecond=0) - x[1].replace(microsecond=0)).total_seconds() / 86400 / 7) for x in hits]
        for x, m in zip(hits, mass):
            pairs[(o[0], x[0])] = m / sum(mass)
            shares[(o[0], x[3])] += m / sum(mass)
            value[o[0]] = o[2]
    got = {(r.conversion_id, r.touchpoint_id): r.weight for r in attribution.time_decay(t, c, axis, days, 7.0).collect()}
    assert got.keys() == pairs.keys() and all(w == pytest.approx(pairs[k]) for k, w in got.items())
    rows = attribution.time_decay_channels(axis, days, 7.0)
    assert "_conv_bucket" not in rows._jdf.queryExecution().analyzed().toString()
    by = {(r.conversion_id, r.channel_key): r for r in rows.collect()}
    assert by.keys() == shares.keys() and any(k[1] is None for k in by)
    for k, r in by.items():
        assert r.weight == pytest.approx(shares[k]) and r.revenue_time_decay == pytest.approx(value[k[0]] * shares[k])


def test_decayed_credit_carries_its_own_counts(spark, monkeypatch):
    """The exact counts come with the decayed sums, listed or not; the axis is not summed and joined for them again."""
    touches = [
        ("a", ORDER - timedelta(days=29), "ga4", "email", "u"),
        ("b", ORDER - timedelta(days=2), "ga4", "affiliate", "u"),
        ("c", ORDER - timedelta(hours=1), "ga4", None, "u"),
        ("late", ORDER + timedelta(hours=1), "ga4", "display", "u"),
        ("late2", ORDER + timedelta(hours=1), "ga4", "other", "u"),
    ]
    t, c = frames(spark, touches, [("o1", ORDER, 30.0, "u"), (None, ORDER, 7.0, "u")])
    axis = attribution.touch_axis(t, c, 30)
    monkeypatch.delattr(attribution, "unlisted_counts")
    monkeypatch.delattr(attribution, "conversion_spans")
    rows = attribution.time_decay_channels(axis, 30, 7.0).collect()
    assert sorted((r.conversion_id, r.channel_key or "") for r in rows) == [("o1", ""), ("o1", "affiliate"), ("o1", "email")]
    assert sum(r.weight for r in rows) == pytest.approx(1)


def test_facts_read_stored_orders_with_their_buyers(spark):
    """Orders are ranked and meet their buyers once for conversions and facts, not once for each."""
    w = Warehouse(spark, {})
    w._stored["buyer_orders"] = spark.createDataFrame(
        [("o1", ORDER, "BE", 30.0, "u"), ("o2", ORDER, "BE", 7.0, None)],
        "order_id string, order_ts timestamp_ntz, country string, total_price_eur double, unified_user_id string",
    )
    w._stored["conversion_channels"] = spark.createDataFrame(
        [("o1", "u", 30.0, 1, "email", 1, True, True)],
        "conversion_id string, unified_user_id string, conversion_value_eur double, n_touches long, channel_key string, "
        "touches long, has_first boolean, has_last boolean",
    )
    assert [(r.conversion_id, r.unified_user_id) for r in w.build("conversions").collect()] == [("o1", "u")]
    facts = {r.conversion_id: (r.channel_key, r.revenue_linear) for r in w.build("fct_conversions").collect()}
    assert facts == {"o1": ("email", 30.0), "o2": (None, None)}


def test_orders_without_touches_stay_with_no_channel(spark):
    touches = [
        ("a", ORDER - timedelta(days=2), "ga4", "email", "u"),
        ("b", ORDER - timedelta(days=1), "ga4", "direct", "u"),
        ("c", ORDER - timedelta(hours=1), "ga4", "display", "u"),
    ]
    t, c = frames(spark, touches, [("o1", ORDER, 30.0, "u"), ("o2", ORDER, 7.0, "w")])
    orders = spark.createDataFrame(
        [("o1", ORDER, 30.0, "BE", "u"), ("o2", ORDER, 7.0, "BE", "w"), ("o3", ORDER, 5.0, "BE", None)],
        "order_id string, order_ts timestamp_ntz, total_price_eur double, country string, unified_user_id string",
    )
    facts = attribution.conversion_facts(orders, attribution.attribution_pivot(attribution.touch_axis(t, c, 30)))
    rows = [(r.conversion_id, r.channel_key, r.conversion_value_eur) for r in facts.collect()]
    assert sorted(rows, key=str) == sorted(
        [("o1", "email", 30.0), ("o1", "direct", 30.0), ("o1", "display", 30.0), ("o2", None, 7.0), ("o3", None, 5.0)],
        key=str,
    )
    assert all(r.reconciles for r in attribution.reconcile(facts).collect())


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_hot_person_is_split_in_the_interval_join(spark, tiny_skew_limits):
    touches, convs = skewed(n=6000)
    t, c = frames(spark, touches, convs)
    # Spread over input files, as map outputs are what the engine splits by.
    pairs = touchpoints.touchpoints_enriched(t.repartition(12), c, 30)
    rows, plan = executed(pairs)
    assert "skew=true" in plan
    want = brute_pairs(touches, convs, 30)
    assert len(rows) == sum(len(h) for h in want.values())
