import glob
import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.params import Params
from wayfare.plans import silver
from wayfare.plans.warehouse import MODELLED, Warehouse
from wayfare.session import shared_dir
from wayfare.sources import audit, bronze, landed
from wayfare.sources.published import read_published
from wayfare.sources.schemas import BRONZE, LAYOUT
from wayfare.sources.testbed import load_bronze
from wayfare.streaming.ingest import ingest_events, landed_stream
from wayfare.streaming.sessions import append_closed, cookie_sessions, keep_session_parts, session_table

EMAIL = BRONZE["email_events"]


def mail(i, ts="2024-01-05 10:00:00", name="campaign.sent", who="s1"):
    return (f"e{i}", name, ts, "c", who, "h", None, "granted")


def test_same_day_rerun_replaces_and_other_days_append(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([mail(1), mail(2)], EMAIL)
    bronze.write_partitioned(first, root, "email", "events", date(2024, 1, 5))
    bronze.write_partitioned(first.limit(1), root, "email", "events", date(2024, 1, 6))
    bronze.write_partitioned(spark.createDataFrame([mail(3)], EMAIL), root, "email", "events", date(2024, 1, 5))
    rows = bronze.read_bronze(spark, root, "email_events").collect()
    assert sorted((r.event_id, r.dt) for r in rows) == [("e1", date(2024, 1, 6)), ("e3", date(2024, 1, 5))]


def test_empty_delivery_leaves_nothing(spark, tmp_path):
    assert bronze.write_partitioned(spark.createDataFrame([], EMAIL), str(tmp_path), "email", "events", date(2024, 1, 5)) == ""
    assert os.listdir(tmp_path) == []


def test_lookback_opens_only_recent_folders(spark, tmp_path):
    root = str(tmp_path)
    days = spark.createDataFrame([(d,) for d in range(1, 21)], "d int").select(
        F.expr("concat('e', d)").alias("event_id"),
        *[F.lit(None).cast("string").alias(c) for c in ["event_name", "event_ts", "campaign_id", "subscriber_id", "email_hash", "url", "consent_status"]],
        F.make_date(F.lit(2024), F.lit(1), F.col("d")).alias("dt"),
    )
    bronze.write_deliveries(days, root, "email", "events")
    recent = bronze.lookback(bronze.read_bronze(spark, root, "email_events"), date(2024, 1, 20), 5)
    assert recent.count() == 6
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_purge_drops_expired_folders_only(spark, tmp_path):
    root = str(tmp_path)
    for source, name, table in (("ga4", "ga4_events", "events"), ("meta", "meta_pixel_events", "pixel_events"), ("email", "email_events", "events")):
        for day in (date(2024, 1, 15), date(2024, 1, 16), date(2025, 3, 1)):
            row = spark.createDataFrame([("x",)], "event_id string")
            bronze.write_partitioned(row, root, source, table, day)
    dropped = bronze.purge(spark, root, date(2026, 3, 16))
    assert dropped == ["ga4/events/dt=2024-01-15", "meta/pixel_events/dt=2024-01-15", "meta/pixel_events/dt=2024-01-16"]
    assert bronze.purge(spark, root, date(2026, 3, 16)) == []
    assert len(os.listdir(f"{root}/email/events")) >= 3


@pytest.mark.parametrize("day, months, want", [
    (date(2026, 3, 16), 26, date(2024, 1, 16)),
    (date(2024, 3, 31), 1, date(2024, 2, 29)),
    (date(2024, 1, 31), 2, date(2023, 11, 30)),
    (date(2024, 12, 5), 12, date(2023, 12, 5)),
])
def test_months_back_agree_with_the_engine(spark, day, months, want):
    assert bronze._months_before(day, months) == want
    assert spark.range(1).select(F.add_months(F.lit(day), -months)).first()[0] == want


def test_unsubscribed_people_expire_after_three_years(spark):
    rows = [
        mail(1, "2020-01-01 00:00:00", "campaign.unsubscribed", "gone"),
        mail(2, "2019-01-01 00:00:00", "campaign.sent", "gone"),
        mail(3, "2023-01-01 00:00:00", "campaign.unsubscribed", "recent"),
        mail(4, "2015-01-01 00:00:00", "campaign.sent", "stays"),
        mail(5, "2015-01-01 00:00:00", "campaign.sent", None),
    ]
    kept = bronze.retained_email(spark.createDataFrame(rows, EMAIL), date(2024, 1, 1))
    assert {r.event_id for r in kept.collect()} == {"e3", "e4", "e5"}


def test_paged_orders_one_file_per_page(spark, tmp_path):
    for page in range(3):
        records = [{"order_id": f"o{page}{i}", "total_price_eur": i + 0.5, "extra": 1} for i in range(4)]
        (tmp_path / f"p{page}.json").write_text(json.dumps({"orders": records}, indent=1))
    rows = landed.read_pages(spark, str(tmp_path), "orders", "order_id string, total_price_eur double")
    assert rows.columns == ["order_id", "total_price_eur"]
    assert rows.count() == 12 and rows.agg(F.sum("total_price_eur")).first()[0] == 24.0


def test_ad_insights_are_typed(spark, tmp_path):
    row = {"ad_id": "1", "impressions": "100", "spend": "12.5", "actions": [{"action_type": "click", "value": "3"}]}
    (tmp_path / "i.json").write_text(json.dumps({"data": [row]}))
    r = landed.read_ad_insights(spark, str(tmp_path)).first()
    assert (r.ad_id, r.impressions, r.spend, r.clicks, r.actions[0].value) == ("1", 100, 12.5, None, "3")


def test_web_report_cells_get_names(spark, tmp_path):
    cells = lambda *v: [{"value": x} for x in v]
    row = {
        "dimension_values": cells("page_view", "mobile", "BE", "google", "cpc", "c1", "/a", "20240101"),
        "metric_values": cells("7", "5", "3"),
    }
    (tmp_path / "r.json").write_text(json.dumps({"rows": [row]}))
    r = landed.read_web_report(spark, str(tmp_path)).first()
    assert (r.event_name, r.page_location, r.event_count, r.total_users) == ("page_view", "/a", 7, 3)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stream_takes_each_file_once_and_drops_redeliveries(spark, tmp_path):
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/bronze"

    def land(*rows):
        spark.createDataFrame(list(rows), EMAIL).coalesce(1).write.mode("append").parquet(landing)

    def run_ids():
        ingest_events(landed_stream(spark, landing, "email_events"), root, "email_events")
        return [r.event_id for r in spark.read.parquet(f"{root}/email/events").collect()]

    def run():
        return sorted(run_ids())

    land(mail(1), mail(2, "2024-01-06 00:00:00"))
    assert run() == ["e1", "e2"]
    assert run() == ["e1", "e2"]
    land(mail(2, "2024-01-06 00:00:00"), mail(3, "2024-01-06 08:00:00"))
    assert run() == ["e1", "e2", "e3"]
    # However late, a row is kept; so is one without a time, and those without an id.
    nameless = (None, *mail(0)[1:])
    land(mail(4, "2023-03-01 00:00:00"), mail(5, None), nameless, nameless)
    assert sorted(r or "" for r in run_ids()) == ["", "", "e1", "e2", "e3", "e4", "e5"]
    land(mail(5, None), mail(4, "2023-03-01 00:00:00"))
    assert len(run_ids()) == 7
    back = bronze.read_bronze(spark, root, "email_events")
    assert back.columns[-1] == "dt" and {r.event_ts for r in back.where("event_id = 'e4'").collect()} == {"2023-03-01 00:00:00"}


def test_stream_sessions_equal_the_batch_window(spark, tmp_path):
    web = spark.createDataFrame(
        [("c%d" % (i % 3), datetime(2024, 1, 1, (i * 7) % 24, (i * 13) % 60), "page_view") for i in range(200)],
        "ga_client_id string, event_ts timestamp_ntz, event_name string",
    )
    web.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(web.schema).parquet(f"{tmp_path}/in")
    append_closed(cookie_sessions(stream), f"{tmp_path}/out", f"{tmp_path}/progress")
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    last = web.agg(F.max("event_ts")).first()[0]
    batch = {tuple(r) for r in cookie_sessions(web).collect()}
    assert got == {r for r in batch if (last - r[2]).total_seconds() >= 1800}
    assert got


def test_warehouse_over_delivered_folders_equals_the_direct_one(spark, tmp_path):
    direct = load_bronze(spark, "/root/testdata/sf0.001")
    root = f"{tmp_path}/bronze"
    for name in MODELLED:
        source, table = LAYOUT[name]
        # Two deliveries: the folder holds their union.
        half = F.pmod(F.xxhash64(direct[name].columns[0]), F.lit(2))
        for i, day in enumerate((date(2024, 3, 1), date(2024, 3, 2))):
            bronze.write_partitioned(direct[name].where(half == i), root, source, table, day)
    params = Params(as_of=datetime(2024, 3, 5))
    delivered = Warehouse.over_folder(spark, root, f"{tmp_path}/gold", params)
    marts = delivered.publish_marts()
    want = Warehouse(spark, direct, params)
    for name in ("dim_users", "fct_sessions", "fct_touchpoints", "fct_conversions", "fct_funnel_steps"):
        same = marts[name].exceptAll(want.table(name)).isEmpty()
        assert same and marts[name].count() == want.table(name).count(), name
        assert read_published(spark, f"{tmp_path}/gold", name).count() == marts[name].count()


def test_audit_rows_are_appended(spark, tmp_path):
    runs = spark.createDataFrame(
        [("r1", "ga4", "bronze", "dev", datetime(2024, 1, 1), "success")],
        "run_id string, pipeline string, step string, environment string, start_ts timestamp_ntz, status string",
    )
    audit.append_runs(runs, str(tmp_path))
    audit.append_runs(runs.withColumn("run_id", F.lit("r2")), str(tmp_path))
    rows = audit.read_runs(spark, str(tmp_path)).collect()
    assert sorted(r.run_id for r in rows) == ["r1", "r2"] and rows[0].extra is None


def test_a_step_records_its_rows_and_its_failure(spark, tmp_path):
    root = str(tmp_path)
    source = spark.range(50).withColumn("x", F.col("id") % 5)
    audit.run_step(source, lambda df: df.where("x = 0"), lambda df: df.write.parquet(f"{root}/kept"), root, "p", "filter")
    with pytest.raises(RuntimeError):
        audit.run_step(source, lambda df: df, lambda df: (_ for _ in ()).throw(RuntimeError("disk full")), root, "p", "broken", "dev")
    good, bad = audit.read_runs(spark, root).orderBy(F.col("step").desc()).collect()
    assert (good.status, good.rows_in, good.rows_out, good.error) == ("success", 50, 10, None)
    assert good.rows_out == spark.read.parquet(f"{root}/kept").count() and good.duration_ms >= 0
    assert (bad.step, bad.status, bad.rows_in, bad.error, bad.environment) == ("broken", "failed", None, "disk full", "dev")


def files_of(path):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_email_purge_rewrites_only_days_that_hold_the_person(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/email/events"
    rows = [
        (f"{who}{day}", name, f"2020-01-0{day} 10:00:00", "c", who, "h", None, "granted")
        for who, name, day in [("gone", "campaign.unsubscribed", 1), ("gone", "campaign.sent", 2), ("here", "campaign.sent", 2), ("here", "campaign.sent", 3)]
    ]
    events = spark.createDataFrame(rows, EMAIL).withColumn("dt", F.col("event_ts").cast("timestamp_ntz").cast("date"))
    bronze.write_deliveries(events, root, "email", "events")
    before = files_of(path)
    assert bronze.purge_email(spark, root, date(2022, 1, 1)) == [] and files_of(path) == before
    assert bronze.purge_email(spark, root, date(2024, 1, 1)) == [date(2020, 1, 1), date(2020, 1, 2)]
    left = bronze.read_bronze(spark, root, "email_events").collect()
    assert sorted(r.event_id for r in left) == ["here2", "here3"]
    assert not os.path.exists(f"{path}/dt=2020-01-01")
    untouched = {p: t for p, t in before.items() if "dt=2020-01-03" in p}
    assert untouched and untouched.items() <= files_of(path).items()
    assert bronze.purge_email(spark, root, date(2024, 1, 1)) == []


def test_silver_refresh_writes_the_touched_day_only(spark, tmp_path):
    root = str(tmp_path)
    frames = load_bronze(spark, "/root/testdata/sf0.001")
    w = Warehouse(spark, frames, Params(as_of=datetime(2024, 3, 5)))
    silver.publish_silver(w, root)
    before = files_of(f"{root}/stg_ga4_events")
    extra = frames["ga4_events"].where("cast(event_ts as date) = date'2024-01-05'").withColumn("event_id", F.concat(F.lit("again"), "event_id"))
    later = Warehouse(spark, frames | {"ga4_events": frames["ga4_events"].unionByName(extra)}, w.params)
    touched = extra.select(F.col("event_ts").cast("date").alias(silver.DAY))
    silver.refresh_silver(later, root, "stg_ga4_events", touched)
    after = files_of(f"{root}/stg_ga4_events")
    same = {p for p in before if after.get(p) == before[p]}
    assert {p for p in before if p not in same} == {p for p in before if "silver_day=2024-01-05" in p}
    stored = silver.read_silver(spark, root, "stg_ga4_events").drop(silver.DAY)
    want = later.build("stg_ga4_events")
    assert stored.select(*want.columns).exceptAll(want).isEmpty() and stored.count() == want.count()


def test_what_does_not_fit_is_rescued(spark, tmp_path):
    pages = [
        '{"data": [{"ad_id": "1", "impressions": "7", "clicks": "x", "new": "y"}, {"ad_id": "2", "spend": "1.5"}]}',
        '{"data": [{"ad_id": "3', "[]",
    ]
    spark.createDataFrame([(p,) for p in pages], "value string").coalesce(1).write.text(f"{tmp_path}/ads")
    records = landed.read_raw_records(spark, f"{tmp_path}/ads", "data", multiline=False)
    got = {r.ad_id: r for r in landed.ad_insights_rescued(records).collect()}
    assert got.keys() == {"1", "2"} and got["2"].rescued is None and got["2"].spend == 1.5
    assert (got["1"].impressions, got["1"].clicks, got["1"].rescued) == (7, None, {"clicks": "x", "new": "y"})
    assert landed.bad_pages(records).agg(F.sum("bad")).first()[0] == 2
    cell = lambda *v: "[" + ",".join('{"value": "%s"}' % x for x in v) + "]"
    row = '{"dimension_values": %s, "metric_values": %s}' % (cell(*"abcdefghi"), cell("1", "many", "3", "4"))
    spark.createDataFrame([('{"rows": [%s]}' % row,)], "value string").write.text(f"{tmp_path}/web")
    (r,) = landed.web_report_rescued(landed.read_raw_records(spark, f"{tmp_path}/web", "rows", multiline=False)).collect()
    assert (r.event_name, r.event_date, r.event_count, r.sessions, r.total_users) == ("a", "h", 1, None, 3)
    assert r.rescued == {"dimension_8": "i", "metric_1": "many", "metric_3": "4"}


def plain_sessions(rows, now, gap=timedelta(minutes=30)):
    """Sessions the plain way: every cookie's events in order, cut where the gap has passed."""
    out = set()
    cookies = {c for _, _, t, c in rows if c is not None and t is not None}
    for cookie in cookies:
        events = sorted((t, name == "purchase") for _, name, t, c in rows if c == cookie and t is not None)
        run = []
        for t, bought in [*events, (None, False)]:
            if run and (t is None or t >= run[-1][0] + gap):
                closes = run[-1][0] + gap
                out.add((cookie, run[0][0], closes, len(run), int(any(b for _, b in run)), closes > now))
                run = []
            run.append((t, bought))
    return out


SESSION_ROWS = "event_id string, event_name string, event_ts timestamp_ntz, ga_client_id string"


def taken_up(spark, root, drops, now):
    for drop in drops:
        spark.createDataFrame(drop, SESSION_ROWS).write.mode("append").parquet(f"{root}/landed")
        keep_session_parts(spark.readStream.schema(SESSION_ROWS).parquet(f"{root}/landed"), f"{root}/kept")
    return session_table(spark, f"{root}/kept", now)


def test_late_rows_extend_and_join_sessions(spark, ts, tmp_path):
    day = lambda t: ts(f"2024-01-05T{t}")
    first = [
        ("1", "page_view", day("10:00:00"), "a"),
        ("2", "page_view", day("10:50:00"), "a"),
        ("3", "page_view", day("12:00:00"), "b"),
        ("4", "page_view", day("12:30:00"), "b"),
        ("5", "page_view", None, "b"),
        ("6", "purchase", day("09:00:00"), None),
    ]
    # Days later: one row between two sessions, one inside a session, one exactly a gap away.
    later = [("7", "purchase", ts("2024-01-09T08:00:00"), "c")]
    late = [
        ("8", "purchase", day("10:25:00"), "a"),
        ("9", "page_view", day("10:55:00"), "a"),
        ("9", "page_view", day("10:55:00"), "a"),
        ("10", "page_view", day("13:00:00"), "b"),
    ]
    now = ts("2024-01-09T08:10:00")
    got = taken_up(spark, tmp_path, [first, later, late], now)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_sessions(first + later + late, now)
    assert ("a", day("10:00:00"), day("11:25:00"), 5, 1, False) in rows
    assert [r for r in rows if r[-1]] == [("c", ts("2024-01-09T08:00:00"), ts("2024-01-09T08:30:00"), 1, 1, True)]


@pytest.mark.parametrize("seed", [5, 6])
def test_session_table_in_any_order_of_arrival(spark, ts, tmp_path, seed):
    rng = random.Random(seed)
    start = ts("2024-01-05T00:00:00")
    # A third of all rows belong to one cookie.
    rows = [
        (str(i), rng.choice(["page_view", "purchase"]), start + timedelta(seconds=rng.randrange(3 * 86400)), rng.choice("hhabc"))
        for i in range(600)
    ]
    now = start + timedelta(days=2)
    got = taken_up(spark, tmp_path, [rows[:200], rows[200:250], rows[250:]], now)
    assert {tuple(r) for r in got.collect()} == plain_sessions(rows, now)


def test_a_repeated_batch_counts_once_and_no_batch_gives_no_session(spark, ts, tmp_path):
    now = ts("2024-01-06T00:00:00")
    assert session_table(spark, f"{tmp_path}/none", now).collect() == []
    rows = [("1", "page_view", ts("2024-01-05T10:00:00"), "a")]
    want = [tuple(r) for r in taken_up(spark, tmp_path, [rows], now).collect()]
    # The stream forgets that it has finished the batch, as after a crash.
    for name in os.listdir(f"{tmp_path}/kept/progress/commits"):
        os.remove(f"{tmp_path}/kept/progress/commits/{name}")
    keep_session_parts(spark.readStream.schema(SESSION_ROWS).parquet(f"{tmp_path}/landed"), f"{tmp_path}/kept")
    assert [tuple(r) for r in session_table(spark, f"{tmp_path}/kept", now).collect()] == want
