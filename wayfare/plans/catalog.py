"""Every registered query: (spark, folder of the driver's tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.keys import email_hash, fixed, ip_prefix, phone_hash
from wayfare.operators import attribution, dimensions, identity, privacy, quality, sessions, staging
from wayfare.params import MODELS, Params
from wayfare.plans import contracts, erasure, monitoring, reports, silver
from wayfare.plans.warehouse import Warehouse
from wayfare.session import new_run_dir
from wayfare.sources import bronze as bronze_io
from wayfare.sources import audit, landed
from wayfare.sources.published import publish, read_published
from wayfare.sources.testbed import load_bronze
from wayfare.streaming.ingest import ingest_events, landed_stream
from wayfare.streaming.sessions import append_closed, cookie_sessions, keep_session_parts, session_table

# The clock and report windows of the registered queries.
PARAMS = Params(as_of=datetime(2024, 3, 1))
RUNS_AS_OF = datetime(2024, 1, 31)
WINDOW = (date(2024, 1, 1), date(2024, 1, 30))
LATE_WINDOW = (date(2024, 1, 10), date(2024, 2, 10))
LOOKBACK = (date(2024, 1, 31), 14)
PURGE_AS_OF = date(2026, 3, 16)
SECOND_DELIVERY = date(2024, 1, 10)
LAST_DAYS = datetime(2024, 1, 28)
LONG_TIMEOUT = 720
STREAMED = ["event_id", "event_name", "event_ts", "ga_client_id"]

_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One warehouse per session and input folder: stored tables are written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, load_bronze(spark, sf_dir), PARAMS)
    return _OPEN[key]


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Doubles cut to `digits`: sums of doubles depend on the order of addition."""
    return df.select(
        *[fixed(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def portable(df: DataFrame) -> DataFrame:
    """Days, and the open end of a validity, as text.

    Client libraries disagree on both: a day is a date in one and a timestamp
    in the other, and the year 9999 is beyond a nanosecond clock.
    """
    as_text = [c for c, t in df.dtypes if t == "date" or c == "valid_to"]
    return df.withColumns({c: F.col(c).cast("string") for c in as_text})


Query = Callable[[Warehouse], DataFrame]


def _model(name: str, digits: int | None = None) -> Query:
    return lambda w: w.build(name) if digits is None else rounded(w.build(name), digits)


# -- sources and sinks -------------------------------------------------------


def bronze_roundtrip(w: Warehouse) -> DataFrame:
    """Deliver web events by day, deliver them all again, read the folder."""
    root = new_run_dir(w.spark, "bronze")
    days = w.bronze["ga4_events"].withColumn("dt", F.col("event_ts").cast("date"))
    for _ in range(2):
        bronze_io.write_deliveries(days, root, "ga4", "events")
    return bronze_io.read_bronze(w.spark, root, "ga4_events")


def bronze_lookback(w: Warehouse) -> DataFrame:
    root = new_run_dir(w.spark, "bronze")
    days = w.bronze["email_events"].withColumn(
        "dt", F.col("event_ts").cast("timestamp_ntz").cast("date")
    )
    bronze_io.write_deliveries(days, root, "email", "events")
    return bronze_io.lookback(bronze_io.read_bronze(w.spark, root, "email_events"), *LOOKBACK)


def retention_purge(w: Warehouse) -> DataFrame:
    """What the retention periods leave of each source, per delivery day."""
    epoch_day = F.date_add(F.lit(date(1970, 1, 1)), F.floor(F.col("event_time") / 86400).cast("int"))
    web = w.bronze["ga4_events"].withColumn("dt", F.col("event_ts").cast("date"))
    pixel = w.bronze["meta_pixel_events"].withColumn("dt", epoch_day)
    orders = w.bronze["shopify_orders"].withColumn(
        "dt", F.col("created_at").cast("timestamp_ntz").cast("date")
    )
    email = w.bronze["email_events"].withColumn(
        "dt", F.col("event_ts").cast("timestamp_ntz").cast("date")
    )
    kept = None
    for source, df in {"ga4": web, "meta": pixel, "shopify": orders, "email": email}.items():
        left = (
            # Three years for e-mail: seen from a year later than the others.
            bronze_io.retained_email(df, PURGE_AS_OF.replace(year=2027))
            if source == "email"
            else bronze_io.retained(df, source, PURGE_AS_OF)
        )
        part = left.groupBy(F.lit(source).alias("source"), "dt").agg(
            F.count(F.lit(1)).alias("rows_kept")
        )
        kept = part if kept is None else kept.unionByName(part)
    return kept


def publish_roundtrip(w: Warehouse) -> DataFrame:
    root = new_run_dir(w.spark, "gold")
    publish(w.build("fct_sessions"), root, "fct_sessions")
    return read_published(w.spark, root, "fct_sessions")


_ORDER_RECORD = (
    "order_id string, customer_id bigint, email string, created_at string, "
    "total_price_eur double, currency string, consent_status string"
)


def json_pages_to_bronze(w: Warehouse) -> DataFrame:
    """Orders landed as `{"orders": [...]}` pages of 250, one page per line, back to rows."""
    path = new_run_dir(w.spark, "landing")
    record = F.struct(*[c.split(" ")[0] for c in _ORDER_RECORD.split(", ")])
    number = F.substring("order_id", 5, 20).cast("bigint")
    pages = (
        w.bronze["shopify_orders"]
        .groupBy(F.floor(number / 250).alias("page"))
        .agg(F.collect_list(record).alias("orders"))
        .select(F.to_json(F.struct("orders")).alias("value"))
    )
    pages.write.text(path)
    return landed.read_pages(w.spark, path, "orders", _ORDER_RECORD, multiline=False)


def retention_purge_email(w: Warehouse) -> DataFrame:
    """E-mail events delivered by day, purged on storage, read back."""
    root = new_run_dir(w.spark, "bronze")
    days = w.bronze["email_events"].withColumn("dt", F.col("event_ts").cast("timestamp_ntz").cast("date"))
    bronze_io.write_deliveries(days, root, "email", "events")
    bronze_io.purge_email(w.spark, root, PURGE_AS_OF.replace(year=2027))
    return bronze_io.read_bronze(w.spark, root, "email_events")


def publish_silver(w: Warehouse) -> DataFrame:
    """All staging models stored; then one day of web events comes again, dearer by one, and is refreshed."""
    root = new_run_dir(w.spark, "silver")
    silver.publish_silver(w, root)
    again = F.col("event_ts").cast("date") == F.lit(SECOND_DELIVERY)
    web = w.bronze["ga4_events"]
    dearer = web.withColumn("value_eur", F.when(again, F.col("value_eur") + 1.0).otherwise(F.col("value_eur")))
    later = Warehouse(w.spark, w.bronze | {"ga4_events": dearer}, w.params)
    touched = web.where(again).select(F.col("event_ts").cast("date").alias(silver.DAY))
    silver.refresh_silver(later, root, "stg_ga4_events", touched)
    out = None
    for name in silver.DAY_OF:
        stored = silver.read_silver(w.spark, root, name)
        value = F.sum("value_eur") if "value_eur" in stored.columns else F.lit(None).cast("double")
        part = stored.groupBy(F.lit(name).alias("table_name"), silver.DAY).agg(
            F.count(F.lit(1)).alias("rows"), value.alias("value_eur")
        )
        out = part if out is None else out.unionByName(part)
    return rounded(out, 2)


_PAGE_TEXT = "{'data': [{'ad_id': "


def _paged(rows: DataFrame, record: Column, envelope: str, path: str) -> None:
    """Records as pages of about a hundred, one page per line, and one line that is no JSON."""
    pages = (
        rows.select(F.pmod(F.xxhash64(*rows.columns), F.lit(16)).alias("page"), record.alias("r"))
        .groupBy("page")
        .agg(F.collect_list("r").alias(envelope))
        .select(F.to_json(F.struct(envelope)).alias("value"))
    )
    pages.write.mode("append").text(path)
    rows.sparkSession.createDataFrame([(_PAGE_TEXT,)], "value string").write.mode("append").text(path)


def ad_insights_to_bronze(w: Warehouse) -> DataFrame:
    """Web events counted per day, campaign and source as an ad report, landed as pages, read to bronze.

    Clicks of one source come as text that is no number, and a field is unknown.
    """
    path, root = new_run_dir(w.spark, "landing"), new_run_dir(w.spark, "bronze")
    per_ad = w.bronze["ga4_events"].groupBy(
        F.col("event_ts").cast("date").cast("string").alias("day"), "campaign", "source"
    ).agg(F.count(F.lit(1)).alias("n"), F.count("value_eur").alias("paid"))
    text = F.col("n").cast("string")
    record = F.struct(
        F.concat_ws("/", "day", "campaign", "source").alias("ad_id"),
        F.col("campaign").alias("campaign_name"),
        text.alias("impressions"),
        F.when(F.col("source") == "google", F.lit("n/a")).otherwise(text).alias("clicks"),
        F.concat(F.col("paid").cast("string"), F.lit(".50")).alias("spend"),
        F.array(F.struct(F.lit("view").alias("action_type"), text.alias("value"))).alias("actions"),
        F.col("source").alias("publisher"),
    )
    _paged(per_ad, record, "data", path)
    records = landed.read_raw_records(w.spark, path, "data", multiline=False)
    bronze_io.write_partitioned(landed.ad_insights_rescued(records), root, "meta", "ad_insights", date(2024, 3, 1))
    stored = bronze_io.read_bronze(w.spark, root, "meta_ad_insights")
    unread = landed.bad_pages(records).agg(F.sum("bad").alias("bad_pages"))
    return stored.select(
        "ad_id", "campaign_name", "impressions", "clicks", "spend",
        F.get("actions", F.lit(0))["value"].alias("viewed"),
        F.col("rescued")["clicks"].alias("rescued_clicks"),
        F.col("rescued")["publisher"].alias("rescued_publisher"),
        F.lit(unread.first()["bad_pages"]).alias("bad_pages"),
    )


def web_report_to_bronze(w: Warehouse) -> DataFrame:
    """Web events counted by the report's dimensions, landed as pages of positional values, read to bronze."""
    path, root = new_run_dir(w.spark, "landing"), new_run_dir(w.spark, "bronze")
    names = [n for n in landed.WEB_REPORT_DIMENSIONS if n != "event_date"]
    day = F.date_format("event_ts", "yyyyMMdd").alias("event_date")
    counted = w.bronze["ga4_events"].groupBy(*names, day).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ga_session_id").alias("s"), F.count_distinct("ga_client_id").alias("u")
    )
    users = F.when(F.col("source") == "google", F.lit("(hidden)")).otherwise(F.col("u").cast("string"))

    def cells(*values: Column) -> Column:
        return F.array(*[F.struct(v.cast("string").alias("value")) for v in values])

    record = F.struct(
        cells(*[F.col(n) for n in landed.WEB_REPORT_DIMENSIONS]).alias("dimension_values"),
        cells(F.col("n"), F.col("s"), users).alias("metric_values"),
    )
    _paged(counted, record, "rows", path)
    records = landed.read_raw_records(w.spark, path, "rows", multiline=False)
    bronze_io.write_partitioned(landed.web_report_rescued(records), root, "ga4", "report", date(2024, 3, 1))
    stored = bronze_io.read_bronze(w.spark, root, "ga4_report")
    bad = landed.bad_pages(records).agg(F.sum("bad").alias("bad_pages")).first()["bad_pages"]
    found = {"rescued_users": F.col("rescued")["metric_2"], "bad_pages": F.lit(bad)}
    return stored.withColumns(found).drop("rescued", "dt")


def audit_append(w: Warehouse) -> DataFrame:
    """Three staging steps run under the audit: the rows they recorded."""
    root = new_run_dir(w.spark, "audited")
    steps = {
        "ga4_events": staging.web_events, "meta_pixel_events": staging.pixel_events, "email_events": staging.email_events,
    }
    for name, stage in steps.items():
        audit.run_step(
            w.bronze[name], stage, lambda df, name=name: df.write.parquet(f"{root}/{name}"), root, "staging", name
        )
    return audit.read_runs(w.spark, root).select("pipeline", "step", "environment", "status", "rows_in", "rows_out", "error")


def dim_channels(w: Warehouse) -> DataFrame:
    """The channel dimension with the web events staged under each key."""
    used = (
        w.build("stg_ga4_events").groupBy("channel_key").agg(F.count(F.lit(1)).alias("web_events"))
    )
    return w.build("dim_channels").join(used, "channel_key", "left")


def dim_dates(w: Warehouse) -> DataFrame:
    """The date dimension over the days from the first order to the last."""
    day = F.col("order_ts").cast("date")
    bounds = w.build("stg_shopify_orders").agg(
        F.min(day).alias("start_date"), F.date_add(F.max(day), 1).alias("end_date")
    )
    return dimensions.dim_dates(bounds)


# -- staging -----------------------------------------------------------------


def consent_filter(w: Warehouse) -> DataFrame:
    """Rows of each bronze table that pass, per consent."""
    kept = None
    for name in [
        "ga4_events", "meta_pixel_events", "email_events", "shopify_customers", "shopify_orders",
    ]:
        part = (
            staging.consented(w.bronze[name])
            .groupBy(F.lit(name).alias("table_name"), "consent_status")
            .agg(F.count(F.lit(1)).alias("rows_kept"))
        )
        kept = part if kept is None else kept.unionByName(part)
    return kept


def channel_mapping(w: Warehouse) -> DataFrame:
    return (
        w.bronze["ga4_events"]
        .groupBy("source", "medium")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("channel_key", staging.channel_key(F.col("medium"), F.col("source")))
    )


def email_hashes(w: Warehouse) -> DataFrame:
    return w.bronze["shopify_orders"].select(
        "order_id", email_hash(F.col("email")).alias("email_hash")
    )


def pii_minimise(w: Warehouse) -> DataFrame:
    """Phone and address as they arrive raw, and what is kept of them."""
    n = F.col("customer_id")
    phone = F.concat(F.lit("+32 (0) 47-"), n.cast("string"))
    ip = F.concat_ws(".", F.lit("10"), (n % 200).cast("string"), (n % 50).cast("string"), (n % 256).cast("string"))
    return w.bronze["shopify_customers"].select(
        "customer_id", phone_hash(phone).alias("phone_hash"), ip_prefix(ip).alias("ip_prefix")
    )


# -- sessions, touchpoints, attribution ----------------------------------------


def _long_sessions(w: Warehouse) -> DataFrame:
    return sessions.session_summary(
        sessions.sessions_stitched(
            w.build("stg_ga4_events"), w.table("identity_graph"), LONG_TIMEOUT, known_only=True
        )
    )


def _one_model(model: str) -> Query:
    def query(w: Warehouse) -> DataFrame:
        every = w.build("touchpoints_attribution").where(F.col("attribution_model") == model)
        return rounded(every, 6)

    return query


def stream_ingest(w: Warehouse) -> DataFrame:
    """Web events landed in two drops; the second brings the late half and all of the first again."""
    root = new_run_dir(w.spark, "ingest")
    events = w.bronze["ga4_events"]
    early = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for drop in (events.where(early), events):
        drop.write.mode("append").parquet(f"{root}/landed")
        ingest_events(landed_stream(w.spark, f"{root}/landed", "ga4_events"), root, "ga4_events")
    return bronze_io.read_bronze(w.spark, root, "ga4_events")


def _redelivered(w: Warehouse) -> Warehouse:
    """The same warehouse after all orders came a second time, pending ones with a corrected price.

    People and touches stay as they are, so their tables are shared.
    """
    orders = w.bronze["shopify_orders"]
    price = F.col("total_price_eur")
    again = orders.withColumn(
        "total_price_eur", F.when(F.col("financial_status") == "pending", price + 5.0).otherwise(price)
    )
    both = orders.withColumn("dt", F.lit(date(2024, 3, 1))).unionByName(
        again.withColumn("dt", F.lit(date(2024, 3, 2)))
    )
    after = Warehouse(w.spark, w.bronze | {"shopify_orders": both}, w.params)
    after.share(w, "identity_graph", "all_touches")
    return after


def stream_sessions(w: Warehouse) -> DataFrame:
    """Closed cookie sessions of the delivered web events, taken up as a stream."""
    root = new_run_dir(w.spark, "stream")
    staged = w.build("stg_ga4_events").select(*STREAMED)
    staged.write.parquet(f"{root}/landed")
    arriving = w.spark.readStream.schema(staged.schema).parquet(f"{root}/landed")
    append_closed(cookie_sessions(arriving), f"{root}/sessions", f"{root}/progress")
    return w.spark.read.parquet(f"{root}/sessions")


def stream_session_table(w: Warehouse) -> DataFrame:
    """Sessions, open ones too, after two drops; the second brings every other event, all of them late."""
    root = new_run_dir(w.spark, "parts")
    staged = w.build("stg_ga4_events").select(*STREAMED)
    late = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    for drop in (staged.where(~late | late.isNull()), staged.where(late)):
        drop.write.mode("append").parquet(f"{root}/landed")
        keep_session_parts(w.spark.readStream.schema(staged.schema).parquet(f"{root}/landed"), root)
    return session_table(w.spark, root, RUNS_AS_OF)


def identity_graph_grown(w: Warehouse) -> DataFrame:
    """The graph of what was there before the last days, grown by the edges that are new since."""
    b = w.bronze
    before = b | {
        "ga4_events": b["ga4_events"].where(F.col("event_ts") < F.lit(LAST_DAYS).cast("timestamp_ntz")),
        "meta_pixel_events": b["meta_pixel_events"].where(
            F.timestamp_seconds("event_time").cast("timestamp_ntz") < F.lit(LAST_DAYS).cast("timestamp_ntz")
        ),
        "shopify_orders": b["shopify_orders"].where(
            F.col("created_at").cast("timestamp_ntz") < F.lit(LAST_DAYS).cast("timestamp_ntz")
        ),
    }
    first = Warehouse(w.spark, before, w.params)
    ends = ["raw_id_src", "raw_id_dst"]
    new = w.table("identity_edges").join(first.table("identity_edges"), ends, "left_anti")
    return identity.grown_graph(first.table("identity_graph"), new)


# -- erasure -------------------------------------------------------------------


def _requests(w: Warehouse) -> DataFrame:
    """People who ask to be forgotten: buyers with a refunded order."""
    return (
        w.bronze["shopify_orders"]
        .where(F.col("financial_status") == "refunded")
        .select("email")
        .distinct()
    )


def forget_resolve(w: Warehouse) -> DataFrame:
    return privacy.resolve(_requests(w), w.table("dim_users"))


def forget_tombstones(w: Warehouse) -> DataFrame:
    return privacy.tombstones(forget_resolve(w), w.params.as_of)


def forget_cascade(w: Warehouse) -> DataFrame:
    after = erasure.forget(w, _requests(w), new_run_dir(w.spark, "erased"))
    marts = [*erasure.PERSONAL, "fct_funnel_steps"]
    return erasure.cascade_counts({n: w.table(n) for n in marts}, {n: after[n] for n in marts})


def forget_two_batches(w: Warehouse) -> DataFrame:
    """Buyers with a refunded order first, buyers from Germany next: rows per table, and tombstones."""
    root = new_run_dir(w.spark, "erased")
    erasure.forget(w, _requests(w), root)
    german = w.bronze["shopify_orders"].where(F.col("country") == "DE").select("email").distinct()
    erasure.forget(w, german, root)
    kept = ["identity_edges", "identity_graph", "all_touches", "conversions", "session_summary"]
    tables = [*erasure.PERSONAL, "fct_funnel_steps", *kept, "forgotten_users"]
    before = {n: w.table(n) for n in tables[:-1]}
    before["forgotten_users"] = forget_tombstones(w).limit(0)
    folder = erasure.current(w.spark, root)
    return erasure.cascade_counts(before, {n: read_published(w.spark, folder, n) for n in tables})


def forget_funnel(w: Warehouse) -> DataFrame:
    return erasure.forget(w, _requests(w), new_run_dir(w.spark, "erased"))["fct_funnel_steps"]


def _t(*names: str):
    """Published tables by name, as arguments."""
    return lambda w: [w.table(n) for n in names]


_MARTS = _t("dim_users", "fct_sessions", "fct_touchpoints", "fct_conversions")


def _runs(w: Warehouse) -> DataFrame:
    return w.bronze["audit_pipeline_runs"]


QUERIES: dict[str, Query] = {
    # sources and sinks
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_lookback": bronze_lookback,
    "retention_purge": retention_purge,
    "publish_roundtrip": publish_roundtrip,
    "json_pages_to_bronze": json_pages_to_bronze,
    "ad_insights_to_bronze": ad_insights_to_bronze,
    "web_report_to_bronze": web_report_to_bronze,
    "retention_purge_email": retention_purge_email,
    "publish_silver": publish_silver,
    "audit_append": audit_append,
    # staging
    "consent_filter": consent_filter,
    "stg_ga4_events": _model("stg_ga4_events"),
    "channel_mapping": channel_mapping,
    # The list column as text, which every client compares alike.
    "stg_meta_pixel_events": lambda w: w.build("stg_meta_pixel_events").withColumn(
        "content_ids", F.concat_ws(",", "content_ids")
    ),
    "stg_email_events": _model("stg_email_events"),
    "stg_shopify_orders": _model("stg_shopify_orders"),
    "stg_shopify_customers": _model("stg_shopify_customers"),
    "email_hash": email_hashes,
    "pii_minimise": pii_minimise,
    # identity
    "identity_edges": _model("identity_edges"),
    "identity_graph": _model("identity_graph"),
    "identity_graph_grown": identity_graph_grown,
    "identity_kpass": _model("identity_kpass"),
    "identity_candidates": _model("identity_candidates"),
    # sessions and funnel
    "events_with_user": lambda w: w.build("events_with_user").select(
        "event_id", "event_ts", "event_name", "ga_client_id", "unified_user_id"
    ),
    "session_gaps": _model("session_gaps"),
    "sessions_stitched": _model("sessions_stitched"),
    "fct_sessions": lambda w: sessions.session_facts(w.build("session_summary")),
    "fct_sessions_long": lambda w: sessions.session_facts(_long_sessions(w)),
    "funnel_steps": lambda w: sessions.funnel_steps(w.build("session_summary")),
    "funnel_steps_long": lambda w: sessions.funnel_steps(_long_sessions(w)),
    "fct_funnel_steps": lambda w: sessions.channel_funnel(w.build("session_summary")),
    "fct_funnel_steps_long": lambda w: sessions.channel_funnel(_long_sessions(w)),
    "stream_ingest": stream_ingest,
    "stream_sessions": stream_sessions,
    "stream_session_table": stream_session_table,
    # touchpoints
    "all_touches": _model("all_touches"),
    "conversions": _model("conversions"),
    "touchpoints_enriched": _model("touchpoints_enriched"),
    "fct_touchpoints": _model("fct_touchpoints"),
    # attribution
    "attribution_ranked": _model("attribution_ranked"),
    "attribution_first_touch": _model("attribution_first_touch", 6),
    "attribution_last_touch": _model("attribution_last_touch", 6),
    **{f"attribution_{m}": _one_model(m) for m in MODELS if m not in ("first_touch", "last_touch")},
    "touchpoints_attribution": _model("touchpoints_attribution", 6),
    "attribution_time_decay": _model("attribution_time_decay", 4),
    "attribution_time_decay_channels": _model("attribution_time_decay_channels", 4),
    "attribution_pivot": _model("attribution_pivot", 6),
    "fct_conversions": _model("fct_conversions", 6),
    "attribution_reconcile": lambda w: rounded(
        attribution.reconcile(w.table("fct_conversions")), 2
    ),
    "fct_conversions_redelivered": lambda w: rounded(_redelivered(w).build("fct_conversions"), 6),
    "attribution_reconcile_redelivered": lambda w: rounded(
        attribution.reconcile(_redelivered(w).table("fct_conversions")), 2
    ),
    # dimensions and history
    "dim_users": _model("dim_users"),
    "dim_channels": dim_channels,
    "dim_dates": dim_dates,
    "dim_users_scd2": _model("dim_users_scd2"),
    "facts_asof_user": _model("facts_asof_user"),
    # reports
    "kpi_overview": lambda w: rounded(reports.kpi_overview(*_MARTS(w)), 2),
    "kpi_overview_dedup": lambda w: rounded(
        reports.kpi_overview(*_MARTS(w), per_conversion=True), 2
    ),
    "identity_graph_stats": lambda w: rounded(
        reports.identity_graph_stats(w.table("identity_graph")), 6
    ),
    "identity_cluster_sample": lambda w: reports.identity_cluster_sample(
        w.table("identity_graph")
    ),
    "funnel_by_channel": lambda w: reports.funnel_by_channel(w.table("fct_funnel_steps")),
    "attribution_by_channel": lambda w: rounded(
        reports.attribution_by_channel(w.table("fct_conversions")), 2
    ),
    "attribution_delta": lambda w: rounded(
        reports.attribution_delta(w.table("fct_conversions")), 2
    ),
    "weekly_cohort": lambda w: rounded(reports.weekly_cohort(w.table("fct_conversions")), 2),
    "weekly_cohort_dedup": lambda w: rounded(
        reports.weekly_cohort(w.table("fct_conversions"), per_conversion=True), 2
    ),
    "top_metrics": lambda w: rounded(
        reports.top_metrics(w.table("fct_touchpoints"), w.table("fct_conversions"), *WINDOW), 2
    ),
    "top_metrics_filtered": lambda w: rounded(
        reports.top_metrics(
            w.table("fct_touchpoints"), w.table("fct_conversions"), *LATE_WINDOW, ["Meta Ads", "Mailchimp"]
        ),
        2,
    ),
    "unification_per_source": lambda w: reports.unification_per_source(
        w.table("fct_touchpoints"), *WINDOW
    ),
    "consent_registry": lambda w: reports.consent_registry(
        w.table("fct_touchpoints"), w.table("dim_users")
    ),
    "attribution_panel": lambda w: rounded(
        reports.attribution_panel(w.table("fct_conversions"), w.table("dim_channels"), *LATE_WINDOW), 2
    ),
    "gdpr_breakdown": lambda w: reports.gdpr_breakdown(w.table("dim_users")),
    # operations
    "pipeline_health": lambda w: rounded(
        monitoring.pipeline_health(_runs(w), w.table("dim_users"), *WINDOW), 4
    ),
    "quality_trend_weekly": lambda w: rounded(
        monitoring.quality_trend_weekly(_runs(w), *WINDOW), 4
    ),
    "pipeline_logs": lambda w: monitoring.pipeline_logs(_runs(w), *WINDOW, ["GA4", "Mailchimp"]),
    "system_signals": lambda w: monitoring.system_signals(
        _runs(w), w.table("dim_users"), RUNS_AS_OF
    ),
    "source_freshness": lambda w: monitoring.source_freshness(_runs(w), RUNS_AS_OF),
    "quality_status": lambda w: monitoring.quality_status(_runs(w), RUNS_AS_OF),
    "quality_alerts": lambda w: monitoring.quality_alerts(_runs(w), RUNS_AS_OF),
    "pipeline_timeline": lambda w: rounded(monitoring.pipeline_timeline(_runs(w), RUNS_AS_OF), 6),
    # quality
    "check_not_null": contracts.check_not_null,
    "check_unique": contracts.check_unique,
    "check_accepted_values": contracts.check_accepted_values,
    "check_relationships": contracts.check_relationships,
    "check_unique_combination": contracts.check_unique_combination,
    "check_between": contracts.check_between,
    "check_row_count": contracts.check_row_count,
    "check_min": lambda w: rounded(contracts.check_min(w), 2),
    "check_freshness": lambda w: rounded(contracts.check_freshness(w), 6),
    "quality_scan": lambda w: rounded(contracts.quality_scan(w), 2),
    "check_funnel_monotonic": lambda w: quality.funnel_violations(w.table("fct_funnel_steps")),
    "check_graph_orphans": lambda w: quality.graph_orphans(w.table("identity_graph")),
    "check_weights_sum_to_one": lambda w: rounded(
        attribution.weight_violations(w.build("touchpoints_attribution")), 6
    ),
    # erasure
    "forget_resolve": forget_resolve,
    "forget_cascade": forget_cascade,
    "forget_funnel": forget_funnel,
    "forget_tombstones": forget_tombstones,
    "forget_two_batches": forget_two_batches,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query):
        return lambda spark, sf_dir: portable(query(warehouse(spark, sf_dir)))

    return {name: bind(q) for name, q in QUERIES.items()}
