"""Sessions per web cookie, as a stream.

A session closes once `gap` has elapsed without an event. The batch model
counts minute boundaries instead, so the two may split differently at the edge.

Two ways. `cookie_sessions` emits a session when the watermark has passed it and
drops what comes later. `keep_session_parts` and `session_table` drop nothing:
every micro-batch leaves the sessions of its own rows, and a read merges those
that touch, so a late row extends a session, or joins two.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.session import path_exists

GAP_MINUTES = 30
_PART = (
    "ga_client_id STRING, first_ts TIMESTAMP_NTZ, last_ts TIMESTAMP_NTZ, "
    "event_count BIGINT, is_purchase_session INT"
)


def cookie_sessions(
    web: DataFrame, gap: str = "30 minutes", lateness: str = "30 minutes"
) -> DataFrame:
    """Closed sessions: cookie, first instant, closing instant, events, purchase flag.

    Events later than `lateness` are dropped by the watermark; a session is
    emitted when the watermark passes its closing instant.
    """
    return (
        web.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
        .withWatermark("event_ts", lateness)
        .groupBy("ga_client_id", F.session_window("event_ts", gap).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.max(F.when(F.col("event_name") == "purchase", 1).otherwise(0)).alias(
                "is_purchase_session"
            ),
        )
        .select(
            "ga_client_id",
            F.col("w.start").cast("timestamp_ntz").alias("session_started_at"),
            F.col("w.end").cast("timestamp_ntz").alias("session_closed_at"),
            "event_count",
            "is_purchase_session",
        )
    )


def append_closed(sessions: DataFrame, path: str, progress: str) -> None:
    """Take what has arrived, append the sessions that closed, and return."""
    query = (
        sessions.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def session_parts(web: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Sessions of the given rows: cookie, first and last instant, events, purchase flag.

    Rows without a cookie or an instant belong to no session. Rows of one cookie
    in one bucket of the gap's width are in one session, so they are counted
    together before the shuffle and a window holds a row per cookie and bucket,
    whatever the number of events.
    """
    at = F.col("event_ts").cast("timestamp")
    bucket = F.floor(F.unix_micros(at) / F.lit(gap_minutes * 60_000_000))
    rows = (
        web.where(F.col("ga_client_id").isNotNull() & F.col("event_ts").isNotNull())
        .groupBy("ga_client_id", bucket.alias("bucket"))
        .agg(
            F.min(F.col("event_ts").cast("timestamp_ntz")).alias("first_ts"),
            F.max(F.col("event_ts").cast("timestamp_ntz")).alias("last_ts"),
            F.count(F.lit(1)).alias("event_count"),
            F.max(F.when(F.col("event_name") == "purchase", 1).otherwise(0)).alias(
                "is_purchase_session"
            ),
        )
    )
    return merged_parts(rows.drop("bucket"), gap_minutes)


def merged_parts(parts: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Parts of a cookie less than the gap apart become one; a part may lie inside another."""
    along = Window.partitionBy("ga_client_id").orderBy("first_ts", "last_ts")
    reach = F.max("last_ts").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.col("first_ts") >= reach + F.make_dt_interval(mins=F.lit(gap_minutes))
    return (
        parts.withColumn("opens", F.when(reach.isNull() | apart, 1).otherwise(0))
        .withColumn("number", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("ga_client_id", "number")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("event_count").alias("event_count"),
            F.max("is_purchase_session").alias("is_purchase_session"),
        )
        .drop("number")
    )


def keep_session_parts(web: DataFrame, root: str, gap_minutes: int = GAP_MINUTES) -> None:
    """Take what has arrived and store its sessions under `root`, a folder per micro-batch.

    A repeated batch has the same number and replaces its folder, so no event
    counts twice. There is no state to lose and no watermark.
    """

    def keep(batch: DataFrame, number: int) -> None:
        session_parts(batch, gap_minutes).write.mode("overwrite").parquet(
            f"{root}/parts/batch={number}"
        )

    query = (
        web.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def session_table(
    spark: SparkSession, root: str, now: datetime, gap_minutes: int = GAP_MINUTES
) -> DataFrame:
    """All sessions of what has arrived; `is_open` where the gap has not passed at `now`."""
    if path_exists(spark, f"{root}/parts"):
        parts = spark.read.schema(_PART).parquet(f"{root}/parts").drop("batch")
    else:
        parts = spark.createDataFrame([], _PART)
    closes = F.col("last_ts") + F.make_dt_interval(mins=F.lit(gap_minutes))
    return merged_parts(parts, gap_minutes).select(
        "ga_client_id",
        F.col("first_ts").alias("session_started_at"),
        closes.alias("session_closed_at"),
        "event_count",
        "is_purchase_session",
        (closes > F.lit(now).cast("timestamp_ntz")).alias("is_open"),
    )
