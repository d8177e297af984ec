"""Silver tables: the staging models, stored by day and refreshed by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.plans.warehouse import Warehouse

# The time whose day a row is stored under.
DAY_OF = {
    "stg_ga4_events": "event_ts",
    "stg_meta_pixel_events": "event_ts",
    "stg_email_events": "event_ts",
    "stg_shopify_orders": "order_ts",
    "stg_shopify_customers": "created_at",
}
DAY = "silver_day"


def _write(df: DataFrame, root: str, name: str) -> None:
    """Days present in `df` are replaced, all others stay as they are."""
    (
        df.hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(f"{root}/{name}")
    )


def staged(w: Warehouse, name: str) -> DataFrame:
    return w.build(name).withColumn(DAY, F.col(DAY_OF[name]).cast("date"))


def publish_silver(w: Warehouse, root: str) -> None:
    """Store every staging model under `root`."""
    for name in DAY_OF:
        _write(staged(w, name), root, name)


def refresh_silver(w: Warehouse, root: str, name: str, touched: DataFrame) -> None:
    """Store the days of `touched(silver_day)` of one model again, from all deliveries.

    Only these days are written; a day whose rows are all gone must be deleted
    by the caller, as an overwrite of days replaces what it has rows for.
    """
    days = touched.select(DAY).distinct()
    _write(staged(w, name).join(days, DAY, "left_semi"), root, name)


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")
