"""Bronze tables: one folder per source and table, one partition per delivery day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.skew import splittable
from wayfare.params import RETENTION_MONTHS, UNSUBSCRIBED_MONTHS
from wayfare.session import delete_path, new_run_dir, store
from wayfare.sources.schemas import BRONZE, LAYOUT


def table_path(root: str, source: str, table: str) -> str:
    return f"{root}/{source}/{table}"


def read_bronze(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All deliveries of a bronze table; filters on `dt` prune folders."""
    return spark.read.schema(BRONZE[name] + ", dt date").parquet(table_path(root, *LAYOUT[name]))


def write_deliveries(df: DataFrame, root: str, source: str, table: str) -> str:
    """Write rows that carry their delivery day in `dt`.

    Days present in `df` are replaced, all others stay: a rerun of a day is
    idempotent. The rebalance hint gathers a day into few files and lets
    adaptive execution split a day that is too large for one.
    """
    path = table_path(root, source, table)
    (
        df.hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("dt")
        .parquet(path)
    )
    return path


def write_partitioned(
    df: DataFrame, root: str, source: str, table: str, delivered: date
) -> str:
    """Write one day's delivery; an empty one is skipped and leaves nothing behind."""
    if df.isEmpty():
        return ""
    return write_deliveries(df.withColumn("dt", F.lit(delivered)), root, source, table)


def lookback(df: DataFrame, as_of: date, days: int) -> DataFrame:
    """Deliveries of the last `days` days; a partition filter, so old folders are not opened."""
    return df.where((F.col("dt") >= F.lit(as_of - timedelta(days=days))) & (F.col("dt") <= F.lit(as_of)))


def _kept_from(as_of: date, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def retained(df: DataFrame, source: str, as_of: date) -> DataFrame:
    """Deliveries of `source` still inside its retention period; others are kept for good."""
    months = RETENTION_MONTHS.get(source)
    return df if months is None else df.where(F.col("dt") >= _kept_from(as_of, months))


def retained_email(df: DataFrame, as_of: date) -> DataFrame:
    """E-mail events, less those of people whose last unsubscribe is over three years old."""
    left = (
        df.where((F.col("event_name") == "campaign.unsubscribed") & F.col("subscriber_id").isNotNull())
        .groupBy(F.col("subscriber_id").alias("left_id"))
        .agg(F.max(F.col("event_ts").cast("timestamp_ntz").cast("date")).alias("left_on"))
        .where(F.col("left_on") < _kept_from(as_of, UNSUBSCRIBED_MONTHS))
        .select("left_id")
    )
    return df.join(left, splittable(F.col("subscriber_id"), F.col("left_id")), "left_anti")


def purge_email(spark: SparkSession, root: str, as_of: date) -> list[date]:
    """Delete on storage what `retained_email` leaves out; returns the days that were written again.

    Only days that hold such an event are rewritten, from a copy of their other
    rows in the shared folder, so a run that stops half-way is repeated without
    loss. A day of which nothing is left loses its folder.
    """
    name = "email_events"
    path = table_path(root, *LAYOUT[name])
    events = read_bronze(spark, root, name)
    kept = retained_email(events, as_of)
    sizes = events.groupBy("dt").agg(F.count(F.lit(1)).alias("all_rows"))
    left = kept.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
    # A row per delivery day, bounded by the calendar.
    touched = {
        r.dt: r.rows
        for r in sizes.join(left, "dt", "left").where("rows is null or rows < all_rows").select("dt", "rows").collect()
    }
    if touched:
        days = [F.lit(d) for d, n in touched.items() if n]
        if days:
            copy = store(kept.where(F.col("dt").isin(*days)), new_run_dir(spark, "purged"))
            write_deliveries(copy, root, *LAYOUT[name])
        for day, n in touched.items():
            if not n:
                delete_path(spark, f"{path}/dt={day.isoformat()}")
    return sorted(touched)


def purge(spark: SparkSession, root: str, as_of: date) -> list[str]:
    """Drop expired day folders of every table with a fixed period; returns the folders.

    Only folder names are listed; no row is read or rewritten.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    dropped = []
    for source, table in LAYOUT.values():
        months = RETENTION_MONTHS.get(source)
        folder = jvm.org.apache.hadoop.fs.Path(table_path(root, source, table))
        fs = folder.getFileSystem(conf)
        if months is None or not fs.exists(folder):
            continue
        oldest = _months_before(as_of, months)
        for entry in fs.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith("dt=") and date.fromisoformat(name[3:]) < oldest:
                fs.delete(entry.getPath(), True)
                dropped.append(f"{source}/{table}/{name}")
    return sorted(dropped)


def _months_before(day: date, months: int) -> date:
    """The same day `months` earlier, or the last day of that month: as `add_months`."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    first_after = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (first_after - timedelta(days=1)).day
    return date(year, month + 1, min(day.day, last))
