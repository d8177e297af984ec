"""Spark session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "wayfare",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with UTC clock and adaptive execution; the cluster sets the rest.

    Adaptive execution coalesces small shuffle partitions and splits skewed
    ones, so on a cluster `shuffle_partitions` should be generous (total
    shuffle bytes / 128 MB); on one machine, the core count.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A hot key is split even where that costs one more shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # A full build generates more classes than the default cache holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.parquet.compression.codec", "snappy")
        # Streaming state on disk, so that it may outgrow an executor's heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediates, visible to every executor.

    One rule for every master: `spark.checkpoint.dir`, else the context's
    checkpoint folder, else a folder beside the warehouse's tables, which all
    executors share as well.
    """
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    )


def new_run_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def store(
    df: DataFrame, path: str, partition_by: list[str] | None = None
) -> DataFrame:
    """Write a table and read it back: lineage ends here, and lost executors cost no rework."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the files of a query's shuffles go when it ends, not when the driver's collector finds them.

    For steps that `store` what they compute: nothing reads their shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the cluster's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
