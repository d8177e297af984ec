"""Incremental ingest: files as they land -> bronze, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import path_exists
from wayfare.sources.bronze import table_path
from wayfare.sources.schemas import BRONZE, LAYOUT


def landed_stream(
    spark: SparkSession, path: str, name: str, file_format: str = "parquet"
) -> DataFrame:
    """Files of a bronze table's shape, as a stream."""
    return spark.readStream.schema(BRONZE[name]).format(file_format).load(path)


def ingest_events(stream: DataFrame, root: str, name: str, event_ts: str = "event_ts") -> str:
    """Append what has landed since the last call to bronze, by event day.

    The stream's own log remembers which files were taken, so calling again is
    the daily run. Every row is kept, however late. An event that is delivered
    again is dropped: it meets the stored events of the days that the delivery
    touches, no other folder is opened. The same comparison makes a repeated
    batch harmless. Rows without an event id are never taken for a repetition.
    """
    path = table_path(root, *LAYOUT[name])
    stored = T.StructType([*stream.schema.fields, T.StructField("dt", T.DateType())])

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("dt", F.col(event_ts).cast("timestamp_ntz").cast("date"))
        has_id = F.col("event_id").isNotNull()
        new = rows.where(has_id).dropDuplicates(["event_id"])
        if path_exists(spark, path):
            # One value per calendar day of the delivery.
            days = [r.dt for r in rows.select("dt").distinct().collect()]
            touched = F.col("dt").isin([d for d in days if d is not None])
            if None in days:
                touched = touched | F.col("dt").isNull()
            known = spark.read.schema(stored).parquet(path).where(touched & has_id)
            new = new.join(known.select("event_id"), "event_id", "left_anti").select(*rows.columns)
        (
            new.unionByName(rows.where(~has_id))
            .hint("rebalance", "dt")
            .write.mode("append")
            .partitionBy("dt")
            .parquet(path)
        )

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", f"{root}/_progress/{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path
