"""The audit table: one row per finished run of a pipeline step."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.schemas import BRONZE

TABLE = "audit_pipeline_runs"


def append_runs(runs: DataFrame, root: str) -> None:
    """Append finished runs; a missing column is written as NULL."""
    whole = runs.sparkSession.createDataFrame([], BRONZE[TABLE]).unionByName(
        runs, allowMissingColumns=True
    )
    whole.write.mode("append").parquet(f"{root}/{TABLE}")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BRONZE[TABLE]).parquet(f"{root}/{TABLE}")


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def run_step(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], object],
    root: str,
    pipeline: str,
    step: str,
    environment: str = "prod",
    clock: Callable[[], datetime] = _now,
) -> None:
    """Transform `source`, write the result and append the run's row to the audit table under `root`.

    Rows in and out are observed while the one job writes, so nothing is read a
    second time; `transform` must read `source` once, and `write` must run one
    job over its argument. A step that fails is recorded as well, with its error
    and without row counts, and the error is raised again.
    """
    spark = source.sparkSession
    seen, kept = Observation("rows_in"), Observation("rows_out")
    started, status, error = clock(), "success", None
    rows_in = rows_out = None
    try:
        counted = F.count(F.lit(1)).alias("rows")
        write(transform(source.observe(seen, counted)).observe(kept, counted))
        rows_in, rows_out = seen.get["rows"], kept.get["rows"]
    except Exception as e:
        status, error = "failed", str(e)[:1000]
        raise
    finally:
        ended = clock()
        row = (
            uuid.uuid4().hex, pipeline, step, environment, started, ended,
            int((ended - started).total_seconds() * 1000), status, rows_in, rows_out, error, None,
        )
        append_runs(spark.createDataFrame([row], BRONZE[TABLE]), root)
