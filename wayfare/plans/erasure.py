"""Right to be forgotten over the published marts.

Parquet folders have no row deletes, so the files of every stored table that hold
a forgotten person are written again into a new version folder; the version
shares all other files with the one before, and keeps its tombstones. The mark
that it is finished is written last, and readers open the newest finished
version. `remove_replaced` then deletes the files that still hold the people.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import privacy
from wayfare.operators.sessions import channel_funnel
from wayfare.plans.warehouse import Warehouse
from wayfare.session import path_exists, store
from wayfare.sources.published import drop_replaced, publish, publish_without, read_published

PERSONAL = ["fct_touchpoints", "fct_sessions", "fct_conversions", "dim_users"]
# Stored on the way to the marts, with a person in every row.
STORED = [
    "identity_graph", "all_touches", "buyer_orders", "conversions", "touch_axis", "conversion_channels", "session_summary",
]


def _version(root: str, number: int) -> str:
    return f"{root}/v{number:06d}"


def finished_versions(spark: SparkSession, root: str) -> int:
    """How many versions under `root` are finished; they are numbered from 1."""
    n = 0
    while path_exists(spark, f"{_version(root, n + 1)}/_finished/_SUCCESS"):
        n += 1
    return n


def current(spark: SparkSession, root: str) -> str | None:
    """The folder to read published tables from; None before the first erasure."""
    n = finished_versions(spark, root)
    return _version(root, n) if n else None


def forget(w: Warehouse, requests: DataFrame, root: str) -> dict[str, DataFrame]:
    """A further version under `root`, without the people behind `requests(email)`.

    It starts from the last finished version, or from the warehouse's tables
    where there is none, so earlier batches stay forgotten and their tombstones
    stay. The channel funnel has no person column and is rebuilt from the
    sessions that remain; identity edges go with the ids at their ends. An
    unknown e-mail changes nothing; a repeated one neither.
    """
    done = finished_versions(w.spark, root)
    target = _version(root, done + 1)

    def table(name: str) -> DataFrame:
        return read_published(w.spark, _version(root, done), name) if done else w.table(name)

    gone = publish(privacy.resolve(requests, table("dim_users")), target, "_forgotten")
    stones = privacy.tombstones(gone, w.params.as_of)
    if done:
        stones = table("forgotten_users").unionByName(stones)
    out = {"forgotten_users": publish(stones, target, "forgotten_users")}
    people = gone.select("unified_user_id")
    for name in PERSONAL + STORED:
        out[name] = publish_without(table(name), name, people, target)
    # Both ends of an edge are one person's, and every edge is stored in both directions.
    ids = table("identity_graph").join(people, "unified_user_id", "left_semi")
    out["identity_edges"] = publish_without(
        table("identity_edges"), "identity_edges", ids.select(F.col("raw_id").alias("raw_id_src")), target
    )
    out["fct_funnel_steps"] = publish(
        channel_funnel(out["session_summary"]), target, "fct_funnel_steps"
    )
    store(w.spark.range(1), f"{target}/_finished")
    return out


def remove_replaced(spark: SparkSession, root: str) -> int:
    """Delete, for all finished versions, the files that hold forgotten people; how many in all.

    The warehouse's own tables and the earlier versions cannot be read afterwards.
    Repeating it does no harm.
    """
    versions = range(1, finished_versions(spark, root) + 1)
    return sum(
        drop_replaced(spark, _version(root, n), name)
        for n in versions
        for name in [*PERSONAL, *STORED, "identity_edges"]
    )


def cascade_counts(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Rows per table before and after."""
    parts = None
    for name, remaining in after.items():
        counts = (
            before[name]
            .select(F.lit(1).alias("was"), F.lit(0).alias("stays"))
            .unionAll(remaining.select(F.lit(0).alias("was"), F.lit(1).alias("stays")))
            .agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("was"), F.lit(0)).alias("rows_before"),
                F.coalesce(F.sum("stays"), F.lit(0)).alias("rows_after"),
            )
        )
        parts = counts if parts is None else parts.unionByName(counts)
    return parts
