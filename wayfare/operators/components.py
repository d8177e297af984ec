"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). An edge
is kept once, as (node, parent) with parent < node. The minimum over a node's
neighbours is a grouped `min` (combined map-side) joined back on the node, so a
hub that holds a third of all edges is never collected: its minimum is one row,
and adaptive execution splits the hub's edges in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.skew import splittable
from wayfare.session import delete_path, new_run_dir, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest id the node sees."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("node").alias("id"), F.col("parent").alias("seen")),
                F.struct(F.col("parent").alias("id"), F.col("parent").alias("seen")),
            )
        ).alias("e")
    ).select("e.*")
    smallest = ends.groupBy("id").agg(F.min("seen").alias("least"))
    return (
        edges.join(smallest, splittable(F.col("parent"), F.col("id")))
        .select("node", F.col("least").alias("parent"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    smallest = edges.groupBy(F.col("node").alias("id")).agg(F.min("parent").alias("least"))
    moved = edges.join(smallest, splittable(F.col("node"), F.col("id"))).select(
        F.explode(
            F.array(
                F.struct(F.col("node").alias("node"), F.col("least").alias("parent")),
                F.struct(F.col("parent").alias("node"), F.col("least").alias("parent")),
            )
        ).alias("e")
    )
    return moved.select("e.*").where(F.col("node") != F.col("parent")).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """True when no node has two parents and no parent has a parent."""
    roles = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("node").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
                F.struct(F.col("parent").alias("id"), F.lit(0).alias("child"), F.lit(1).alias("parent")),
            )
        ).alias("r")
    ).select("r.*")
    loose = (
        roles.groupBy("id")
        .agg(F.sum("child").alias("parents"), F.max("parent").alias("is_parent"))
        .where((F.col("parents") > 1) | ((F.col("parents") == 1) & (F.col("is_parent") == 1)))
    )
    return loose.isEmpty()


def connected_components(pairs: DataFrame) -> DataFrame:
    """`pairs(src, dst)`, in any direction, self-pairs allowed -> `(id, root)`.

    `root` is the smallest id of the component (binary string order). Every
    round is written to the shared folder and read back, so the plan does not
    grow and a lost executor repeats one round at most.
    """
    spark = pairs.sparkSession
    run = new_run_dir(spark, "components")

    edges = (
        pairs.where(F.col("src") != F.col("dst"))
        .select(
            F.greatest("src", "dst").alias("node"),
            F.least("src", "dst").alias("parent"),
        )
        .distinct()
    )
    rounds, settled = 0, False
    while not settled:
        rounds += 1
        edges = store(_small_star(_large_star(edges)), f"{run}/round-{rounds}")
        if rounds > 1:
            delete_path(spark, f"{run}/round-{rounds - 1}")
        settled = _is_star_forest(edges)

    # Members, their roots and the ids that only ever met themselves; the
    # smallest candidate is the root.
    members = edges.select(F.col("node").alias("id"), F.col("parent").alias("root"))
    roots = edges.select(F.col("parent").alias("id"), F.col("parent").alias("root"))
    loners = pairs.where(F.col("src") == F.col("dst")).select(
        F.col("src").alias("id"), F.col("src").alias("root")
    )
    return (
        members.unionByName(roots)
        .unionByName(loners)
        .groupBy("id")
        .agg(F.min("root").alias("root"))
    )


def merged_roots(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """What further `pairs(src, dst)` change: `(id, root, was_root)`.

    `labels(id, root)` holds the ends of the pairs that already belong to a
    component, and its root there. Such an end stands for its whole component,
    so the rounds run over roots and new ids only, however large or deep the
    components have grown. A row with `was_root` says where that root's
    component now belongs; the others are ids seen for the first time.
    """
    ends = pairs.select("src", "dst")
    for end, other in (("src", "dst"), ("dst", "src")):
        at = labels.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        ends = ends.join(at, splittable(F.col(end), F.col("_id")), "left").select(
            F.coalesce("_root", end).alias(end), other
        )
    spark = pairs.sparkSession
    contracted = store(ends.distinct(), new_run_dir(spark, "contracted"))
    roots = labels.select(F.col("root").alias("id"), F.lit(True).alias("was_root")).distinct()
    return (
        connected_components(contracted)
        .join(roots, "id", "left")
        .select("id", "root", F.coalesce("was_root", F.lit(False)).alias("was_root"))
    )
