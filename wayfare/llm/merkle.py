"""Merkle manifest of a table: one root, and a proof for every row.

Each row is hashed to a leaf. Leaves of a group are numbered by id, eight
consecutive nodes become one of the next level until one is left, the group's
subroot; the subroots, numbered by group, climb to the root in the same way.

Per level, lag and lead of 1 to `FANOUT` - 1 places supply the siblings, masked
by the node's slot in its run and the run's length, and the node in the first
slot hashes the run to its parent. The windows never run over a whole group:
they are cut into blocks of whole runs. Numbers come from a range partitioning
by (group, id, leaf, a number per row), written once, and the row counts of its
parts, so neither a group with most of the rows nor rows that agree in
everything are sorted or counted by one task.

A row's path, the siblings of its node and of all nodes above, goes down from
the root level by level; folding a leaf through it gives the root that the leaf
proves. A group without a name comes before all others. Rows without an id come
first in their group; rows with the same id are ordered by leaf, so the root
does not depend on their order. Missing values and empty texts hash differently.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import one_of_each
from wayfare.session import new_run_dir, store

FANOUT = 8
# Nodes per window: whole runs.
BLOCK = FANOUT**2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROW_BITS = 33


def _field(c: Column) -> Column:
    """`-` for null, else the UTF-8 length, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def _group(name: Column) -> Column:
    """The group as a text that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str], run: str, label: str) -> DataFrame:
    """`rows(tree, hash, ...)` -> the same with `pos`, gapless from 0 in each tree, and `n`, the tree's size."""
    salted = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    key = ["tree", *[F.col(c).asc_nulls_first() for c in order], "hash", "salt"]
    ranged = salted.repartitionByRange(*key).sortWithinPartitions(*key).drop("salt")
    # The id's upper bits are the part, the lower ones count the part's rows.
    placed = store(ranged.withColumn("row", F.monotonically_increasing_id()), f"{run}/{label}")
    part = F.shiftright("row", _ROW_BITS).alias("part")
    parts = placed.groupBy("tree", part).agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    tree = Window.partitionBy("tree")
    so_far = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = parts.select(
        "tree",
        "part",
        (F.sum("rows").over(so_far) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    return (
        placed.withColumn("part", part)
        .join(shifts, ["tree", "part"])
        .withColumn("pos", F.col("row") + F.col("shift"))
        .drop("row", "part", "shift")
    )


def _siblings(nodes: DataFrame) -> DataFrame:
    """Nodes of trees with several, with `before` and `behind`: the run's other nodes, joined."""
    block = Window.partitionBy("tree", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - (F.col("pos") - slot))
    none = F.lit("")
    before = [F.when(slot >= j, F.lag("hash", j).over(block)).otherwise(none) for j in range(FANOUT - 1, 0, -1)]
    behind = [F.when(slot + j < length, F.lead("hash", j).over(block)).otherwise(none) for j in range(1, FANOUT)]
    return nodes.where("n > 1").select("*", F.concat(*before).alias("before"), F.concat(*behind).alias("behind"))


def _parents(nodes: DataFrame) -> DataFrame:
    """What the runs of a level hash to, from the node in the first slot of each."""
    return (
        _siblings(nodes.select("tree", "n", "pos", "hash"))
        .where(F.col("pos") % FANOUT == 0)
        .select(
            "tree",
            F.ceil(F.col("n") / FANOUT).alias("n"),
            F.floor(F.col("pos") / FANOUT).alias("pos"),
            F.sha2(F.concat("hash", "behind"), 256).alias("hash"),
        )
    )


def climb(nodes: DataFrame, run: str, label: str) -> list[DataFrame]:
    """`nodes(tree, n, pos, hash)` -> all levels, each written; a tree ends in the level where its `n` is 1."""
    levels = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        levels.append(store(_parents(levels[-1]), f"{run}/{label}-{len(levels)}"))
        largest = -(-largest // FANOUT)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """`climb` -> `(tree, hash)`: what remains of each tree."""
    ends = [level.where("n = 1").select("tree", "hash") for level in levels]
    out = ends[0]
    for end in ends[1:]:
        out = out.unionByName(end)
    return out


def paths(levels: list[DataFrame], with_path: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`climb` -> the lowest level's rows with `top` and `path`, which `with_path` gives to the trees' tops.

    `path` lists (before, behind) from the node's own run up to the root.
    """
    known = None
    for level in reversed(levels):
        ends = with_path(level.where("n = 1"))
        if known is None:
            found = ends
        else:
            up = known.select("tree", F.col("pos").alias("up"), "top", F.col("path").alias("rest"))
            inner = _siblings(level).withColumn("up", F.floor(F.col("pos") / FANOUT)).join(up, ["tree", "up"])
            own = F.array(F.struct("before", "behind"))
            found = ends.unionByName(inner.withColumn("path", F.concat(own, "rest")).drop("up", "rest", "before", "behind"))
        known = found
    return known


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(run["before"], node, run["behind"]), 256))


def tampered_text(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def manifest(docs: DataFrame, group: str = "lang") -> DataFrame:
    """`docs(doc_id, source, lang, n_chars, text)` -> a row per row.

    doc_id, leaf, subroot, root, path, and `tampered_leaf`: the leaf of the
    text in lower case where 3 divides the id's checksum, else null.
    """
    run = new_run_dir(docs.sparkSession, "merkle")
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    columns = [F.col(c) for c in names]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = one_of_each(docs, *names).select(
        _group(F.col(group)).alias("tree"),
        "doc_id",
        leaf_hash(columns).alias("hash"),
        F.when(chosen, leaf_hash([*columns[:-1], tampered_text(F.col("text"))])).alias("tampered_leaf"),
    )
    leaves = numbered(rows, ["doc_id"], run, "leaves")
    lower = climb(leaves, run, "nodes")
    named = tops(lower).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    upper = climb(numbered(named, ["name"], run, "subroots"), run, "upper")
    root = tops(upper).first()
    top = F.lit(root["hash"] if root else None).cast("string")
    none = F.array().cast("array<struct<before:string,behind:string>>")
    subroots = paths(upper, lambda end: end.withColumns({"top": F.lit(""), "path": none}))
    subroots = subroots.select(F.col("name").alias("tree"), F.col("hash").alias("top"), "path")
    subroots = store(subroots, f"{run}/subroot-paths")
    return paths(lower, lambda end: end.join(subroots, "tree")).select(
        "doc_id", F.col("hash").alias("leaf"), F.col("top").alias("subroot"), top.alias("root"), "path", "tampered_leaf"
    )
