"""Shards of near equal size from sampled splitters.

Records are ordered by a hash of their text, so equal texts stand together. A
sample of the keys, drawn with a chance in proportion to size, gives quantiles
as range boundaries; a key that fills a range on its own gets one to itself.
Ranges above a shard's fair share are subdivided by record, and smaller ones as
well, down to a sixteenth of a share, where the shards would not come out near
equal otherwise. Measured ranges are then dealt to shards, the largest first and
always to the emptiest. So shards are near equal in bytes whatever the groups,
and a group of equal texts stays together as far as that allows.

The driver sees sampled keys and ranges, both bounded by `MAX_RANGES`; records
are numbered inside blocks of about `BLOCK_ROWS` rows.

A null text has size 1 and checksum 0. Rows that repeat are separate records,
told apart by a number that is written with them.
An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.skew import splittable
from wayfare.session import new_run_dir, store

SHARDS = 8
RANGES_PER_SHARD = 64
RANGE_BYTES = 256 << 20
MAX_RANGES = 1 << 16
SAMPLES_PER_RANGE = 16
BLOCK_ROWS = 1 << 16
# Planned ranges above which a range is subdivided: the first that levels the shards to within TOLERANCE of the best.
LARGE = (RANGES_PER_SHARD, 16, 4)
TOLERANCE = 0.02
LAW = "bytes"


def records(docs: DataFrame, whole: bool = False) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id, size, text_crc32, the ordering key, a hash of the record, and its number.

    With `whole`, all columns of the input as one, `row`.
    """
    key = F.xxhash64("text")
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        key.alias("key"),
        F.xxhash64(key, "doc_id").alias("own"),
        F.monotonically_increasing_id().alias("number"),
        *rest,
    )


def told_apart(rows: DataFrame) -> DataFrame:
    """Stored `records`, with the number taken into the hash of those that agree with another."""
    repeated = rows.groupBy(F.col("own").alias("of")).agg(F.count("*").alias("n")).where("n > 1").select("of")
    own = F.when(F.col("of").isNull(), F.col("own")).otherwise(F.xxhash64("own", "number"))
    return rows.join(repeated, splittable(F.col("own"), F.col("of")), "left").withColumn("own", own).drop("of")


def splitters(rows: DataFrame, total: int, n_ranges: int) -> np.ndarray:
    """Boundaries between ranges of about equal bytes, from a size-weighted sample of keys."""
    wanted = n_ranges * SAMPLES_PER_RANGE
    expected = F.col("size") * F.lit(wanted / total)
    # A hash of the record decides, so that every run draws the same sample.
    chance = F.shiftrightunsigned(F.xxhash64("own", F.lit("sample")), 11) / F.lit(float(1 << 53))
    sample = (
        rows.where(chance < expected)
        .select("key", F.greatest(expected, F.lit(1.0)).alias("weight"))
        .toArrow()
    )
    keys, weights = sample["key"].to_numpy(), sample["weight"].to_numpy()
    order = np.lexsort((weights, keys))
    keys, weights = keys[order], weights[order]
    if not len(keys):
        return np.empty(0, np.int64)
    share = np.cumsum(weights) / weights.sum() * n_ranges
    bounds = keys[np.unique(np.searchsorted(share, np.arange(1, n_ranges)))]
    values, place = np.unique(keys, return_inverse=True)
    heavy = values[np.bincount(place, weights) >= SAMPLES_PER_RANGE]
    alone = np.concatenate([heavy, heavy[heavy < np.iinfo(np.int64).max] + 1])
    return np.unique(np.concatenate([bounds, alone]))


class Layout:
    """Which unit, a range or a part of one, a record falls into; then its shard and block."""

    def __init__(self, bounds: np.ndarray, parts: np.ndarray):
        self.bounds, self.parts = bounds, parts
        self.first = np.concatenate([[0], np.cumsum(parts)[:-1]])
        self.shard = self.blocks = None

    def unit(self, key: np.ndarray, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.bounds, key, side="right")
        return self.first[at] + own.view(np.uint64) % self.parts[at].astype(np.uint64)

    def place(self, key: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unit = self.unit(key, own).astype(np.int64)
        mixed = (own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return unit, self.shard[unit], (mixed % self.blocks[unit].astype(np.uint64)).astype(np.int64)


def _measured(rows: DataFrame, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of every unit, summed by Spark."""
    n = int(layout.parts.sum())
    shared = rows.sparkSession.sparkContext.broadcast(layout)

    @F.pandas_udf("long")
    def unit(key: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series(shared.value.unit(key.to_numpy(), own.to_numpy()).astype(np.int64))

    sums = (
        rows.select(unit("key", "own").alias("unit"), "size")
        .groupBy("unit")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        .toArrow()
    )
    size, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = sums["unit"].to_numpy()
    size[at], count[at] = sums["bytes"].to_numpy(), sums["n"].to_numpy()
    return size, count


def deal(sizes: np.ndarray, n_shards: int) -> np.ndarray:
    """The largest first, always to the emptiest shard."""
    heap = [(0.0, s) for s in range(n_shards)]
    out = np.zeros(len(sizes), np.int32)
    for i in np.argsort(-sizes, kind="stable").tolist():
        filled, shard = heapq.heappop(heap)
        out[i] = shard
        heapq.heappush(heap, (filled + float(sizes[i]), shard))
    return out


def _unevenness(sizes: np.ndarray, n_shards: int) -> float:
    """Largest less smallest shard, as a part of a fair share."""
    filled = np.bincount(deal(sizes, n_shards), sizes, n_shards)
    return float(filled.max() - filled.min()) / (sizes.sum() / n_shards)


def plan(rows: DataFrame, n_shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> Layout | None:
    """The layout for stored `records`; None for an empty table."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return None
    n_ranges = min(MAX_RANGES, max(n_shards * RANGES_PER_SHARD, total // RANGE_BYTES))
    bounds = splitters(rows, total, n_ranges)
    layout = Layout(bounds, np.ones(len(bounds) + 1, np.int64))
    size, count = _measured(rows, layout)
    unit_bytes = total / (n_shards * RANGES_PER_SHARD)
    ways = [np.where(size > large * unit_bytes, np.ceil(size / unit_bytes), 1).astype(np.int64) for large in LARGE]
    uneven = [_unevenness(np.repeat(size / parts, parts), n_shards) for parts in ways]
    parts = next(parts for parts, u in zip(ways, uneven, strict=True) if u <= min(uneven) + TOLERANCE)
    if (parts > 1).any():
        layout = Layout(bounds, parts)
        size, count = _measured(rows, layout)
    layout.shard = deal(size, n_shards)
    layout.blocks = np.maximum(1, -(-count // block_rows))
    return layout


def shard(docs: DataFrame, n_shards: int = SHARDS, block_rows: int = BLOCK_ROWS, whole: bool = False) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id, size, text_crc32, key, shard and slot, row by row; with `whole` also `row`.

    Slots count the records of a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    run = new_run_dir(spark, "shards")
    out = ["doc_id", "size", "text_crc32", "key", *(["row"] if whole else [])]
    rows = told_apart(store(records(docs, whole), f"{run}/records"))
    layout = plan(rows, n_shards, block_rows)
    if layout is None:
        return rows.select(*out, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    shared = spark.sparkContext.broadcast(layout)

    @F.pandas_udf("unit long, shard int, block long")
    def place(key: pd.Series, own: pd.Series) -> pd.DataFrame:
        unit, to, block = shared.value.place(key.to_numpy(), own.to_numpy())
        return pd.DataFrame({"unit": unit, "shard": to, "block": block})

    placed = store(rows.withColumn("p", place("key", "own")).select("*", "p.*").drop("p"), f"{run}/placed")
    before = Window.partitionBy("shard").orderBy("unit", "block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        placed.groupBy("shard", "unit", "block")
        .agg(F.count("*").alias("n"))
        .select("unit", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("unit", "block").orderBy("key", "doc_id", "size", "number")
    return (
        placed.withColumn("k", F.row_number().over(inside) - 1)
        .join(firsts, ["unit", "block"])
        .select(*out, "shard", (F.col("first") + F.col("k")).cast("long").alias("slot"))
    )


def _free(name: str, taken: list[str]) -> str:
    """`name`, with as many underscores behind it as keep it apart from the names in use."""
    while name.lower() in [c.lower() for c in taken]:
        name += "_"
    return name


def write_shards(docs: DataFrame, folder: str, n_shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write the rows of `docs`, all columns, as `folder/shard=N/`, and read the folder.

    Where the input has columns `shard` or `slot` of its own, these stay and the
    new ones are called `shard_` and `slot_`.
    """
    to, at = (_free(name, docs.columns) for name in ("shard", "slot"))
    dealt = shard(docs, n_shards, block_rows, whole=True)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    rows = dealt.select(F.floor(F.col("slot") / block_rows).alias("cut"), F.struct(*own, F.col("shard").alias(to), F.col("slot").alias(at)).alias("r"))
    spread = rows.repartition(F.col(f"r.`{to}`"), "cut").sortWithinPartitions(F.col(f"r.`{to}`"), F.col(f"r.`{at}`"))
    spread.select("r.*").write.partitionBy(to).parquet(folder)
    return docs.sparkSession.read.parquet(folder)
