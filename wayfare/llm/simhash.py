"""SimHash near-duplicates with bit-sliced comparison.

A document's 64 bits are the majority of the XXH64 hashes of its three-word
shingles. Fingerprints that differ in at most `radius` bits agree on at least
two of `radius` + 2 equal stretches, so equal pairs of stretches are the
buckets to compare in. A bucket is compared vertically: bit b of 64
fingerprints is one machine word, a carry-save counter adds up the differing
planes for all pairs at once, and a block is abandoned as soon as every pair
in it is beyond the radius.

Buckets above `BUCKET` distinct fingerprints are linked without comparing:
each fingerprint is tied to every value one bit away, so two within two bits
meet at a common value. That is exact, too, and costs 33 links a fingerprint.

Null and empty texts have fingerprint zero and link like any other. Rows with
the same id are separate rows; a component whose rows all lack an id has no
id. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.skew import splittable
from wayfare.llm.common import one_of_each, texts
from wayfare.operators.components import connected_components
from wayfare.session import new_run_dir, store

SHINGLE = 3
SEED = 42
RADIUS = 2
BUCKET = 2048
BLOCK = 1024


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= k:
        shingles = [line]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-k].tolist()]
        shingles = [line[a : b - 1] for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """`docs(doc_id, text)` -> `(doc_id, text_key, fp)`; the fingerprint as a signed long."""
    docs = one_of_each(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("fp", T.LongType())]
    )

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, k) for t in texts(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))],
                ["doc_id", "text_key", "fp"],
            )

    return docs.mapInArrow(run, schema)


def stretches(radius: int) -> list[int]:
    """Masks of all pairs out of `radius` + 2 stretches of the 64 bits."""
    cuts = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [a | b for a, b in combinations(masks, 2)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_pairs(fps: np.ndarray, buckets: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """(i, j), i < j, of one bucket and within the radius. Equal buckets stand together.

    Rows of a block are queries, its columns are 64 fingerprints a word.
    """
    n = len(fps)
    lanes = -(-n // 64) * 64

    def packed(bits: np.ndarray) -> np.ndarray:
        wide = np.zeros(bits.shape[:-1] + (lanes,), np.uint8)
        wide[..., :n] = bits
        return np.packbits(wide, axis=-1, bitorder="little").view("<u8")

    planes = packed(((fps[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8))
    out = []
    for start in range(0, n, BLOCK):
        query = fps[start : start + BLOCK]
        rows = np.arange(start, start + len(query))
        alive = packed((buckets[rows, None] == buckets[None, :]) & (rows[:, None] < np.arange(n)[None, :]))
        ones, twos = np.zeros_like(alive), np.zeros_like(alive)
        for b in range(64):
            own = np.where((query >> np.uint64(b)) & np.uint64(1), ~np.uint64(0), np.uint64(0))
            differs = planes[b][None, :] ^ own[:, None]
            carry = ones & differs
            ones ^= differs
            alive &= ~(twos & carry)
            twos ^= carry
            alive &= ~(ones & twos if radius == 2 else twos if radius == 1 else ones | twos)
            if b % 8 == 7 and not alive.any():
                break
        else:
            bits = np.unpackbits(alive.view(np.uint8), axis=-1, bitorder="little")[:, :n]
            i, j = np.nonzero(bits)
            out.append(np.stack([i + start, j], 1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def spanning(n: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches over the pairs."""
    root = np.arange(n)
    while len(pairs):
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        open_ = a != b
        if not open_.any():
            break
        pairs, a, b = pairs[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, root[root]):
            root = root[root]
    return root


def _compare(batches, radius: int):
    """Sorted (mask, bucket, fp) rows -> links from each fingerprint to its bucket's smallest.

    Whole buckets are gathered into blocks; the last, possibly unfinished
    bucket of a batch waits for the next batch.
    """

    def links(mask, bucket, fp):
        change = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(mask) != 0)) + 1
        number = np.zeros(len(fp), np.int64)
        number[change] = 1
        number = np.cumsum(number)
        several = np.bincount(number)[number] > 1
        number, fp = number[several], fp[several]
        starts = np.flatnonzero(np.diff(number, prepend=-1))
        src, dst = [], []
        a = 0
        while a < len(fp):
            later = starts[(starts > a) & (starts <= a + BLOCK)]
            nexts = starts[starts > a]
            z = len(fp) if len(fp) - a <= BLOCK else int(later[-1]) if len(later) else int(nexts[0]) if len(nexts) else len(fp)
            part = fp[a:z]
            root = spanning(len(part), near_pairs(part.view(np.uint64), number[a:z], radius))
            tied = root != np.arange(len(part))
            src.append(part[tied])
            dst.append(part[root[tied]])
            a = z
        empty = np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(src) if src else empty), pa.array(np.concatenate(dst) if dst else empty)],
            ["src", "dst"],
        )

    held = None
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "bucket", "fp")]
        if held is not None:
            now = [np.concatenate([h, c]) for h, c in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        held = [c[cut:] for c in now]
        if cut:
            yield links(*[c[:cut] for c in now])
    if held is not None and len(held[0]):
        yield links(*held)


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """`distinct(fp)` -> `(src, dst)` whose components are those of the radius."""
    masks = stretches(radius)
    keyed = distinct.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bucket"))
                    for i, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("k.mask", "k.bucket", "fp")
    counted = keyed.groupBy("mask", "bucket").count()
    spark = distinct.sparkSession
    large = store(counted.where(F.col("count") > bucket).select("mask", "bucket"), new_run_dir(spark, "buckets"))
    small = (
        keyed.join(large, ["mask", "bucket"], "left_anti")
        .repartition("mask", "bucket")
        .sortWithinPartitions("mask", "bucket", "fp")
        .mapInArrow(lambda batches: _compare(batches, radius), "src bigint, dst bigint")
    )
    # Within a bucket only the bits outside its mask can differ.
    flips = F.array(*[F.array(*[F.lit(signed(1 << b)) for b in range(64) if not m >> b & 1]) for m in masks])
    tied = (
        keyed.join(large, ["mask", "bucket"], "left_semi")
        .select("fp", F.explode(flips[F.col("mask")]).alias("flip"))
        .select(F.col("fp").alias("src"), F.col("fp").bitwiseXOR(F.col("flip")).alias("dst"))
        if radius
        else small.limit(0)
    )
    return small.unionByName(tied)


def near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """`docs(doc_id, text)` -> `(doc_id, text_key, fp, root, component_id)`, row by row.

    component_id is the smallest doc_id that is reached over links between
    fingerprints, root the smallest fingerprint; `text_key` is a hash of the text.
    """
    if radius not in (0, 1, 2):
        raise ValueError("the radius is 0, 1 or 2")
    spark = docs.sparkSession
    run = new_run_dir(spark, "simhash")
    rows = store(fingerprints(docs, k), f"{run}/rows")
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{run}/distinct")
    links = store(fingerprint_links(distinct, radius, bucket).distinct(), f"{run}/links")
    reached = connected_components(links).select(F.col("id").alias("fp"), "root")
    rooted = store(
        distinct.join(reached, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")),
        f"{run}/rooted",
    )
    heads = rooted.groupBy(F.col("root").alias("head")).agg(F.min("least").alias("component_id"))
    named = rooted.join(heads, splittable(F.col("root"), F.col("head"))).select("fp", "root", "component_id")
    named = store(named, f"{run}/named")
    # One row per fingerprint on the right; a fingerprint of many documents can be split.
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_first(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """The rows of `docs`, all columns: of each component one with the smallest id."""
    spark = docs.sparkSession
    rows = near_duplicates(docs, k, radius, bucket)
    def keyed(df: DataFrame, text_key: Column) -> DataFrame:
        rest = F.xxhash64(text_key, F.col("doc_id").isNull())
        return df.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__rest": rest})

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("r")
    chosen = keyed(rows.groupBy("root").agg(first).select("r.doc_id", "r.text_key"), F.col("text_key"))
    chosen = store(chosen.select("__id", "__rest"), new_run_dir(spark, "kept"))
    kept = keyed(docs, F.xxhash64("text")).join(chosen, ["__id", "__rest"], "left_semi")
    return kept.dropDuplicates(["__id", "__rest"]).select(*[F.col(f"`{c}`") for c in docs.columns])
