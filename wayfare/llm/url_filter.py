"""URL filters: explicit rules, then a cascade of Bloom filters.

The cascade answers whether a host is listed, exactly, for every host of the
corpus. Level 1 encodes the listed hosts, level 2 those other hosts that level
1 takes for listed, level 3 the listed hosts that level 2 takes for others, and
so on until a level makes no mistake. A host is looked up level by level up to
the first that does not know it. The filters are a few bits per key and go to
every task; pages meet no join.

A cascade is cut into segments by key hash, so that each is at most
`SEGMENT_BYTES`; pages run through one segment after the other.

Null urls and urls without `://` have an empty host and path and match no rule.
Repeated rows are judged one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import new_run_dir, store

SEGMENT_BYTES = 16 << 20
DEEP_RATE = 1 / 8
MAX_LEVELS = 200
PAGE_BITS = 1 << 16

# The rules as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# A host with one of these words between dots and hyphens is listed.
LISTED_WORDS = ("adult", "bets", "casino", "spam")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_by_words(host: Column, words: tuple[str, ...] = LISTED_WORDS) -> Column:
    return host.rlike(rf"(^|[.-])({'|'.join(words)})([.-]|$)")


def winning_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none does."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        out = F.when(fits, value).otherwise(out)
    return out


# -- the cascade -----------------------------------------------------------------


@dataclass
class Level:
    bits: np.ndarray  # bytes, bit i at byte i // 8
    size: int
    hashes: int
    number: int

    @classmethod
    def shape(cls, n: int, rate: float, number: int) -> Level:
        size = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
        return cls(np.zeros(0, np.uint8), size, max(1, round(math.log2(1 / rate))), number)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A row of bit numbers per key, from its two hashes and the level's number."""
        a = a.astype(np.int64).view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (self.number + 1) % (1 << 64))
        a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(29)
        b = (b.astype(np.int64).view(np.uint64) * np.uint64(2 * self.number + 0x94D049BB133111EB)) | np.uint64(1)
        b ^= b >> np.uint64(32)
        return (a[:, None] + np.arange(self.hashes, dtype=np.uint64)[None, :] * b[:, None]) % np.uint64(self.size)

    def knows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.places(a, b)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(1)


def listed_in(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed: the first level that misses one decides."""
    answer = np.full(len(a), len(levels) % 2 == 1)
    open_ = np.arange(len(a))
    for i, level in enumerate(levels):
        known = level.knows(a[open_], b[open_])
        answer[open_[~known]] = i % 2 == 1
        open_ = open_[known]
    return answer


def _fill(keys: DataFrame, level: Level) -> Level:
    """Set the bits of all keys: tasks fill pages of bits, which Spark brings together."""

    def pages(batches):
        for batch in batches:
            at = np.unique(level.places(batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            page = (at // np.uint64(PAGE_BITS)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(page, prepend=-1))
            numbers, blobs = [], []
            for x, y in zip(cuts, [*cuts[1:], len(at)], strict=True):
                bits = np.zeros(PAGE_BITS, np.uint8)
                bits[(at[x:y] % np.uint64(PAGE_BITS)).astype(np.int64)] = 1
                numbers.append(int(page[x]))
                blobs.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], ["page", "bits"])

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(PAGE_BITS // 8, np.uint8)
        for batch in batches:
            for blob in batch.column("bits"):
                out |= np.frombuffer(blob.as_py(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([out.tobytes()], pa.binary())], ["page", "bits"])

    schema = "page bigint, bits binary"
    filled = keys.select("a", "b").mapInArrow(pages, schema).groupBy("page").applyInArrow(merged, schema).toArrow()
    bits = np.zeros(-(-level.size // PAGE_BITS) * PAGE_BITS // 8, np.uint8)
    width = PAGE_BITS // 8
    for page, blob in zip(filled["page"].to_pylist(), filled["bits"].to_pylist(), strict=True):
        bits[page * width : (page + 1) * width] = np.frombuffer(blob, np.uint8)
    return Level(bits[: -(-level.size // 8)], level.size, level.hashes, level.number)


def _mistaken(keys: DataFrame, level: Level) -> DataFrame:
    """The keys that a level knows."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        for batch in batches:
            known = shared.value.knows(batch.column("a").to_numpy(), batch.column("b").to_numpy())
            yield batch.filter(pa.array(known))

    return keys.mapInArrow(run, keys.schema)


def fit_cascade(universe: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> list[list[Level]]:
    """`universe(a, b, listed)`, distinct keys by two hashes -> levels of every segment."""
    spark = universe.sparkSession
    run = new_run_dir(spark, "cascade")
    universe = store(universe, f"{run}/universe")
    n_listed, n_others = universe.agg(
        F.count(F.when(F.col("listed"), 1)), F.count(F.when(~F.col("listed"), 1))
    ).first()
    first_rate = min(0.5, max(1e-4, n_listed / max(1, n_others) / 2))
    # Level 1 and about half as much again for the levels behind it.
    expected = 1.5 * n_listed * math.log(1 / first_rate) / math.log(2) ** 2 / 8 + n_others * first_rate
    segments = max(1, math.ceil(expected / segment_bytes))
    out = []
    for s in range(segments):
        own = universe.where(F.pmod(F.col("b"), F.lit(segments)) == s)
        into, against = own.where("listed").select("a", "b"), own.where(~F.col("listed")).select("a", "b")
        levels: list[Level] = []
        n = into.count()
        while n:
            if len(levels) == MAX_LEVELS:
                raise RuntimeError("two keys with equal hashes are listed and not listed")
            rate = DEEP_RATE if levels else first_rate
            level = _fill(into, Level.shape(n, rate, len(levels)))
            levels.append(level)
            mistaken = store(_mistaken(against, level), f"{run}/{s}-{len(levels)}")
            into, against, n = mistaken, into, mistaken.count()
        out.append(levels)
    return out


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


def mark_listed(df: DataFrame, key: Column, segments: list[list[Level]], name: str = "listed") -> DataFrame:
    """`df` with a column that says whether `key` is listed."""
    for s, levels in enumerate(segments):
        shared = df.sparkSession.sparkContext.broadcast(levels)
        prior = F.col(name) if s else F.lit(False)
        base = [c for c in df.columns if c != name]
        work = df.select(*[F.col(f"`{c}`") for c in base], prior.alias(name), *[h.alias(f"__{n}") for h, n in zip(key_hashes(key), "ab", strict=True)])
        schema = T.StructType([*work.schema.fields[: len(base)], T.StructField(name, T.BooleanType())])

        def run(batches, s=s, shared=shared, n=len(base)):
            for batch in batches:
                a, b = (batch.column(c).to_numpy() for c in ("__a", "__b"))
                found = listed_in(shared.value, a, b) if shared.value else np.zeros(len(a), bool)
                mine = b % len(segments) == s
                before = batch.column(n).to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(before | (mine & found))], schema.names)

        df = work.mapInArrow(run, schema)
    return df


def judge(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    words: tuple[str, ...] = LISTED_WORDS,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """`pages(page_id, url)` -> page_id, host, path, rule, listed, verdict, row by row."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    universe = (
        parsed.select("host").distinct().select(*key_hashes(F.col("host")), listed_by_words(F.col("host"), words).alias("listed"))
    )
    marked = mark_listed(parsed, F.col("host"), fit_cascade(universe, segment_bytes))
    won = winning_rule(F.col("host"), F.col("path"), rules)
    listed = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.withColumn("won", won).select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), "listed", F.coalesce("won.verdict", listed).alias("verdict")
    )
