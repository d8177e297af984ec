"""Substring deduplication with difference-cover anchors.

A word is removed if a window of `WINDOW` words that covers it also starts in a
document with a smaller id. To find such windows without exchanging all of
them, seven-word anchors are hashed only at places whose number modulo 7 is 0,
1 or 3. Every difference modulo 7 is a difference of two of these, so two equal
windows at any two places contain equal anchors at the same offset, both at
cover places. Anchors that two documents share mark the candidates; the match
is then extended to the windows around them, whose fingerprints (95 bits) are
compared across the corpus.

Documents are dealt into cells by a hash, and a cell sends each anchor and each
window once, with the smallest id that has it, so a passage of a third of all
documents is at most one row per cell. Whole copies of a text are found by its
digest first and take no further part.

Null and empty texts have no words and lose none. A missing id counts as larger
than any other and as equal to none, so rows without an id lose what others
have and never take from each other. Rows with the same id never take from each
other either. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.skew import splittable
from wayfare.llm.common import Words, chunks, one_of_each

WINDOW = 13
# A difference cover modulo its period; anchors are WINDOW - PERIOD + 1 words.
PERIOD = 7
COVER = (0, 1, 3)
CELL_BYTES = 16 << 20

_NO_ID = np.iinfo(np.int64).max
_ANCHOR, _FIRST, _SECOND = 0xD1342543DE82EF95, 0x9E3779B97F4A7C15, 0xDA942042E4DD58B5
_KIND_COPY, _KIND_ANCHOR, _KIND_OWNER = 0, 1, 2
_SIDE = "cell bigint, kind int, x bigint, y bigint, z bigint"
_SIDE_ARROW = pa.schema([("cell", pa.int64()), ("kind", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("z", pa.int64())])


class Cell:
    """One cell's documents and what the rest of the corpus says about them."""

    def __init__(self, docs: pa.Table, side: pa.Table):
        self.texts = docs.column("text")
        self.ids = docs.column("id").to_numpy()
        kind = side.column("kind").to_numpy()
        self._side = {k: [side.column(c).to_numpy()[kind == k] for c in "xyz"] for k in np.unique(kind).tolist()}
        copies = self._side.get(_KIND_COPY, [np.empty(0, np.int64)] * 3)
        self.is_copy = np.isin(self.ids, copies[0]) if len(copies[0]) else np.zeros(len(self.ids), bool)
        if self.is_copy.any():
            # An id may stand for several rows; only those with the copied text count.
            digests = {(i, d) for i, d in zip(copies[0].tolist(), copies[1].tolist(), strict=True)}
            keys = docs.column("text_key").to_numpy()
            self.is_copy = np.array([c and (i, k) in digests for c, i, k in zip(self.is_copy, self.ids.tolist(), keys.tolist(), strict=True)])

    def side(self, kind: int) -> list[np.ndarray]:
        return self._side.get(kind, [np.empty(0, np.int64)] * 3)

    def words(self) -> Iterator[tuple[int, Words]]:
        return chunks(self.texts)


def cover_places(words: Words, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at which an anchor starts, and the anchors (48 bits are enough to find candidates)."""
    k = window - period + 1
    at = np.flatnonzero(words.windows(k) & np.isin(words.place % period, COVER))
    return at, (words.rolling(k, _ANCHOR)[at] >> np.uint64(16)).astype(np.int64)


def fingerprints(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 31 bits for the window at each word."""
    return words.rolling(window, _FIRST).view(np.int64), (words.rolling(window, _SECOND) >> np.uint64(33)).astype(np.int64)


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n words lie in a run of `length` words from one of the starts."""
    edges = np.zeros(n + length, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:n]) > 0


def candidates(words: Words, anchors: np.ndarray, window: int, period: int) -> np.ndarray:
    """Starts of the windows that contain a shared anchor."""
    at, value = cover_places(words, window, period)
    hit = at[member(value, anchors)]
    near = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(near, np.maximum(hit - (period - 1), 0), 1)
    np.add.at(near, hit + 1, -1)
    return np.flatnonzero((np.cumsum(near[:-1]) > 0) & words.windows(window))


def _rows(cell: int, kind: int, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> pa.Table:
    n = len(x)
    return pa.Table.from_arrays(
        [pa.array(np.full(n, cell)), pa.array(np.full(n, kind, np.int32)), pa.array(x), pa.array(y), pa.array(z)],
        schema=_SIDE_ARROW,
    )


def _send_anchors(window: int, period: int):
    """Per cell: every anchor once, with a mark where two of its documents have it."""

    def run(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        cell = Cell(docs, side)
        values, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for base, words in cell.words():
            at, value = cover_places(words, window, period)
            doc = base + words.doc[at]
            # Only documents that hold a whole window, and no copies.
            length = np.bincount(words.doc, minlength=len(words.first))
            use = (length[words.doc[at]] >= window) & ~cell.is_copy[doc]
            values.append(value[use])
            owners.append(doc[use])
        value, doc = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value, kind="stable")
        value, doc = value[order], doc[order]
        new = np.diff(value, prepend=-1) != 0
        firsts = np.flatnonzero(new)
        several = np.zeros(len(firsts), np.int64)
        if len(firsts):
            run_of = np.cumsum(new) - 1
            several[run_of[(~new) & (np.diff(doc, prepend=-1) != 0)]] = 1
        return _rows(int(key[0].as_py()), _KIND_ANCHOR, value[firsts], several, np.zeros(len(firsts), np.int64))

    return run


def _send_windows(window: int, period: int):
    """Per cell: every candidate window once, with its smallest id and a mark for more ids."""

    def run(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        cell = Cell(docs, side)
        anchors = np.unique(cell.side(_KIND_ANCHOR)[0])
        parts = []
        for base, words in cell.words():
            at = candidates(words, anchors, window, period)
            at = at[~cell.is_copy[base + words.doc[at]]]
            a, b = fingerprints(words, window)
            parts.append((a[at], b[at], cell.ids[base + words.doc[at]]))
        a, b, ids = (np.concatenate(c) if parts else np.empty(0, np.int64) for c in (zip(*parts, strict=True) if parts else ((), (), ())))
        order = np.lexsort((ids, b, a))
        a, b, ids = a[order], b[order], ids[order]
        new = np.ones(len(a), bool)
        new[1:] = (np.diff(a) != 0) | (np.diff(b) != 0)
        firsts = np.flatnonzero(new)
        last = np.append(firsts[1:], len(a)) - 1
        more = (ids[last] != ids[firsts]).astype(np.int64) if len(a) else firsts
        return _rows(int(key[0].as_py()), _KIND_OWNER, a[firsts], b[firsts] << 1 | more, ids[firsts])

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    columns = [[] for _ in range(4)]
    for batch in batches:
        for out, name in zip(columns, ("cell", "x", "y", "z"), strict=True):
            out.append(batch.column(name).to_numpy())
    return [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]


def _slices(table: pa.Table) -> Iterator[pa.RecordBatch]:
    return iter(table.to_batches(max_chunksize=1 << 16))


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition holds whole anchors: those of two cells, or of two documents of one."""
    cell, x, several, _ = _gathered(batches)
    order = np.argsort(x, kind="stable")
    cell, x, several = cell[order], x[order], several[order]
    new = np.diff(x, prepend=-1) != 0
    run = np.cumsum(new) - 1
    shared = (np.bincount(run) > 1) | (np.bincount(run, several) > 0) if len(x) else np.zeros(0, bool)
    keep = shared[run] if len(x) else np.zeros(0, bool)
    cell, x = cell[keep], x[keep]
    zero = np.zeros(len(x), np.int64)
    yield from _slices(pa.Table.from_arrays([pa.array(cell), pa.array(zero.astype(np.int32) + _KIND_ANCHOR), pa.array(x), pa.array(zero), pa.array(zero)], schema=_SIDE_ARROW))


def _owned_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition holds whole windows: tell each cell with a larger id the smallest one."""
    cell, x, y, z = _gathered(batches)
    b, more = y >> 1, y & 1
    order = np.lexsort((z, b, x))
    cell, x, b, more, z = (c[order] for c in (cell, x, b, more, z))
    new = np.ones(len(x), bool)
    new[1:] = (np.diff(x) != 0) | (np.diff(b) != 0)
    run = np.cumsum(new) - 1
    least = z[np.flatnonzero(new)][run] if len(x) else z
    keep = (z > least) | (more > 0)
    n = int(keep.sum())
    yield from _slices(pa.Table.from_arrays([pa.array(cell[keep]), pa.array(np.full(n, _KIND_OWNER, np.int32)), pa.array(x[keep]), pa.array(b[keep]), pa.array(least[keep])], schema=_SIDE_ARROW))


def _remove(window: int, with_text: bool):
    """Per cell: what is left of every document."""

    def run(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        cell = Cell(docs, side)
        x, b_of, owner = cell.side(_KIND_OWNER)
        order = np.lexsort((b_of, x))
        x, b_of, owner = x[order], b_of[order], owner[order]
        n_words, n_removed, digests, kept = [], [], [], []
        for base, words in cell.words():
            a, b = fingerprints(words, window)
            lost = np.zeros(len(a), bool)
            if len(x):
                start = np.searchsorted(x, a)
                valid = words.windows(window)
                # Windows that agree in 64 bits stand next to each other.
                for step in range(int(np.bincount(np.cumsum(np.diff(x, prepend=x[0] - 1) != 0)).max())):
                    at = np.minimum(start + step, len(x) - 1)
                    lost |= valid & (x[at] == a) & (b_of[at] == b) & (owner[at] < cell.ids[base + words.doc])
            gone = covered(np.flatnonzero(lost), window, len(a))
            ends = np.append(words.first[1:], len(a)) if len(words.first) else words.first
            buffer = words.data.tobytes()
            for i in range(len(words.first) - 1):
                s, e = int(words.first[i]), int(ends[i])
                out = np.ones(e - s, bool) if cell.is_copy[base + i] and e - s >= window else gone[s:e]
                stay = np.flatnonzero(~out) + s
                text = b" ".join([buffer[u:v] for u, v in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)])
                n_words.append(e - s)
                n_removed.append(e - s - len(stay))
                digests.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept.append(text.decode())
        out = {
            "doc_id": docs.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        return pa.table(out | {"kept_text": pa.array(kept, pa.string())} if with_text else out)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, cell_bytes: int = CELL_BYTES, with_text: bool = True) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id, n_words, n_removed, kept_sha256 and, if wanted, kept_text."""
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    spark = docs.sparkSession
    docs = one_of_each(docs, "doc_id", "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_cells = max(partitions, -(-total // cell_bytes))
    text_key = F.xxhash64("text")
    placed = docs.select(
        F.pmod(F.xxhash64("doc_id", text_key), F.lit(n_cells)).alias("cell"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        "doc_id",
        text_key.alias("text_key"),
        "text",
    )
    digests = placed.select("cell", "id", "text_key", F.md5(F.col("text").cast("binary")).alias("digest"))
    least = digests.groupBy(F.col("digest").alias("d")).agg(F.min("id").alias("least"))
    copies = (
        digests.join(least, splittable(F.col("digest"), F.col("d")))
        .where(F.col("id") > F.col("least"))
        .select(F.col("cell").alias("cell"), F.lit(_KIND_COPY).alias("kind"), F.col("id").alias("x"), F.col("text_key").alias("y"), F.lit(0).cast("long").alias("z"))
    )

    def told(side: DataFrame, run, schema) -> DataFrame:
        return placed.groupBy("cell").cogroup(side.groupBy("cell")).applyInArrow(run, schema)

    anchors = told(copies, _send_anchors(window, PERIOD), _SIDE).repartition(partitions, "x").mapInArrow(_shared_anchors, _SIDE)
    windows = (
        told(copies.unionByName(anchors), _send_windows(window, PERIOD), _SIDE)
        .repartition(partitions, "x")
        .mapInArrow(_owned_windows, _SIDE)
    )
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_words bigint, n_removed bigint, kept_sha256 string").fields])
    if with_text:
        schema = schema.add("kept_text", "string")
    return told(copies.unionByName(windows), _remove(window, with_text), schema)
