"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to folded words and cut into windows of ten words.
All windows form one automaton; every text is normalised the same way and runs
through it once. Matches are kept as word positions and mapped back to offsets
in the original text. The windows lie in the shared folder; tasks read them
there, and the texts are read once however many windows there are.

Nulls, empty texts and texts without words have no hits. An item without words
has no window; one without an id marks words but is not listed. Repeated rows
are judged one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import folded_words, one_of_each, texts
from wayfare.llm.token_files import _file_system
from wayfare.session import new_run_dir, store

WINDOW = 10
# An automaton holds windows of this many characters at most. A larger test
# set has several, which a task builds one after the other for the texts it holds.
BLOCK_CHARS = 4_000_000
# A task holds texts of about this many bytes at a time.
CHUNK_BYTES = 64 << 20

_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FINDINGS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
                )
            ),
        ),
    ]
)
_ARROW_FINDINGS = [
    ("n_words", pa.int64()),
    ("n_hit", pa.int64()),
    ("item_ids", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
]


def windows_of(words: list[bytes], window: int = WINDOW) -> set[bytes]:
    """All runs of `window` words, or the whole of a shorter text."""
    if not words:
        return set()
    last = max(1, len(words) - window + 1)
    return {b" ".join(words[i : i + window]) for i in range(last)}


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`items(item_id, text)` -> distinct `(item, pattern)`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, patterns = [], []
            for item, text in zip(batch.column("item").to_pylist(), texts(batch, "text"), strict=True):
                for pattern in sorted(windows_of(folded_words(text), window)):
                    ids.append(item)
                    patterns.append(pattern.decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(patterns, pa.string())], ["item", "pattern"]
            )

    named = items.select(F.col("item_id").cast("string").alias("item"), "text")
    return named.mapInArrow(cut, "item string, pattern string").distinct()


class Scanner:
    """One automaton over padded windows: a match of ` a b ` is a match of whole words."""

    def __init__(self, pairs: list[tuple[str | None, str]]):
        owners: dict[str, set[str | None]] = {}
        for item, pattern in pairs:
            owners.setdefault(pattern, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, items in owners.items():
            self.automaton.add_word(f" {pattern} ", (pattern.count(" ") + 1, tuple(items)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def matches(self, words: list[bytes]) -> list[tuple[int, int, str | None]]:
        """(first word, last word, item) of every occurrence."""
        if self.empty or not words:
            return []
        line = f" {b' '.join(words).decode()} "
        found = list(self.automaton.iter(line))
        if not found:
            return []
        blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 32)
        lasts = np.searchsorted(blanks, [end for end, _ in found]) - 1
        return [
            (int(last) - n + 1, int(last), item)
            for last, (_, (n, items)) in zip(lasts, found, strict=True)
            for item in items
        ]


def findings(text: str | None, n_words: int, matches: list) -> tuple[int, list[str], list[dict]]:
    """Words hit, items with a match, and the hit stretches in the original text."""
    if not matches:
        return 0, [], []
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, [m[0] for m in matches], 1)
    np.add.at(edges, [m[1] + 1 for m in matches], -1)
    hit = np.cumsum(edges[:-1]) > 0
    places = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    steps = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    spans = [
        {"start": places[a][0], "end": places[b - 1][1]}
        for a, b in zip(steps[::2], steps[1::2], strict=True)
    ]
    return int(hit.sum()), sorted({m[2] for m in matches if m[2] is not None}), spans


def _blocks(items: DataFrame, window: int, block_chars: int) -> tuple[str, int]:
    """The windows in the shared folder, one folder per block of a bounded size: (folder, blocks)."""
    run = new_run_dir(items.sparkSession, "windows")
    pairs = store(item_windows(items, window), f"{run}/all")
    chars = pairs.agg(F.sum(F.length("pattern") + F.length(F.coalesce("item", F.lit(""))))).first()[0]
    n = -(-(chars or 0) // block_chars) or 1
    block = F.pmod(F.xxhash64("pattern", "item"), F.lit(n)).alias("block")
    store(pairs.select("item", "pattern", block).repartition("block"), f"{run}/blocks", ["block"])
    return f"{run}/blocks", n


_SCANNERS: dict[tuple[str, int], Scanner] = {}


def _scanner(folder: str, block: int) -> Scanner:
    """The automaton of a block; a Python worker holds one at a time."""
    if (folder, block) not in _SCANNERS:
        _SCANNERS.clear()
        store_of, path = _file_system(folder)
        listed = store_of.get_file_info(fs.FileSelector(f"{path}/block={block}", allow_not_found=True))
        pairs = []
        for info in listed:
            if info.base_name.endswith(".parquet") and not info.base_name.startswith((".", "_")):
                with store_of.open_input_file(info.path) as file:
                    part = pq.ParquetFile(file).read(["item", "pattern"])
                pairs += zip(part["item"].to_pylist(), part["pattern"].to_pylist(), strict=True)
        _SCANNERS[folder, block] = Scanner(pairs)
    return _SCANNERS[folder, block]


def _held(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches until their texts reach a size."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= chunk_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scanned(
    docs: DataFrame, items: DataFrame, window: int, block_chars: int, chunk_bytes: int, finish, schema: T.StructType
) -> DataFrame:
    """Run `docs` through all blocks in one pass; `finish` gets batch, words and matches."""
    folder, blocks = _blocks(items, window, block_chars)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = list(range(blocks))
        # A single automaton is never changed, so no batch has to wait for others.
        for held in _held(batches, chunk_bytes if blocks > 1 else 0):
            counts = [[0] * len(batch) for batch in held]
            found = [[[] for _ in range(len(batch))] for batch in held]
            for block in order:
                scanner = _scanner(folder, block)
                for batch, count, matches in zip(held, counts, found, strict=True):
                    for i, text in enumerate(texts(batch, "text")):
                        words = folded_words(text)
                        count[i] = len(words)
                        matches[i] += scanner.matches(words)
            # The last block's automaton is there already.
            order.reverse()
            for batch, count, matches in zip(held, counts, found, strict=True):
                yield finish(batch, count, matches)

    return docs.mapInArrow(scan, schema)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """`docs(doc_id, text)`, `items(item_id, text)` -> one row per document.

    doc_id, n_words, n_hit, item_ids (sorted) and spans: start and end, in code
    points of the original text, of every stretch of hit words.
    """
    docs = one_of_each(docs, "doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], *FINDINGS.fields])

    def finish(batch, counts, found):
        rows = [
            findings(text, n, matches)
            for text, n, matches in zip(texts(batch, "text"), counts, found, strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                *[pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_ARROW_FINDINGS[1:])],
            ],
            ["doc_id", *[name for name, _ in _ARROW_FINDINGS]],
        )

    return _scanned(docs, one_of_each(items, "item_id", "text"), window, block_chars, chunk_bytes, finish, schema)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The rows of `docs`, all columns, whose text contains no window of an item."""

    def finish(batch, counts, found):
        return batch.filter(pa.array([not matches for matches in found], pa.bool_()))

    return _scanned(docs, one_of_each(items, "item_id", "text"), window, block_chars, chunk_bytes, finish, docs.schema)
