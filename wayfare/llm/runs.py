"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of words with smallest period q that is at least
`MIN_LENGTH` words and `MIN_EXPONENT` periods long and that no neighbouring word
extends. Texts are taken some at a time; words are numbered, and a word of one
text is never equal to one of another, so a single suffix array serves all.

Prefix doubling gives the suffix array, its inverse and the ranks of all blocks
of 1, 2, 4, ... words; descending these ranks gives the longest common
extension of any two places, to the right (the LCP values) and to the left.

Branching tandem test: an LCP interval of depth d holds all suffixes that share
their first d words, its children those that share more. If suffixes i and i + d
lie in one interval of depth d but in different children, a square of period d
starts at i that the next word ends. It is enough to look up i + d and i - d in
the inverse array for the suffixes of all children but the largest, which makes
n log n look-ups. The intervals come from one pass over the LCP values with a
stack; no tree is built. Rotating a square to the left as far as the words
repeat gives a maximal stretch, and stretches found under several multiples of
a period are merged under the least.

A run repeats at least `MIN_LENGTH - MIN_LENGTH // MIN_EXPONENT` consecutive
words at another place of the text, so texts where no so many words occur twice
have no run and are not sorted any further.

Null and empty texts have no words and no runs. Rows are judged one by one, so
repeated rows and rows without an id need no rule. Work and memory follow the
longest single text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wayfare.llm.common import one_of_each, plain_words, rolling

MIN_LENGTH = 24
MIN_EXPONENT = 3
CHUNK_BYTES = 1 << 20

_FACTOR = 0x9E3779B97F4A7C15


class Suffixes:
    """Suffix array of several texts, and the ranks of blocks of 1, 2, 4, ... words.

    `words`: a number per word; `text`: its text, ascending. Equal ranks of a
    level mean equal blocks that lie whole in one text.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n = len(words)
        end = np.searchsorted(text, text, side="right")
        order = np.lexsort((words, text))
        new = np.ones(n, bool)
        new[1:] = (np.diff(words[order]) != 0) | (np.diff(text[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        tied = order[~(new & np.append(new[1:], True))]
        self.n, self.levels, step = n, [rank], 1
        while len(tied):
            ahead = tied + step
            behind = np.where(ahead < end[tied], rank[np.minimum(ahead, n - 1)], -1)
            order = np.lexsort((behind, rank[tied]))
            at, old, behind = tied[order], rank[tied[order]], behind[order]
            group = np.diff(old, prepend=-1) != 0
            new = group | (np.diff(behind, prepend=-2) != 0)
            place = np.arange(len(at))
            rank = rank.copy()
            rank[at] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
            self.levels.append(rank)
            tied, step = at[~(new & np.append(new[1:], True))], 2 * step
        self.inverse = rank
        self.array = np.empty(n, np.int64)
        self.array[rank] = np.arange(n)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places a and b on are equal."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + out, b + out
            inside = np.maximum(x, y) < self.n
            equal = self.levels[k][np.where(inside, x, 0)] == self.levels[k][np.where(inside, y, 0)]
            out += (inside & equal).astype(np.int64) << k
        return out

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words just before places a and b are equal."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - out - (1 << k), b - out - (1 << k)
            inside = np.minimum(x, y) >= 0
            equal = self.levels[k][np.where(inside, x, 0)] == self.levels[k][np.where(inside, y, 0)]
            out += (inside & equal).astype(np.int64) << k
        return out

    def lcp(self) -> np.ndarray:
        """Common words of each suffix of the array with the one before; 0 for the first, and 0 behind the last."""
        out = np.zeros(self.n + 1, np.int64)
        out[1:-1] = self.ahead(self.array[:-1], self.array[1:])
        return out


def small_children(lcp: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Children of the LCP intervals but the largest of each: (from, to, interval from, to, depth)."""
    open_: list[tuple[int, list[int]]] = []
    for j in range(1, len(lcp)):
        depth, left = lcp[j], j - 1
        while open_ and open_[-1][0] > depth:
            deep, starts = open_.pop()
            left = starts[0]
            sizes = [b - a for a, b in zip(starts, [*starts[1:], j], strict=True)]
            largest = sizes.index(max(sizes))
            for i, (a, size) in enumerate(zip(starts, sizes, strict=True)):
                if i != largest:
                    yield a, a + size, left, j, deep
        if depth:
            if not open_ or open_[-1][0] < depth:
                open_.append((depth, [left]))
            open_[-1][1].append(j)


def squares(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every square that the word behind it ends."""
    children = np.array(list(small_children(suffixes.lcp().tolist())), np.int64).reshape(-1, 5)
    size = children[:, 1] - children[:, 0]
    first, last, low, high, period = np.repeat(children, size, axis=0).T
    place = np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
    here = suffixes.array[first + place]
    found = []
    for start, other in ((here, here + period), (here - period, here - period)):
        inside = (other >= 0) & (other < suffixes.n)
        rank = suffixes.inverse[np.where(inside, other, 0)]
        hit = inside & (rank >= low) & (rank < high) & ((rank < first) | (rank >= last))
        found.append(np.stack([start[hit], period[hit]]))
    at, period = np.unique(np.concatenate(found, axis=1), axis=1)
    return at, period


def find_runs(
    words: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> np.ndarray:
    """Runs as rows (start, length, period), by start, then period; `text` is ascending."""
    if not len(words):
        return np.empty((0, 3), np.int64)
    suffixes = Suffixes(words, text)
    at, period = squares(suffixes)
    start = at - suffixes.before(at, at + period)
    length = at + 2 * period - start
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    keep = least & (length >= min_length) & (length >= min_exponent * period)
    runs = np.stack([start[keep], length[keep], period[keep]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def may_run(words: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Texts in which `size` consecutive words occur twice."""
    value = rolling(words.astype(np.uint64) + np.uint64(1), size, _FACTOR)
    if not len(value):
        return np.empty(0, np.int64)
    at = np.flatnonzero(text[: len(value)] == text[size - 1 :])
    order = np.lexsort((value[at], text[at]))
    a, b = at[order][:-1], at[order][1:]
    return np.unique(text[a[(value[a] == value[b]) & (text[a] == text[b])]])


def _chunks(texts_: Iterator[tuple[int | None, str | None]]) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    some, size = [], 0
    for doc_id, text in texts_:
        some.append((doc_id, plain_words(text)))
        size += len(text or "")
        if size >= CHUNK_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def runs_of_texts(
    texts_: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, places counted from its first word."""
    known: dict[bytes, int] = {}
    number = [known.setdefault(w, len(known)) for words in texts_ for w in words]
    sizes = np.array([len(words) for words in texts_], np.int64)
    words, text = np.array(number, np.int64), np.repeat(np.arange(len(texts_)), sizes)
    some = np.isin(text, may_run(words, text, max(1, min_length - min_length // min_exponent)))
    first = np.cumsum(np.bincount(text[some], minlength=len(texts_))) - np.bincount(text[some], minlength=len(texts_))
    own = text[some]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts_]
    for start, length, period in find_runs(words[some], own, min_length, min_exponent).tolist():
        t = int(own[start])
        out[t].append((start - int(first[t]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds behind its first period."""
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return [w for w, g in zip(words, gone, strict=True) if not g] if runs else words


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length in periods; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Plants a periodic tail in a tenth of the texts, chosen by the id's checksum; none without an id."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN_ARROW = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def periodic_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    with_text: bool = True,
) -> DataFrame:
    """`docs(doc_id, text)` -> a row per row: doc_id, runs, strongest, collapsed_sha256 and, if wanted, collapsed_text.

    `change` may replace the words of a text before they are judged.
    """
    docs = one_of_each(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((i.as_py(), t.as_py()) for i, t in zip(batch.column("doc_id"), batch.column("text"), strict=True))
            for some in _chunks(rows):
                texts_ = [change(i, words) if change else words for i, words in some]
                runs = runs_of_texts(texts_, min_length, min_exponent)
                kept = [b" ".join(collapsed(w, r)) for w, r in zip(texts_, runs, strict=True)]
                named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
                best = [strongest(rs) for rs in runs]
                out = {
                    "doc_id": pa.array([i for i, _ in some], batch.schema.field("doc_id").type),
                    "runs": pa.array(named, pa.list_(_RUN_ARROW)),
                    "strongest": pa.array(
                        [b and dict(zip(("start", "length", "period"), b, strict=True)) for b in best], _RUN_ARROW
                    ),
                    "collapsed_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                }
                if with_text:
                    out["collapsed_text"] = pa.array([k.decode() for k in kept])
                yield pa.RecordBatch.from_pydict(out)

    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL(f"runs array<{_RUN}>, strongest {_RUN}, collapsed_sha256 string").fields]
    )
    if with_text:
        schema = schema.add("collapsed_text", "string")
    return docs.mapInArrow(run, schema)
