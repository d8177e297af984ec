"""What the corpus operators share: word rules and small Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes as they count for folded words: A-Z become a-z, other ASCII outside
# 0-9 and a-z becomes a blank, bytes of non-ASCII characters stay.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

# The same rules as patterns of Spark's regular expressions.
FOLDED_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PLAIN_WORD = r"[^\x20\x09-\x0D]+"


def folded_words(text: str | None) -> list[bytes]:
    """Lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; none for null."""
    return text.encode().translate(FOLD).split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, unchanged; none for null."""
    return text.encode().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.RecordBatch, column: str) -> Iterator[str | None]:
    """A batch's texts one by one, so that only one is a Python object at a time."""
    for value in batch.column(column):
        yield value.as_py()


def rolling(words: np.ndarray, k: int, factor: int) -> np.ndarray:
    """Fingerprints of all k consecutive values: a polynomial in `factor`, modulo 2^64."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(factor)
        out += words[j : j + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def one_of_each(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others of the input cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


class Words:
    """The plain words of a chunk of texts, column by column.

    hash: 64-bit fingerprints; doc: the text's place in the chunk; place: the
    word's place in its text; start and end: its bytes in `data`.
    """

    _BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
    _BASE = 0x2545F4914F6CDD1D
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """`data`: UTF-8 bytes of all texts; `offsets`: where each starts, and the end."""
        self.data = data
        n = len(data)
        word = ~self._BLANK[data]
        before = np.zeros(n + 1, bool)
        before[1:] = word
        # A text's first byte starts a word even where the text before ends in one.
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        here = np.append(word, False)
        self.start = np.flatnonzero(here & (cut | ~before))
        self.end = np.flatnonzero(before & (cut | ~here))
        powers, inverse = self._tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        value = (sums[self.end] - sums[self.start]) * inverse[self.start]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        self.hash = value
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        # Empty texts share an offset with the text behind them; the last one owns it.
        self.first = np.searchsorted(self.doc, np.arange(len(offsets)))
        self.place = np.arange(len(self.doc)) - self.first[self.doc]

    @classmethod
    def _tables(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse modulo 2^64."""
        if len(cls._powers) < n + 1:
            back = pow(cls._BASE, -1, 1 << 64)
            for name, base in (("_powers", cls._BASE), ("_inverse", back)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))
        return cls._powers, cls._inverse

    def windows(self, k: int) -> np.ndarray:
        """Whether k words of one text start at each word."""
        out = np.zeros(len(self.doc), bool)
        if len(out) >= k:
            out[: len(out) - k + 1] = self.doc[: len(out) - k + 1] == self.doc[k - 1 :]
        return out

    def rolling(self, k: int, factor: int) -> np.ndarray:
        """Fingerprints of k words from each word; meaningless where `windows` is false."""
        out = np.zeros(len(self.doc), np.uint64)
        out[: max(0, len(out) - k + 1)] = rolling(self.hash, k, factor)
        return out


def chunks(texts_: pa.ChunkedArray, size: int = 1 << 20) -> Iterator[tuple[int, Words]]:
    """Whole texts of about `size` bytes at a time: (place of the first, words). Null is empty."""
    at = 0
    for piece in texts_.chunks:
        piece = piece.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(piece.buffers()[1], np.int64, len(piece) + 1, piece.offset * 8)
        raw = piece.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        a = 0
        while a < len(piece):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
            yield at + a, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            a = b
        at += len(piece)
