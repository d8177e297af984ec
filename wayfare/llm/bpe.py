"""BPE ids of whole texts, and back, with chunks that texts share encoded once.

A text is cut where a rolling hash of its bytes says so, hence at the same
places in every copy of a passage, wherever it stands. A first scan counts the
chunks by hash. Chunks that occur more than once set bits in a filter of fixed
size; the second scan encodes texts without such chunks on the spot. Of the
others it passes on the distinct chunks, which are encoded once for the whole
corpus, the order of chunks per distinct text, and the stretches between
shared chunks with their ids. A false positive of the filter, or a full one,
only sends more chunks that way; the result stays the same.

Cutting a text anywhere changes the ids around the cut. So the ids of a text
are joined like this: around each cut a window of `REACH` words on either side
is encoded again and replaces what the two chunks have there. A window begins
and ends at a blank or line feed before a printable ASCII character, which no
word, mark or normal form spans. What is kept of a chunk must agree with its
part of the text encoded by itself: the ids before and behind the kept part
are compared with those of the same words encoded anew, and while they differ
the windows grow, in the end to the whole text.

Null and empty texts have no ids. Rows that agree in text share its result; rows
are not compared by id, so repeated rows and rows without an id are rows of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.skew import splittable
from wayfare.llm.common import one_of_each, texts
from wayfare.session import new_run_dir, store

# Chunks: bytes of the rolling window (a power of two), bits that must be zero at a cut, least and largest size.
WINDOW_BITS = 4
CUT_BITS = 10
MIN_CHUNK = 256
MAX_CHUNK = 8192
# Words encoded again on either side of a cut.
REACH = 2
# The filter's size and places per chunk: 4 MB, about one in ten thousand chunks too many at 160,000 shared ones.
FILTER_BITS = 1 << 25
# Chunks and texts a task remembers to have passed on already.
MEMORY = 500_000
# Words and pieces whose ids a Python worker remembers, the longest of them, and the rows encoded at a time.
WORDS = 500_000
WORD_CHARS = 64
ROWS = 128

_FACTOR = 0x9E3779B97F4A7C15
_SAFE = re.compile(r"(?<=[ \n])[!-~]")
# Words on the short way, and the vocabulary's pattern for their pieces.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+(?:[ \n][!-~À-ÖØ-öø-ÿ]+)*")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_BETWEEN = re.compile(r"[ \n](?=[!-~])")


# -- chunks ------------------------------------------------------------------


def cuts(data: bytes, cut_bits: int = CUT_BITS, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of a text in UTF-8; a cut never divides a character."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    value = raw.astype(np.uint64) + np.uint64(1)
    for j in range(WINDOW_BITS):
        step = 1 << j
        value = value[:-step] * np.uint64(pow(_FACTOR, step, 1 << 64)) + value[step:]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    marked = (np.flatnonzero(value >> np.uint64(64 - cut_bits) == 0) + (1 << WINDOW_BITS)).tolist()
    out, last = [], 0

    def close(at: int) -> int:
        while at < n and data[at] & 0xC0 == 0x80:
            at += 1
        out.append(at)
        return at

    for at in [*marked, n]:
        while at - last > most:
            last = close(last + most)
        if at - last >= least and at < n:
            last = close(at)
    if last < n:
        out.append(n)
    return out


def chunks_of(text: str | None, **sizes: int) -> list[bytes]:
    data = (text or "").encode()
    ends = cuts(data, **sizes)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _two(data: bytes) -> tuple[int, int]:
    """128 bits as two signed longs."""
    raw = xxhash.xxh3_128_digest(data)
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


# -- joining -----------------------------------------------------------------

Encode = Callable[[list[str]], list[np.ndarray]]


class Joint:
    """The ids of one text from those of its chunks."""

    def __init__(self, parts: list[str], ids: list[np.ndarray], reach: int = REACH):
        self.text, self.ids, self.reach = "".join(parts), ids, reach
        self.ends = np.cumsum([len(p) for p in parts]).tolist()
        self.safe = [m.start() for m in _SAFE.finditer(self.text)]

    def asks(self) -> list[str]:
        """What has to be encoded: the windows, and of each kept chunk what is cut off at either end."""
        windows: list[list[int]] = []
        self.around = []
        for cut in self.ends[:-1]:
            i = bisect_left(self.safe, cut)
            a = self.safe[i - self.reach] if i >= self.reach else 0
            b = self.safe[i + self.reach - 1] if i + self.reach <= len(self.safe) else len(self.text)
            self.around.append((a, b))
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(b, windows[-1][1])
            else:
                windows.append([a, b])
        self.kept = []
        for k, (start, end) in enumerate(zip([0, *self.ends], self.ends, strict=False)):
            a = self.around[k - 1][1] if k else 0
            b = self.around[k][0] if k < len(self.around) else end
            if a < b:
                self.kept.append((k, start, a, b, end))
        self.windows = windows
        return [self.text[a:b] for a, b in windows] + [
            self.text[x:y] for _, start, a, b, end in self.kept for x, y in ((start, a), (b, end))
        ]

    def joined(self, answers: list[np.ndarray]) -> np.ndarray | None:
        """The text's ids, or nothing if a chunk does not agree with its ends."""
        pieces = list(zip([a for a, _ in self.windows], answers, strict=False))
        ends = iter(answers[len(self.windows) :])
        for k, _, a, _, _ in self.kept:
            ids, head, tail = self.ids[k], next(ends), next(ends)
            last = len(ids) - len(tail)
            if last < len(head) or not np.array_equal(ids[: len(head)], head) or not np.array_equal(ids[last:], tail):
                return None
            pieces.append((a, ids[len(head) : last]))
        pieces.sort(key=lambda p: p[0])
        return np.concatenate([p for _, p in pieces]) if pieces else np.empty(0, np.uint16)


def join_all(texts_: list[tuple[list[str], list[np.ndarray]]], encode: Encode, reach: int = REACH) -> list[np.ndarray]:
    """The ids of each text, given its chunks and their ids; windows grow until all agree."""
    out: list[np.ndarray | None] = [None] * len(texts_)
    left = list(range(len(texts_)))
    while left:
        joints = [Joint(*texts_[i], reach) for i in left]
        asked = [j.asks() for j in joints]
        answers = iter(encode([a for some in asked for a in some]))
        for i, joint, some in zip(left, joints, asked, strict=True):
            out[i] = joint.joined([next(answers) for _ in some])
        left, reach = [i for i in left if out[i] is None], 2 * reach
    return out


# -- the tokenizer -----------------------------------------------------------


class Coder:
    """A tokenizer that remembers words, with what its results are digested to.

    A text is divided at the blanks and line feeds that `_SAFE` accepts, so its
    ids are those of its words one after the other. Words of printable ASCII and
    Latin letters up to U+00FF, which no normal form changes, are lower-cased,
    split by the vocabulary's pattern and handed to its merges; any other word
    goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        # One core per task; the library's threads would ask for all of them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.numbers = [str(i) for i in range(size)]
        self.spelling = ByteLevel(add_prefix_space=False, use_regex=False)
        self.merges = self.tokenizer.model.tokenize
        # Words as they stand, and pieces of words in lower case.
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else self.spelling.pre_tokenize_str(piece)[0][0]
        ids = np.array([t.id for t in self.merges(spelt)], self.kind).tobytes()
        if len(piece) <= WORD_CHARS:
            self.pieces[piece] = ids
        return ids

    def _plain(self, word: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces.get(p) or self._piece(p) for p in _PIECE.findall(word.lower())])

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        odd = [w for w in words if not _PLAIN.fullmatch(w) or "<|" in w]
        found = self.tokenizer.encode_batch_fast(odd, add_special_tokens=False) if odd else []
        out = {w: np.array(e.ids, self.kind).tobytes() for w, e in zip(odd, found, strict=True)}
        return out | {w: self._plain(w) for w in words if w not in out}

    def encode(self, texts_: list[str]) -> list[np.ndarray]:
        known, out = self.words, []
        for text in texts_:
            words = _BETWEEN.split(text)
            if len(known) + len(self.pieces) + len(words) > WORDS:
                known.clear()
                self.pieces.clear()
            new = self._learn([w for w in set(words) if w not in known])
            ids = [known[w] if w in known else new[w] for w in words] if new else map(known.__getitem__, words)
            out.append(np.frombuffer(b"".join(ids), self.kind))
            known.update((w, i) for w, i in new.items() if len(w) <= WORD_CHARS)
        return out

    def digests(self, ids: np.ndarray) -> tuple[int, str, str]:
        """Number of ids, digest of the ids, digest of the decoded text."""
        as_list = ids.tolist()
        text = self.tokenizer.decode(as_list, skip_special_tokens=False)
        numbers = " ".join(map(self.numbers.__getitem__, as_list))
        return len(as_list), hashlib.sha256(numbers.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One per Python worker and vocabulary."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


# -- on Spark ----------------------------------------------------------------

_DONE, _ROW, _OWN, _REF, _CHUNK = range(5)
_RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_PASSED = f"kind int, t1 bigint, t2 bigint, seq int, h1 bigint, h2 bigint, body binary, ids binary, {_RESULT}"


def _as_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def shared_filter(docs: DataFrame, bits: int = FILTER_BITS, **sizes: int) -> np.ndarray:
    """A Bloom filter, two places a chunk, of the chunks of `docs(text)` that occur more than once: `bits` / 8 bytes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_two(c) for t in texts(batch, "text") for c in chunks_of(t, **sizes)]
            pairs, n = np.unique(np.array(found, np.int64).reshape(-1, 2), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.array(n)], ["h1", "h2", "n"])

    counted = docs.select("text").mapInArrow(hashed, "h1 bigint, h2 bigint, n bigint").groupBy("h1", "h2")
    place = F.explode(F.array(*[F.pmod(F.col(h), F.lit(bits)) for h in ("h1", "h2")])).alias("place")
    places = counted.agg(F.sum("n").alias("n")).where("n > 1").select(place)
    byte = F.shiftright("place", 3).alias("byte")
    filled = places.groupBy(byte).agg(F.bit_or(F.expr("shiftleft(1, cast(place & 7 as int))")).alias("mask"))
    out = np.zeros(bits // 8, np.uint8)
    # At most a row per byte of the filter.
    table = filled.select("byte", F.col("mask").cast("int").alias("mask")).toArrow()
    out[table.column("byte").to_numpy()] = table.column("mask").to_numpy()
    return out


def _listed(filter_: np.ndarray, h: tuple[int, int]) -> bool:
    bits = len(filter_) * 8
    return all(filter_[(x % bits) >> 3] >> ((x % bits) & 7) & 1 for x in h)


def passed_on(docs: DataFrame, shared: np.ndarray, vocabulary: Callable[[], str], **sizes: int) -> DataFrame:
    """`docs(doc_id, text)` -> results of texts without shared chunks, and what the others are made of."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_PASSED).fields])
    kept = docs.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, filter_ = coder(vocabulary()), kept.value
        texts_seen: set[tuple[int, int]] = set()
        chunks_seen: set[tuple[int, int]] = set()
        nothing = (None,) * 3

        def new(key: tuple[int, int], seen: set[tuple[int, int]]) -> bool:
            if key in seen:
                return False
            if len(seen) >= MEMORY:
                seen.clear()
            seen.add(key)
            return True

        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            out, plain, own = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text"), strict=True):
                chunks = chunks_of(text, **sizes)
                keys = [_two(c) for c in chunks]
                marks = [_listed(filter_, k) for k in keys]
                if not any(marks):
                    plain.append((doc_id, text or ""))
                    continue
                whole = _two(text.encode())
                out.append((doc_id, _ROW, *whole, None, None, None, None, None, *nothing))
                if not new(whole, texts_seen):
                    continue
                stretch: list[bytes] = []
                for seq, (chunk, key, mark) in enumerate(zip([*chunks, b""], [*keys, None], [*marks, True], strict=True)):
                    if not mark:
                        stretch.append(chunk)
                        continue
                    if stretch:
                        own.append((whole, seq - 1, b"".join(stretch)))
                        stretch = []
                    if key:
                        out.append((None, _REF, *whole, seq, *key, None, None, *nothing))
                        if new(key, chunks_seen):
                            out.append((None, _CHUNK, None, None, None, *key, chunk, None, *nothing))
            for (doc_id, _), ids in zip(plain, code.encode([t for _, t in plain]), strict=True):
                out.append((doc_id, _DONE, None, None, None, None, None, None, None, *code.digests(ids)))
            for (whole, seq, body), ids in zip(own, code.encode([b.decode() for _, _, b in own]), strict=True):
                out.append((None, _OWN, *whole, seq, None, None, body, ids.tobytes(), *nothing))
            yield _as_batch(out, schema)

    return docs.mapInArrow(run, schema)


def encoded_chunks(chunks: DataFrame, vocabulary: Callable[[], str]) -> DataFrame:
    """`(c1, c2, text)` -> the same with the chunk's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary())
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            ids = code.encode([b.decode() for b in batch.column("text").to_pylist()])
            yield batch.append_column("code", pa.array([i.tobytes() for i in ids], pa.binary()))

    return chunks.mapInArrow(run, "c1 bigint, c2 bigint, text binary, code binary")


def joined_texts(parts: DataFrame, vocabulary: Callable[[], str]) -> DataFrame:
    """`(t1, t2, parts)` -> `(t1, t2)` with the text's results; the parts of a text are in their order."""
    schema = T.StructType.fromDDL(f"t1 bigint, t2 bigint, {_RESULT}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary())
        for batch in batches:
            for some in (batch.slice(at, ROWS) for at in range(0, len(batch), ROWS)):
                read = [
                    ([p["body"].decode() for p in one], [np.frombuffer(p["ids"], code.kind) for p in one])
                    for one in some.column("parts").to_pylist()
                ]
                keys = zip(some.column("t1").to_pylist(), some.column("t2").to_pylist(), strict=True)
                found = join_all(read, code.encode)
                yield _as_batch([(*k, *code.digests(ids)) for k, ids in zip(keys, found, strict=True)], schema)

    return parts.mapInArrow(run, schema)


def recoded(docs: DataFrame, vocabulary: Callable[[], str], filter_bits: int = FILTER_BITS, **sizes: int) -> DataFrame:
    """`docs(doc_id, text)` -> a row per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    `vocabulary()` names the tokenizer's file on the machine that calls it;
    `sizes` are those of `cuts`.
    """
    run = new_run_dir(docs.sparkSession, "bpe")
    docs = one_of_each(docs, "doc_id", "text")
    passed = store(passed_on(docs, shared_filter(docs, filter_bits, **sizes), vocabulary, **sizes), f"{run}/passed")
    chunks = (
        passed.where(F.col("kind") == _CHUNK)
        .groupBy(F.col("h1").alias("c1"), F.col("h2").alias("c2"))
        .agg(F.first("body").alias("text"))
    )
    codes = store(encoded_chunks(chunks, vocabulary), f"{run}/codes")
    # A text that several tasks passed on has shared chunks only and is made once.
    order = passed.where(F.col("kind") == _REF).groupBy("t1", "t2", "seq").agg(F.first(F.struct("h1", "h2")).alias("h"))
    here = splittable(F.col("h.h1"), F.col("c1")) & (F.col("h.h2") == F.col("c2"))
    shared = order.join(codes, here).select("t1", "t2", F.struct("seq", F.col("text").alias("body"), F.col("code").alias("ids")).alias("part"))
    own = passed.where(F.col("kind") == _OWN).select("t1", "t2", F.struct("seq", "body", "ids").alias("part"))
    known = shared.unionByName(own)
    whole = known.groupBy("t1", "t2").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    made = store(joined_texts(whole, vocabulary), f"{run}/made")
    results = ["n_tokens", "ids_sha256", "decoded_sha256"]
    made = made.select(F.col("t1").alias("m1"), F.col("t2").alias("m2"), *results)
    rows = passed.where(F.col("kind") == _ROW).select("doc_id", "t1", "t2")
    same = splittable(F.col("t1"), F.col("m1")) & (F.col("t2") == F.col("m2"))
    done = passed.where(F.col("kind") == _DONE).select("doc_id", *results)
    return done.unionByName(rows.join(made, same).select("doc_id", *results))
