"""Token ids in files of independent zstandard frames with a seek table.

A file holds documents in ascending doc_id order, `FRAME_DOCS` documents or
`FRAME_IDS` ids to a frame, whichever comes first. A frame's content is a
header (number of documents, then per document whether it has an id, the id and
its number of ids) and the ids as little-endian unsigned 32-bit integers.
Behind the frames stands the seek table in a skippable frame of the published
seekable layout: per frame its compressed size, its content's size and the low
32 bits of its content's XXH64; then the number of frames, a descriptor and the
magic number. Before it, in another skippable frame, stands an index: per frame
its number of documents with an id and the first and last of these ids. Any
reader of zstandard can decompress the file; a reader that wants some documents
reads the tail, looks their ids up in the index and decompresses their frames
only. The manifest has each file's first and last id, so only files that may
hold a document are opened.

Files are written under a temporary name and moved into place, and only files
of finished tasks are listed in the manifest, so lost executors and repeated
tasks leave nothing half-written behind that a reader would see.

Null and empty texts have no ids but the end id. Rows without an id come last;
rows that share an id are ordered by text. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import one_of_each, texts
from wayfare.session import new_run_dir, store

END_ID = 2
FRAME_DOCS = 256
FRAME_IDS = 1 << 18
LEVEL = 3
# Ids, by number, that a task looks up in a file at a time.
READ_IDS = 1 << 16
# Words whose ids a Python worker remembers, and the longest of them.
CACHE_WORDS = 1_000_000
CACHE_CHARS = 64

# The vocabulary's pattern for pieces.
_PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# White space but blank and line feed; ASCII marks.
_ODD_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_NO_MARKS = {c: None for c in range(33, 127) if not chr(c).isalpha()}

# Fixed values of the seekable layout.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
DESCRIPTOR = 0x80  # entries carry a checksum

INDEX_MAGIC = 0x184D2A50

_DOC = np.dtype([("has_id", "<u8"), ("doc_id", "<i8"), ("n", "<u8")])
_INDEX = np.dtype([("n", "<u8"), ("first", "<i8"), ("last", "<i8")])


# -- tokens ------------------------------------------------------------------


class _Known(dict):
    """Ids by word; an unknown word is encoded when it is first asked for."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, w: str) -> bytes:
        ids = self.encode(w)
        if len(w) <= CACHE_CHARS:
            self[w] = ids
        return ids


class WordEncoder:
    """Ids of whole texts, word by word.

    The vocabulary's pattern always starts a new piece at a blank between two
    characters that are not white space, so a text's ids are those of its words,
    each with the blank before it; a line feed between two such characters is a
    piece of its own. Whatever stands around other white space is one longer
    word. Words are looked up in a cache. Unknown words of letters, ASCII digits
    and marks are split by the pattern and go straight to the tokenizer's
    merges; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges = self.tokenizer.model.tokenize
        # How the vocabulary spells the 256 byte values.
        self.spelling = {b: self._spelt(ByteLevel(add_prefix_space=False, use_regex=False), b) for b in range(256)}
        self.cache_words = cache_words
        self.behind = _Known(lambda w: self.word(w, " "))
        self.opening = _Known(lambda w: self.word(w, ""))
        self.marks = _Known(self.pieces)
        self.line_feed = self.whole("\n")

    @staticmethod
    def _spelt(level, byte: int) -> str:
        if byte < 128:
            return level.pre_tokenize_str(chr(byte))[0][0]
        # A two-byte character has the byte in front (194 to 223) or behind; any other is spelt as itself.
        for char in (bytes([byte, 128]), bytes([195, byte])):
            try:
                spelt = level.pre_tokenize_str(char.decode())[0][0]
            except UnicodeDecodeError:
                continue
            return spelt[0 if char[0] == byte else 1]
        return chr(byte)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def pieces(self, text: str) -> bytes:
        """Ids of letters, ASCII digits and marks, split by the vocabulary's pattern."""
        ids = []
        for piece in _PATTERN.findall(text):
            ids += [t.id for t in self.merges(piece.encode().decode("latin-1").translate(self.spelling))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, w: str, blank: str) -> bytes:
        """Ids of a word with or without a blank before it."""
        core = w.rstrip(_MARKS)
        if core.isalpha():
            if len(core) < len(w):
                known = self.behind if blank else self.opening
                return known[core] + self.marks[w[len(core) :]]
            piece = (blank + w).encode().decode("latin-1").translate(self.spelling)
            ids = [t.id for t in self.merges(piece)]
            return struct.pack(f"<{len(ids)}I", *ids)
        plain = w.translate(_NO_MARKS)
        return self.pieces(blank + w) if not plain or plain.isalpha() else self.whole(blank + w)

    @staticmethod
    def even(text: str) -> bool:
        """Whether all white space is single blanks and line feeds between other characters."""
        if text[:1] in ("", " ", "\n") or text[-1] in " \n" or "  " in text or "\n\n" in text:
            return False
        return " \n" not in text and "\n " not in text and not any(c in text for c in _ODD_SPACE)

    @staticmethod
    def words(text: str) -> list[str]:
        """Parts of a text, each but the first with the blank before it left out.

        A part neither starts nor ends with white space, except that the text's
        own ends may; so every blank that was cut at stands between two others.
        """
        parts = text.split(" ")
        starts = [0] + [
            i
            for i in range(1, len(parts))
            if parts[i - 1] and parts[i] and not parts[i - 1][-1].isspace() and not parts[i][0].isspace()
        ]
        return [" ".join(parts[a:b]) for a, b in zip(starts, [*starts[1:], len(parts)], strict=True)]

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self.whole(text)
        behind, opening = self.behind.__getitem__, self.opening
        if not self.even(text):
            first, *rest = self.words(text)
            return (self.whole(first) if first else b"") + b"".join(map(behind, rest))
        lines = []
        for line in text.split("\n"):
            words = iter(line.split(" "))
            lines.append(opening[next(words)] + b"".join(map(behind, words)))
        return self.line_feed.join(lines)

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        out = [self.encode(t) if t else b"" for t in batch]
        if len(self.behind) + len(self.opening) > self.cache_words:
            self.behind.clear()
            self.opening.clear()
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# -- the file format -----------------------------------------------------------


class Writer:
    """Frames one after the other, the seek table at the end."""

    def __init__(self, sink, level: int = LEVEL):
        self.sink, self.packer, self.table = sink, zstandard.ZstdCompressor(level=level), []
        self.index: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.parts: list[bytes] = []
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids) // 4))
        self.parts.append(ids)
        self.ids += len(ids) // 4
        if len(self.docs) >= FRAME_DOCS or self.ids >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if self.docs:
            head = np.array(self.docs, _DOC)
            content = struct.pack("<I", len(head)) + head.tobytes() + b"".join(self.parts)
            frame = self.packer.compress(content)
            self.sink.write(frame)
            self.table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            named = [doc_id for has_id, doc_id, _ in self.docs if has_id]
            self.index.append((len(named), min(named, default=0), max(named, default=0)))
            self.docs, self.parts, self.ids = [], [], 0

    def close(self) -> None:
        self.flush()
        index = np.array(self.index, _INDEX).tobytes()
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), DESCRIPTOR, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class Reader:
    """Reads the seek table, then whichever frames are asked for."""

    def __init__(self, source):
        self.source, size = source, source.size()
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or descriptor != DESCRIPTOR:
            raise ValueError("not a file with a seek table")
        raw = self._at(size - 9 - 12 * n, 12 * n)
        self.table = [struct.unpack_from("<III", raw, 12 * i) for i in range(n)]
        self.places = np.concatenate([[0], np.cumsum([t[0] for t in self.table])]).astype(np.int64)
        self.index = np.frombuffer(self._at(size - 17 - (12 + _INDEX.itemsize) * n, _INDEX.itemsize * n), _INDEX)

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def __len__(self) -> int:
        return len(self.table)

    def frame(self, i: int) -> list[tuple[int | None, np.ndarray]]:
        """The documents of frame i: (doc_id, ids)."""
        packed, size, checksum = self.table[i]
        content = zstandard.ZstdDecompressor().decompress(self._at(int(self.places[i]), packed), max_output_size=size)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        (n,) = struct.unpack_from("<I", content)
        head = np.frombuffer(content, _DOC, n, 4)
        ids = np.frombuffer(content, "<u4", offset=4 + head.nbytes)
        cuts = np.cumsum(head["n"].astype(np.int64))
        return [
            (int(d["doc_id"]) if d["has_id"] else None, ids[b - int(d["n"]) : b])
            for d, b in zip(head, cuts.tolist(), strict=True)
        ]


    def documents(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The documents with these ids, from the frames that may hold them."""
        ids = np.unique(np.fromiter(wanted, np.int64))
        low, high = np.searchsorted(ids, self.index["first"]), np.searchsorted(ids, self.index["last"], side="right")
        for i in np.flatnonzero((self.index["n"] > 0) & (low < high)).tolist():
            some = set(ids[low[i] : high[i]].tolist())
            for doc_id, tokens in self.frame(i):
                if doc_id in some:
                    yield doc_id, tokens


# -- on Spark ------------------------------------------------------------------


def _file_system(url: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(url) if ":/" in url else (fs.LocalFileSystem(), url)


_MANIFEST = "part int, path string, frames int, n_docs bigint, n_ids bigint, first_id bigint, last_id bigint"


def write_files(
    docs: DataFrame, folder: str, vocabulary: Callable[[], str], end_id: int = END_ID
) -> DataFrame:
    """Encode `docs(doc_id, text)` into files under `folder` -> their manifest, one row each.

    `vocabulary()` names the tokenizer's file on the machine that calls it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, root = _file_system(folder)
        words = encoder(vocabulary())
        end = np.array([end_id], "<u4").tobytes()
        writer = sink = None
        n_docs = n_ids = 0
        name = f"part-{part:06d}-{uuid.uuid4().hex[:8]}.tok.zst"
        temporary, final = f"{root}/_{name}.tmp", f"{root}/{name}"
        for batch in batches:
            for at in range(0, len(batch), FRAME_DOCS):
                some = batch.slice(at, FRAME_DOCS)
                if writer is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(temporary)
                    writer = Writer(sink)
                encoded = words.encode_batch([t or "" for t in texts(some, "text")])
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoded, strict=True):
                    writer.add(doc_id, ids + end)
                    n_docs, n_ids = n_docs + 1, n_ids + len(ids) // 4 + 1
        if writer is not None:
            writer.close()
            sink.close()
            system.move(temporary, final)
            named = [(first, last) for n, first, last in writer.index if n]
            row = {
                "part": part, "path": final, "frames": len(writer.table), "n_docs": n_docs, "n_ids": n_ids,
                "first_id": min((a for a, _ in named), default=None), "last_id": max((b for _, b in named), default=None),
            }
            kinds = [pa.int32(), pa.string(), pa.int32()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_pylist([row], pa.schema(list(zip(row, kinds, strict=True))))

    docs = one_of_each(docs, "doc_id", "text")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    ranged = docs.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return store(ranged.mapInArrow(write, _MANIFEST), f"{folder}-manifest")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents in the files' order -> `(doc_id, start, n_tokens, ids_crc32)`.

    start counts the ids of all documents before; every frame's checksum is
    compared on the way.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(row["path"]) as source:
                    reader, start = Reader(source), row["before"]
                    for i in range(len(reader)):
                        ids_, starts, counts, sums = [], [], [], []
                        for doc_id, ids in reader.frame(i):
                            ids_.append(doc_id)
                            starts.append(start)
                            counts.append(len(ids))
                            sums.append(zlib.crc32(ids.tobytes()))
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in (ids_, starts, counts, sums)],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    # One row per file: their running sum is all that passes through one task.
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("part", "path", F.coalesce(before, F.lit(0)).cast("bigint").alias("before"))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = placed.repartition(tasks, "part")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(manifest: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """The documents of `wanted(doc_id)` -> `(doc_id, ids)`, a row for each that is in the files.

    The ranges of the files, one row each, are all that is broadcast. Every file
    that may hold a wanted document is opened once for every `READ_IDS` of them,
    and only frames that may hold one are decompressed.
    """
    spark = manifest.sparkSession
    ranges = manifest.where("first_id is not null").select("path", "first_id", "last_id")
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    paths = ranges.orderBy("first_id", "last_id", "path").toArrow()
    firsts, lasts, names = (paths.column(c).to_pylist() for c in ("first_id", "last_id", "path"))
    shared = spark.sparkContext.broadcast((np.array(firsts, np.int64), np.maximum.accumulate(np.array(lasts, np.int64)), lasts, names))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, most, last, path = shared.value
        for batch in batches:
            out = []
            for doc_id in batch.column("doc_id").to_pylist():
                # Rows of one id may go over the end of a file, hence several files.
                a, b = np.searchsorted(most, doc_id), np.searchsorted(first, doc_id, side="right")
                out += [(path[i], doc_id) for i in range(a, b) if last[i] >= doc_id]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([d for _, d in out], pa.int64())], ["path", "doc_id"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(row["path"]) as source:
                    for doc_id, tokens in Reader(source).documents(row["wanted"]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc_id]), pa.array([tokens.astype(np.int64)], pa.list_(pa.int64()))], ["doc_id", "ids"]
                        )

    placed = ids.mapInArrow(place, "path string, doc_id bigint")
    part = F.pmod(F.floor(F.col("doc_id") / READ_IDS), F.lit(1 << 20))
    asked = placed.groupBy("path", part.alias("part")).agg(F.collect_list("doc_id").alias("wanted"))
    return asked.select("path", "wanted").mapInArrow(read, "doc_id bigint, ids array<bigint>")


def token_files(docs: DataFrame, vocabulary: Callable[[], str], end_id: int = END_ID) -> DataFrame:
    """Write `docs` to a new folder of the shared one and read the files back."""
    folder = new_run_dir(docs.sparkSession, "tokens")
    return read_files(write_files(docs, folder, vocabulary, end_id), folder)
