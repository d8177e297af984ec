"""Quality rules: a linear-chain conditional random field labels lines.

Every line with a word is an observation of a two-state chain, content or
boilerplate. Viterbi decoding picks the best sequence of labels for a document;
the share of its words on content lines decides whether it stays. Plain rules
on length and repetition come first.

The chain is trained here by maximum likelihood on at most `SAMPLE_DOCS`
labelled documents (those with the smallest hash of their id) and
`SAMPLE_LINES` lines of each; a line takes its document's label. Without any
label the chain falls back to fixed prior weights.

A null or empty text has no words and fails the rules. Repeated rows are judged
one by one; rows without a label or with another label than 0 or 1 train
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import one_of_each, rolling, texts

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
CONTENT_SHARE = 0.5
SAMPLE_DOCS = 2000
SAMPLE_LINES = 200

SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_MARKS = b"!?"
_DIGITS = bytes(range(48, 58))
_STOPS = (b".", b"!", b"?", b":", b";", b'"', b")")

FEATURES = [
    "bias", "symbols", "shouting", "marks", "digits", "repetition",
    "short", "open_end", "single_letters", "seen_before",
]
# Boilerplate minus content, used when there is no label to learn from.
PRIOR = np.array([-2.0, 6.0, 4.0, 4.0, 1.0, 4.0, 0.5, 0.5, 1.0, 1.0])
PRIOR_STAY = 1.5

FINDINGS = [
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"),
    ("content_share", "double"), ("kept", "boolean"),
]


def repeated_words(words: list[bytes], k: int = REPEAT_WINDOW) -> int:
    """Words inside runs of k words that occur at two or more places."""
    if len(words) <= k:
        return 0
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if len(number) == len(words):
        return 0
    values = (np.array(ids, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    _, place, times = np.unique(
        rolling(values, k, 0xD6E8FEB86659FD93), return_inverse=True, return_counts=True
    )
    starts = np.flatnonzero(times[place] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + k, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[float]:
    """Numbers between 0 and 1 that tell running text from boilerplate."""
    n, chars = len(words), len(line)
    ascii_letters = chars - len(line.translate(None, _LETTERS))
    upper = chars - len(line.translate(None, _UPPER))
    return [
        1.0,
        min(1.0, (chars - len(line.translate(None, SYMBOLS))) / n),
        upper / ascii_letters if ascii_letters else 0.0,
        min(1.0, (chars - len(line.translate(None, _MARKS))) / n),
        (chars - len(line.translate(None, _DIGITS))) / chars,
        1.0 - len(set(words)) / n,
        1.0 if n < 4 else 0.0,
        0.0 if words[-1].endswith(_STOPS) else 1.0,
        sum(len(w) == 1 for w in words) / n,
        1.0 if seen else 0.0,
    ]


def lines_of(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Features and word counts of the lines with a word; how many equal an earlier one."""
    rows, sizes, dups, seen = [], [], 0, set()
    for line in text.encode().split(b"\n") if text else ():
        words = line.split()
        if words:
            again = line in seen
            seen.add(line)
            dups += again
            rows.append(line_features(line, words, again))
            sizes.append(len(words))
    return np.array(rows).reshape(-1, len(FEATURES)), np.array(sizes, np.int64), dups


class Chain:
    """Weights of the two-state chain: line features and label changes."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @classmethod
    def prior(cls) -> Chain:
        return cls(np.stack([PRIOR * 0, PRIOR], 1), np.eye(2) * PRIOR_STAY)

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The most likely labels, 0 content and 1 boilerplate; content on a tie."""
        if not len(features):
            return np.empty(0, np.int64)
        scores = (features @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            from0, from1 = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + m00 if from0 else b + m10) + s0, (a + m01 if from1 else b + m11) + s1
        state = 0 if a >= b else 1
        path = [state]
        for step in reversed(back):
            state = step[state]
            path.append(state)
        return np.array(path[::-1])


def train(sequences: list[tuple[np.ndarray, int]], rounds: int = 150, ridge: float = 1.0) -> Chain:
    """Maximum likelihood by gradient ascent; the classes weigh the same in sum.

    All sequences go through the forward and backward recursion together,
    padded to the longest.
    """
    sequences = [(f, y) for f, y in sequences if len(f)]
    if not {0, 1} <= {y for _, y in sequences}:
        return Chain.prior()
    n, longest = len(sequences), max(len(f) for f, _ in sequences)
    x = np.zeros((n, longest, len(FEATURES)))
    here = np.zeros((n, longest))
    gold = np.array([y for _, y in sequences])
    for i, (f, _) in enumerate(sequences):
        x[i, : len(f)], here[i, : len(f)] = f, 1
    share = np.bincount(gold, here.sum(1), 2)
    weight = (here.sum() / (2 * share))[gold]
    total = here.sum()
    label = np.eye(2)[gold]
    pairs = here[:, 1:]
    gold_w = np.einsum("n,ntf,ns->fs", weight, x, label)
    gold_m = np.einsum("n,ns,nr->sr", weight * pairs.sum(1), label, label)

    w, m = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    speed_w, speed_m = np.zeros_like(w), np.zeros_like(m)
    for _ in range(rounds):
        s = x @ w
        fwd, bwd = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        fwd[:, 0] = s[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(fwd[:, t - 1, 0, None] + m[0], fwd[:, t - 1, 1, None] + m[1]) + s[:, t]
            fwd[:, t] = np.where(here[:, t, None] > 0, step, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = bwd[:, t + 1] + s[:, t + 1]
            step = np.logaddexp(ahead[:, 0, None] + m[:, 0], ahead[:, 1, None] + m[:, 1])
            bwd[:, t] = np.where(here[:, t + 1, None] > 0, step, 0)
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        node = np.exp(fwd + bwd - z[:, None, None]) * here[:, :, None] * weight[:, None, None]
        edge = np.exp(
            fwd[:, :-1, :, None] + m + (s + bwd)[:, 1:, None, :] - z[:, None, None, None]
        ) * (pairs * weight[:, None])[:, :, None, None]
        speed_w = 0.8 * speed_w + (gold_w - np.einsum("ntf,nts->fs", x, node) - ridge * w) / total
        speed_m = 0.8 * speed_m + (gold_m - edge.sum((0, 1)) - ridge * m) / total
        w, m = w + 2.0 * speed_w, m + 0.5 * speed_m
    return Chain(w, m)


def fit(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES
) -> Chain:
    """A chain from `labels(doc_id, quality)`: 1 is content, 0 is boilerplate."""
    chosen = (
        one_of_each(labels, "doc_id", "quality")
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )

    def features(batches):
        for batch in batches:
            arrays = [lines_of(t)[0][:sample_lines].ravel().tolist() for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(arrays, pa.list_(pa.float64()))],
                ["doc_id", "quality", "features"],
            )

    docs = one_of_each(docs, "doc_id", "text")
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("quality", T.IntegerType()),
            T.StructField("features", T.ArrayType(T.DoubleType())),
        ]
    )
    # The sample has at most `sample_docs` rows, so it can go to every task.
    rows = (
        docs.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "quality", "text")
        .mapInArrow(features, schema)
        .orderBy("doc_id", F.xxhash64("features"))
        .limit(2 * sample_docs)
        .toArrow()
    )
    return train(
        [
            (np.array(f).reshape(-1, len(FEATURES)), 1 - q)
            for f, q in zip(rows["features"].to_pylist(), rows["quality"].to_pylist(), strict=True)
        ]
    )


def judge(text: str | None, chain: Chain, content_share: float = CONTENT_SHARE) -> tuple:
    raw = text.encode() if text else b""
    words = raw.split()
    n = len(words)
    repeated = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * n
    features, sizes, dups = lines_of(text)
    share = float(sizes[chain.decode(features) == 0].sum() / n) if n else 0.0
    return (
        n,
        len((text or "").translate(_NO_BLANKS)) if n else 0,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        dups,
        repeated,
        failed,
        share,
        not failed and share >= content_share,
    )


_NO_BLANKS = {c: None for c in _BLANKS}


def assess(docs: DataFrame, chain: Chain, content_share: float = CONTENT_SHARE) -> DataFrame:
    """`docs(doc_id, text)` -> doc_id and the columns of `FINDINGS`, row by row."""
    docs = one_of_each(docs, "doc_id", "text")
    names = [name for name, _ in FINDINGS]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(", ".join(f"{a} {b}" for a, b in FINDINGS)).fields])

    def run(batches):
        for batch in batches:
            rows = [judge(t, chain, content_share) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(FINDINGS)],
                ],
                ["doc_id", *names],
            )

    return docs.mapInArrow(run, schema)


def keep_content(docs: DataFrame, chain: Chain, content_share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of `docs`, all columns, that the rules and the chain keep."""

    def run(batches):
        for batch in batches:
            kept = [judge(t, chain, content_share)[-1] for t in texts(batch, "text")]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
