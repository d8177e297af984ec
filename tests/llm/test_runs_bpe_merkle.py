"""Periodic runs, chunked BPE and the Merkle manifest against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wayfare.llm import bpe, merkle, queries, runs

TINY = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, runs int, hash string, tree string, kind int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(got, want):
    assert Counter(got) == Counter(want)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdeéñ中ZÀ") for _ in range(rng.randint(1, 6)))
    line = lambda n: " ".join(word() for _ in range(n))
    passage = line(120)
    out = [(i, line(rng.randint(1, 80))) for i in range(60)]
    out += [(100 + i, line(20) + " " + passage + "\n" + line(30)) for i in range(12)]
    out += [(200 + i, passage) for i in range(9)]
    out += [
        (300, "a b c " * 30 + "tail"), (301, "x " * 100), (302, "a b a b a b c a b a b a b c a b a b a b c " * 2),
        (303, line(3000) + " p q r" * 20 + " " + line(5)), (304, "one two " * 11), (305, "one two " * 12),
        (400, None), (401, ""), (402, " \n\t "), (403, "One"), (403, "One"), (404, " x　y \x1cz é <|endoftext|> 12½ don't"),
        (405, "漢" * 3000), (7, out[7][1]), (7, out[8][1]), (None, None), (None, "No Id"), (None, "No Id"), (None, passage),
    ]
    return [
        (i, t, None if (i or 0) % 5 == 4 else ("en" if (i or 0) % 5 else "de"), None if (i or 0) % 7 == 3 else "src", i and i + 1, 3, "h", "t", 9)
        for i, t in out
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- runs --------------------------------------------------------------------


def brute_runs(w, least=24, times=3):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= max(least, times * q)), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(60):
        some = []
        for _ in range(rng.randint(1, 8)):
            w = []
            for _ in range(rng.randint(0, 5)):
                p = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 9))]
                w += p * rng.randint(1, 8) + p[: rng.randint(0, len(p))]
            some.append([x.encode() for x in w])
        for least, times in ((24, 3), (6, 3), (2, 2)):
            assert runs.runs_of_texts(some, least, times) == [brute_runs(w, least, times) for w in some]


def plain(text):
    return (text or "").encode().split()


@pytest.mark.parametrize("change", [None, runs.repeated_tail])
def test_runs(docs, rows, change):
    want = []
    for r in rows:
        w = plain(r[1])
        if change and r[0] is not None and w:
            h = zlib.crc32(str(r[0]).encode())
            a, g = (h // 10) % len(w), h // 10
            if h % 10 == 0:
                w = [w[i] if i < a else w[a + (i - a) % (1 + (len(w) - a) // (3 + g % 8))] for i in range(len(w))]
        found = brute_runs(w)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        text = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        want.append((r[0], tuple(found), best, sha(text), text))
    assert sum(bool(x[1]) for x in want) >= 5
    got = runs.periodic_runs(docs, change=change).collect()
    same([(r.doc_id, tuple(map(tuple, r.runs)), r.strongest and tuple(r.strongest), *r[3:]) for r in got], want)


def test_a_stretch_has_its_least_period():
    assert runs.runs_of_texts([["a", "b"] * 24]) == [[(0, 48, 2)]]
    assert runs.runs_of_texts([["a"] * 23 + ["b"], ["a"] * 24]) == [[], [(0, 24, 1)]]


# -- BPE ---------------------------------------------------------------------


def library(text):
    tokenizer = bpe.coder(queries.word_vocabulary()).tokenizer
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_joints():
    code, rng = bpe.coder(queries.word_vocabulary()), random.Random(3)
    parts = ["a", "b ", "the ", " ", "\n", "é", "́", "'s", "'LL", "12", "½", "中", "<|endoftext|>", "!!", "　", "🙂🏽", "İ", "ΑΣ ", "x" * 30, "\x85", "ᄀ", "ᅡ"]
    for _ in range(80):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 300)))
        for sizes in ({"cut_bits": 2, "least": 8, "most": 64}, {"cut_bits": 4, "least": 1, "most": 20}):
            chunks = [c.decode() for c in bpe.chunks_of(text, **sizes)]
            assert "".join(chunks) == text
            joined = bpe.join_all([(chunks, code.encode(chunks))], code.encode, 1)[0].tolist()
            assert joined == code.tokenizer.encode(text, add_special_tokens=False).ids


def test_windows_grow_until_all_agree():
    code = bpe.coder(queries.word_vocabulary())
    chunks = ["one two thr", "ee four five six seven eight nine ten eleven twe", "lve thirteen"]
    ids = [i.copy() for i in code.encode(chunks)]
    # A chunk with a wrong id near its end does not agree, so it is encoded again.
    ids[1][-4] += 1
    asked = []
    spy = lambda some: asked.append(len(some)) or code.encode(some)
    whole = code.tokenizer.encode("".join(chunks), add_special_tokens=False).ids
    assert bpe.join_all([(chunks, ids)], spy, 3)[0].tolist() == whole and len(asked) > 1


def test_copies_are_cut_alike():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000))
    shifted = "something else in front, é " + text
    chunks, others = bpe.chunks_of(text), set(bpe.chunks_of(shifted))
    assert len(chunks) > 8 and sum(c in others for c in chunks) >= len(chunks) - 2


@pytest.mark.parametrize("bits", [bpe.FILTER_BITS, 8])
def test_bpe(docs, rows, bits):
    # With 8 bits every chunk counts as shared.
    got = bpe.recoded(docs, queries.word_vocabulary, bits, cut_bits=5, least=32, most=400).collect()
    same([tuple(r) for r in got], [(r[0], *library(r[1])) for r in rows])


def test_shared_chunks_are_encoded_once(docs):
    shared = bpe.shared_filter(docs, cut_bits=5, least=32, most=400)
    passed = bpe.passed_on(docs.coalesce(1), shared, queries.word_vocabulary, cut_bits=5, least=32, most=400).persist()
    chunks = passed.where(F.col("kind") == bpe._CHUNK)
    assert chunks.count() > 10
    assert chunks.groupBy("h1", "h2").count().where("count > 1").isEmpty()


def test_bpe_query(spark):
    got = queries.op12_bpe(spark, TINY).collect()
    texts = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    same([tuple(r) for r in got], [(r.doc_id, *library(r.text)) for r in texts])


# -- Merkle ------------------------------------------------------------------


def leaf(i, text, lang, source, n_chars):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(field, (i, source, lang, n_chars, text))))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        start = at - at % 8
        out.append(("".join(level[start:at]), "".join(level[at + 1 : start + 8])))
        at //= 8
    return out


def brute_manifest(rows):
    """Per row: doc_id, leaf, subroot, root, siblings, root folded from the tampered leaf."""
    groups = {}
    for i, text, lang, source, n_chars in (r[:5] for r in rows):
        lower = text and text.translate({c: c + 32 for c in range(65, 91)})
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        own = leaf(i, text, lang, source, n_chars)
        groups.setdefault(lang, []).append((i, own, leaf(i, lower, lang, source, n_chars) if tampered else own))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = levels([own for _, own, _ in groups[name]])
    top = levels([trees[name][-1][0] for name in names]) if names else []
    out = []
    for g, name in enumerate(names):
        for at, (i, own, changed) in enumerate(groups[name]):
            path = siblings(trees[name], at) + siblings(top, g)
            node = changed
            for before, behind in path:
                node = sha(before + node + behind)
            out.append((i, own, trees[name][-1][0], top[-1][0], sha("".join(map("".join, path))), node))
    return out


def proofs(df):
    path = F.transform("path", lambda run: F.concat(run["before"], run["behind"]))
    return df.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(path, ""), 256), merkle.fold(F.coalesce("tampered_leaf", "leaf"), F.col("path"))
    )


def test_merkle(docs, rows):
    want = brute_manifest(rows)
    assert len({r[5] for r in want}) > 5
    same([tuple(r) for r in proofs(merkle.manifest(docs)).collect()], want)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 1100])
def test_merkle_of_one_group(spark, n):
    rows = [(i % 1000, f"T{i % 1000}", "en", "s", 1) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    same([tuple(r) for r in proofs(merkle.manifest(docs)).collect()], brute_manifest(rows))


def test_merkle_with_a_group_per_row(spark):
    rows = [(i, f"T{i}", f"l{i}", "s", 1) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same([tuple(r) for r in proofs(merkle.manifest(docs)).collect()], brute_manifest(rows))


def test_rows_that_agree_are_numbered_by_several_tasks(spark, tmp_path):
    same_rows = spark.range(40000).select(F.lit("=en").alias("tree"), F.lit(5).alias("doc_id"), F.lit("h").alias("hash"))
    # A few kilobytes would be merged into one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    placed = merkle.numbered(same_rows, ["doc_id"], str(tmp_path / "n"), "rows")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.pos for r in placed.collect()) == list(range(40000))
    parts = spark.read.parquet(str(tmp_path / "n" / "rows")).groupBy(F.shiftright("row", 33)).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 30000


# -- tables ------------------------------------------------------------------


def test_empty_tables(none):
    for df in (runs.periodic_runs(none), bpe.recoded(none, queries.word_vocabulary), merkle.manifest(none)):
        assert df.count() == 0
