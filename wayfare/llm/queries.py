"""The registered queries of the corpus operators: digests of their full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import (
    bpe,
    decontaminate,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    quality,
    runs,
    sharding,
    simhash,
    substring,
    token_files,
    twins,
    url_filter,
)
from wayfare.llm.common import table


def vocabulary() -> str:
    """The tokenizer's file on the machine that runs this."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_vocabulary() -> str:
    """The lower-case tokenizer's file on the machine that runs this."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = line_dedup.repeated_lines(docs)
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.array_join(F.transform("removed", lambda i: i.cast("string")), ","), 256).alias("removed_sha256"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), vocabulary)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), change=runs.repeated_tail, with_text=False)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.recoded(table(spark, sf_dir, "documents"), word_vocabulary)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proven = merkle.manifest(table(spark, sf_dir, "documents"))
    siblings = F.array_join(F.transform("path", lambda run: F.concat(run["before"], run["behind"])), "")
    folded = merkle.fold(F.coalesce("tampered_leaf", "leaf"), F.col("path"))
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict:
    import corpus_pipeline

    own = (
        op1_decontamination, op2_line_dedup, op3_simhash, op4_sharding, op5_license_scan,
        op6_mixing, op7_substring_dedup, op8_quality, op9_token_files, op10_url_filter,
        op11_periodic_runs, op12_bpe, op13_merkle,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


_FOLDED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP1 = f"""
WITH items AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes)
),
hits AS (SELECT r, i, grams.k, item_id FROM grams JOIN windows ON grams.g = windows.g AND grams.k = windows.k),
places AS (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM hits),
counted AS (SELECT r, count(*) AS n FROM places GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN counted USING (r) LEFT JOIN named USING (r)
"""

_OP7 = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)
),
owners AS (SELECT g, min(doc_id) AS owner FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS p
  FROM windows JOIN owners USING (g) WHERE owner < coalesce(doc_id, 9223372036854775807)
),
words AS (SELECT r, w[p] AS word, p FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM docs)),
kept AS (
  SELECT r, count(gone.p) AS lost, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS k
  FROM words LEFT JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_OP10 = """
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
numbered AS (SELECT row_number() OVER () AS r, * FROM parsed),
fits AS (
  SELECT r, verdict, h || p AS rule
  FROM numbered JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
),
won AS (SELECT r, arg_max(verdict, length(rule)) AS verdict, arg_max(rule, length(rule)) AS rule FROM fits GROUP BY r)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])(adult|bets|casino|spam)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM numbered LEFT JOIN won USING (r)
"""


def oracle_sql() -> dict[str, str]:
    """Twins of the queries that SQL can express on the driver's tables."""
    return {"op1_decontamination": _OP1, "op5_license_scan": twins.LICENSES, "op7_substring_dedup": _OP7, "op10_url_filter": _OP10, "op11_periodic_runs": twins.RUNS, "op13_merkle": twins.MERKLE}
