"""DuckDB statements for the queries over periodic runs, the Merkle manifest and licenses."""

from __future__ import annotations

from wayfare.llm import license_scan

# The checksum of a decimal number, its table built from the polynomial.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
              lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
)"""


def _crc32(number: str) -> str:
    """`steps` of `crc_table` must be in scope."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
        "lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295)"
    )


# Equal 16-word windows at two places of a text, by distance: a stretch of
# consecutive such places is a maximal repetition.
RUNS = f"""
WITH {_CRC_TABLE},
read AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         CASE WHEN doc_id IS NOT NULL THEN {_crc32('doc_id')} END AS h
  FROM documents, crc_table
),
planned AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM read),
tailed AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM planned
),
docs AS (
  SELECT r, doc_id, n,
         CASE WHEN a < n THEN w[1:a] || list_transform(range(n - a), lambda i: w[a + i % (1 + (n - a) // (3 + g % 8)) + 1]) ELSE w END AS w
  FROM tailed
),
windows AS (
  SELECT r, i, hash(array_to_string(w[i + 1:i + 16], ' ')) AS g
  FROM (SELECT r, w, unnest(range(n - 15)) AS i FROM docs)
),
again AS (SELECT a.r, a.i, b.i - a.i AS q FROM windows a JOIN windows b ON a.r = b.r AND a.g = b.g AND b.i > a.i),
stretches AS (
  SELECT r, q, min(i) AS start, max(i) - min(i) + 16 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM again) GROUP BY r, q, island
),
runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length
  HAVING length >= greatest(24, 3 * min(q))
),
best AS (
  SELECT r, start, length, period
  FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY (length * 1000000000000) // period DESC, start, period) AS k FROM runs)
  WHERE k = 1
),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS all_runs
  FROM runs GROUP BY r
),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS p FROM runs),
words AS (SELECT r, w[p + 1] AS word, p FROM (SELECT r, w, unnest(range(n)) AS p FROM docs)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS k FROM words LEFT JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(all_runs, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def _tree(name: str, nodes: str, levels: int) -> str:
    """CTEs that climb `nodes(tree, pos, h)`: per level the runs `{name}_g{k}` and the next nodes `{name}_n{k}`."""
    out = [f"{name}_n0 AS (SELECT tree, pos, h FROM {nodes})"]
    for k in range(levels):
        out.append(
            f"{name}_g{k} AS (SELECT *, sum(len(hs)) OVER (PARTITION BY tree) AS size FROM "
            f"(SELECT tree, pos // 8 AS up, list(h ORDER BY pos) AS hs FROM {name}_n{k} GROUP BY ALL))"
        )
        out.append(
            f"{name}_n{k + 1} AS (SELECT tree, up AS pos, "
            f"CASE WHEN size = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_g{k})"
        )
    return ",\n".join(out)


def _fold(name: str, rows: str, levels: int) -> str:
    """CTEs that take `rows(r, tree, pos, node, proof)` through the levels; the last is `{name}_f{levels}`."""
    out = [f"{name}_f0 AS (SELECT * FROM {rows})"]
    for k in range(levels):
        slot = "CAST(pos % 8 AS INTEGER)"
        before, behind = f"array_to_string(hs[1:{slot}], '')", f"array_to_string(hs[{slot} + 2:], '')"
        out.append(
            f"{name}_f{k + 1} AS (SELECT r, f.tree, f.pos // 8 AS pos, "
            f"CASE WHEN size = 1 THEN node ELSE sha256({before} || node || {behind}) END AS node, "
            f"CASE WHEN size = 1 THEN proof ELSE proof || {before} || {behind} END AS proof "
            f"FROM {name}_f{k} f JOIN {name}_g{k} g ON f.tree = g.tree AND f.pos // 8 = g.up)"
        )
    return ",\n".join(out)


def _leaf(text: str) -> str:
    fields = [
        f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"
        for c in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(fields)})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Enough levels for 8^8 rows of a group and 8^4 groups.
MERKLE = f"""
WITH {_CRC_TABLE},
read AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS h,
         CASE WHEN doc_id IS NOT NULL AND {_crc32('doc_id')} % 3 = 0 THEN {_leaf(_LOWER)} END AS changed
  FROM documents, crc_table
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM read
),
{_tree('low', 'leaves', 8)},
subroots AS (SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, h FROM low_n8),
{_tree('high', 'subroots', 4)},
starts AS (SELECT r, tree, pos, coalesce(changed, h) AS node, '' AS proof FROM leaves),
{_fold('low', 'starts', 8)},
middles AS (SELECT r, s.tree, s.pos, node, proof FROM low_f8 f JOIN subroots s ON f.tree = s.name),
{_fold('high', 'middles', 4)}
SELECT doc_id, leaves.h AS leaf, subroots.h AS subroot, high_n4.h AS root, sha256(proof) AS proof_sha256,
       node AS folded_root, node = high_n4.h AS verified
FROM leaves JOIN high_f4 USING (r) JOIN subroots ON subroots.name = leaves.tree, high_n4
"""


def _template_rows() -> str:
    entries = license_scan.templates(license_scan.BASE, license_scan.NOTICES + license_scan.TEXTS)
    return ", ".join(
        f"({t}, '{label}', '{' '.join(words)}', {k}, {drift}, {t < len(license_scan.BASE)})"
        for t, (label, words, k, drift) in enumerate(entries)
    )


# Grams as strings; the alignment climbs the template word by word, one row per diagonal of the band.
LICENSES = f"""
WITH RECURSIVE templates AS (
  SELECT t, label, string_split(phrase, ' ') AS w, len(string_split(phrase, ' ')) AS n, k, drift, is_base
  FROM (VALUES {_template_rows()}) v(t, label, phrase, k, drift, is_base)
),
grams AS (
  SELECT t, k, q, array_to_string(w[q + 1:q + k], ' ') AS g FROM (SELECT t, k, w, unnest(range(n - k + 1)) AS q FROM templates)
),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
placed AS (
  SELECT r, k, p, array_to_string(w[p + 1:p + k], ' ') AS g
  FROM (SELECT r, k, w, unnest(range(len(w) - k + 1)) AS p FROM docs, (SELECT DISTINCT k FROM templates))
),
votes AS (SELECT DISTINCT r, t, p - q AS d, q FROM placed JOIN grams USING (k, g)),
diagonals AS (SELECT r, t, d, count(*) AS m FROM votes GROUP BY ALL),
phrases AS (SELECT r, label, d FROM diagonals JOIN templates USING (t) WHERE is_base AND m = n - k + 1),
based AS (
  SELECT r, count(*) AS n_base, min(d) AS first_word, max(d) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM phrases GROUP BY r
),
cells AS (SELECT DISTINCT r, t, d, unnest(range(q, q + k)) AS q FROM votes JOIN templates USING (t)),
candidates AS (
  SELECT a.r, a.t, a.d, n, drift
  FROM diagonals a JOIN templates USING (t) JOIN cells c ON c.r = a.r AND c.t = a.t AND c.d BETWEEN a.d AND a.d + drift
  GROUP BY ALL HAVING count(DISTINCT c.q) / n >= CAST({license_scan.COVERAGE} AS DOUBLE)
),
steps AS (
  SELECT r, t, d, n, CAST(-1 AS BIGINT) AS q, unnest(range(drift + 1)) AS j, CAST(0 AS BIGINT) AS best FROM candidates
  UNION ALL
  SELECT r, t, d, n, q + 1, j, max(grown) OVER (PARTITION BY r, t, d ORDER BY j)
  FROM (
    SELECT s.r, s.t, s.d, s.n, s.q, s.j,
           greatest(best + CASE WHEN c.q IS NULL THEN 0 ELSE 1 END,
                    coalesce(lead(best) OVER (PARTITION BY s.r, s.t, s.d ORDER BY s.j), 0)) AS grown
    FROM steps s LEFT JOIN cells c ON c.r = s.r AND c.t = s.t AND c.d = s.d + s.j AND c.q = s.q + 1
    WHERE s.q + 1 < s.n
  )
),
verified AS (
  SELECT r, t, d, max(best) / n AS share FROM steps WHERE q = n - 1 GROUP BY r, t, d, n
  HAVING max(best) / n >= CAST({license_scan.COVERAGE} AS DOUBLE)
),
chosen AS (
  SELECT v.r, label, share FROM verified v JOIN templates USING (t)
  WHERE NOT EXISTS (
    FROM verified o WHERE o.r = v.r AND o.t = v.t AND abs(o.d - v.d) <= drift AND (o.share > v.share OR (o.share = v.share AND o.d < v.d))
  )
),
named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM phrases UNION SELECT r, label FROM chosen) GROUP BY r
),
scored AS (SELECT r, max(share) AS score FROM chosen GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN based USING (r) LEFT JOIN named USING (r) LEFT JOIN scored USING (r)
"""
