"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontamination,
    fill_middle,
    language_id,
    language_model,
    licenses,
    mixing,
    near_duplicates,
    quality,
    resampling,
    secrets,
    toxicity,
    vector_file,
    warc,
)
from tidemark.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.find_secrets(table(spark, d, "documents"))


def op2_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.license_labels(licenses.license_spans(table(spark, d, "documents")))


def op3_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    return language_model.stupid_backoff(table(spark, d, "documents"), order=3)


def op4_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.round_trip(table(spark, d, "pages"))


def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, d, "documents"))


def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(table(spark, d, "documents"))


def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.counted(decontamination.contamination(table(spark, d, "documents"), table(spark, d, "benchmark")))


def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, d, "documents")))


def op12_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "embeddings")
    return vector_file.top_k(items, items.filter("vec_id % 50 = 0"), k=5)


def op13_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resampled(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_license_scan, op3_lm_scores, op4_warc, op5_mixing, op6_near_duplicates, op7_language_id,
        op8_quality_rules, op9_toxicity, op10_decontamination, op11_fill_in_middle, op12_exact_top_k, op13_importance_resampling,
    )
}

# ---- the same results in SQL, where SQL can say them ---------------------------------------------

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Kind, expression, measured group, least length: spelled out here, not taken from the operator.
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = [
    ("assign", _ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16),
    ("private_key", "-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", 0, 1),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", 0, 1),
    ("code_host", "gh[opsur]_[A-Za-z0-9]{36}", 0, 1), ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("cloud_key", "AIza[A-Za-z0-9_-]{35}", 0, 1), ("payment", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
]


def _hits(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least,
  unnest(regexp_extract_all(t, '{pattern}', 0)) AS h, unnest(regexp_extract_all(t, '{pattern}', {group})) AS g,
  unnest(string_split_regex(t, '{pattern}')) AS gap, generate_subscripts(string_split_regex(t, '{pattern}'), 1) AS nr
FROM d WHERE regexp_matches(t, '{pattern}')"""


OP1_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_hits(n, *k) for n, k in enumerate(_KINDS))}),
placed AS (
  SELECT *, CAST(sum(length(gap) + length(coalesce(h, ''))) OVER (PARTITION BY doc_id, rank ORDER BY nr) AS BIGINT) AS stop FROM found
),
spans AS (SELECT doc_id, rank, kind, stop - length(h) AS start, stop FROM placed WHERE h IS NOT NULL AND length(g) >= least),
joined AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b, count(*) FILTER (rank = 2) AS c,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)"""

OP4_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (
  SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q"""

OP6_SQL = f"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS x FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_have JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, b AS other FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(l.other, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least l USING (doc_id)"""

OP10_SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
window_of AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k,
    array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS p FROM i WHERE len(w) > 0)
),
size AS (SELECT DISTINCT k FROM window_of),
place AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, size WHERE len(w) >= k)
),
hit AS (SELECT doc_id, p, pl.k, item_id FROM place pl JOIN window_of o ON pl.k = o.k AND pl.x = o.x),
words_hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit h USING (doc_id) LEFT JOIN items t USING (doc_id)"""

OP11_SQL = """WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS w FROM documents
),
h AS (
  SELECT *, len(w) AS n, CAST('0x' || x[1:8] AS UBIGINT) AS h1, CAST('0x' || x[9:16] AS UBIGINT) AS h2,
    CAST('0x' || x[17:24] AS UBIGINT) AS h3, CAST('0x' || x[25:32] AS UBIGINT) AS h4 FROM d
),
c AS (
  SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
),
p AS (
  SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""

OP12_SQL = """WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

OP13_SQL = f"""WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || [CAST(i AS BIGINT) FOR i IN range(8)], lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS v
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b)
  )
),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
f AS (SELECT doc_id, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)]) AS x FROM d),
g AS (
  SELECT unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)]) AS x FROM (SELECT {_WORDS} AS w FROM benchmark)
),
h AS (SELECT x, hex(encode(x)) AS hex FROM (SELECT x FROM f UNION SELECT x FROM g)),
bucket AS (
  SELECT x, xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST('0x' || hex[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(len(hex) // 2)],
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS k
  FROM h, crc
),
s AS (SELECT k, count(*) AS n FROM f JOIN bucket USING (x) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM g JOIN bucket USING (x) GROUP BY k),
size AS (SELECT (SELECT count(*) FROM f) AS s, (SELECT count(*) FROM g) AS t),
gain AS (
  SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (size.s + 10000) AS DOUBLE)
    / CAST((coalesce(s.n, 0) + 1) * (size.t + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (k), size
),
mean AS (
  SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN bucket USING (x) JOIN gain USING (k) GROUP BY doc_id
),
score AS (
  SELECT d.doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST(CAST('0x' || sha256('7:' || coalesce(CAST(d.doc_id AS VARCHAR), ''))[1:8] AS UBIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN mean USING (doc_id)
),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM score WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM score LEFT JOIN ranked USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op1_secret_scan": OP1_SQL, "op4_warc": OP4_SQL, "op6_near_duplicates": OP6_SQL, "op10_decontamination": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL, "op12_exact_top_k": OP12_SQL, "op13_importance_resampling": OP13_SQL,
}
