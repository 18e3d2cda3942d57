"""The queries of this folder, with production parameters, and the SQL each must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention, backoff, decontam, divergence, langid, licenses, mixing, neighbours, quality_rules, secrets, simhash, urls, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


_RULES = secrets.BASE_RULES + secrets.MORE_RULES
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.score(table(spark, sf_dir, "documents"), order=3)
    return scored.withColumn("mean_log_score", F.round("mean_log_score", 6))


ORACLES["op1_lm_scoring"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, len(w) AS n, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS c,
  unnest(list_concat([NULL], w[1:len(w) - 1])) AS b, unnest(list_concat([NULL, NULL], w[1:len(w) - 2])[1:len(w)]) AS a FROM d WHERE len(w) > 0),
f0 AS (SELECT count(*) AS n FROM t),
o1 AS (SELECT doc_id, c, count(*) AS n FROM t GROUP BY ALL),
o2 AS (SELECT doc_id, b, c, count(*) AS n FROM t WHERE i > 1 GROUP BY ALL),
o3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM t WHERE i > 2 GROUP BY ALL),
r1 AS (SELECT doc_id, c, sum(n) OVER (PARTITION BY c) - n AS n FROM o1),
r2 AS (SELECT doc_id, b, c, sum(n) OVER (PARTITION BY b, c) - n AS n FROM o2),
r3 AS (SELECT doc_id, a, b, c, sum(n) OVER (PARTITION BY a, b, c) - n AS n FROM o3),
r AS (
  SELECT t.doc_id, t.i, f0.n - t.n AS others, r1.n AS n1, coalesce(r2.n, 0) AS n2, coalesce(r3.n, 0) AS n3, m.n AS context1, p.n AS context2
  FROM t CROSS JOIN f0 JOIN r1 ON t.doc_id = r1.doc_id AND t.c = r1.c
  LEFT JOIN r2 ON t.doc_id = r2.doc_id AND t.b = r2.b AND t.c = r2.c
  LEFT JOIN r3 ON t.doc_id = r3.doc_id AND t.a = r3.a AND t.b = r3.b AND t.c = r3.c
  LEFT JOIN r1 m ON t.doc_id = m.doc_id AND t.b = m.c
  LEFT JOIN r2 p ON t.doc_id = p.doc_id AND t.a = p.b AND t.b = p.c),
s AS (
  SELECT doc_id, n3 > 0 AS seen, CASE WHEN n3 > 0 THEN ln(n3::DOUBLE / context2) ELSE CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
    + CASE WHEN n2 > 0 THEN ln(n2::DOUBLE / context1)
      ELSE ln(greatest(n1::DOUBLE, 0.4) / greatest(others, 1)) + CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END END END AS score FROM r)
SELECT doc_id, len(w) AS n_words, count(*) FILTER (seen) AS n_seen, round(avg(score), 6) AS mean_log_score
FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id, len(w)
"""


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


_SPANS = "\n".join(
    f"""  SELECT doc_id, {i} AS k, '{r.kind}' AS kind, unnest(range(len(m))) AS i, m, g, p FROM (
    SELECT doc_id, regexp_extract_all(t, {_quoted(r.pattern)}) AS m, regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) AS g,
      string_split_regex(t, {_quoted(r.pattern)}) AS p FROM d) {'UNION ALL' if i + 1 < len(_RULES) else ''}"""
    for i, r in enumerate(_RULES)
)
ORACLES["op2_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS (
{_SPANS}),
least_length AS (SELECT * FROM (VALUES {', '.join(f"({i}, {r.min_length})" for i, r in enumerate(_RULES))}) v(k, n)),
placed AS (
  SELECT doc_id, k, kind, len(g[i + 1]) AS n_group, len(m[i + 1]) AS n,
    coalesce(list_sum([len(x) for x in p[1:i + 1]]), 0) + coalesce(list_sum([len(x) for x in m[1:i]]), 0) AS s FROM raw),
kept AS (SELECT doc_id, placed.k, kind, s, s + placed.n AS e FROM placed JOIN least_length l ON placed.k = l.k AND n_group >= l.n)
SELECT d.doc_id,
  count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s, k) FILTER (k < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s, k), '') AS spans
FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id
"""


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


_TEMPLATE_ROWS = ", ".join(
    f"({_quoted(name)}, {size}, {least}, {_quoted(bigram)}, {n})" for name, size, least, bigram, n in licenses.template_rows(licenses.TEMPLATES, 0.8)
)
ORACLES["op4_license_scan"] = f"""
WITH templates AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) v(license, size, least, bigram, n)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z0-9]+') AS w FROM documents),
paired AS (SELECT doc_id, len(w) - 1 AS bigrams, unnest(range(len(w) - 1)) AS p, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS bigram FROM d WHERE len(w) > 1),
met AS (SELECT doc_id, bigrams, p, bigram, license, size, n FROM paired JOIN templates USING (bigram) WHERE bigrams >= least),
windows AS (SELECT doc_id, license, size, bigrams, n, bigram, unnest(range(greatest(p - size + 1, 0), least(p, greatest(bigrams - size, 0)) + 1)) AS s FROM met),
shared AS (SELECT doc_id, license, size, bigrams, s, n, bigram, least(count(*), n) AS c FROM windows GROUP BY doc_id, license, size, bigrams, s, n, bigram),
scored AS (SELECT doc_id, license, s, 2.0::DOUBLE * sum(c) / (least(bigrams, size) + size) AS dice FROM shared GROUP BY doc_id, license, size, bigrams, s),
runs AS (SELECT *, s - row_number() OVER (PARTITION BY doc_id, license ORDER BY s) AS run FROM scored WHERE dice >= 0.8),
k AS (SELECT doc_id, license, max(dice) AS dice, count(DISTINCT run) AS notices FROM runs GROUP BY doc_id, license)
SELECT d.doc_id, CAST(coalesce(sum(notices), 0) AS BIGINT) AS n_notices, arg_min(k.license, (-k.dice, k.license)) AS license, max(k.dice) AS dice,
  coalesce(string_agg(k.license, ',' ORDER BY k.license), '') AS licenses
FROM d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES["op6_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
    for i in range(1, len(w) - least(len(w), 10) + 2)]) AS x FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[j:j + n - 1], ' ') for j in range(1, len(w) - n + 2)]) AS x
  FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, item, s.n, i FROM spots s JOIN windows v ON s.x = v.x AND s.n = v.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_DIVERGENCE_TERMS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLES["op12_source_divergence"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_DIVERGENCE_TERMS} AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN own USING (lang, source) GROUP BY lang, source),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM grid WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
