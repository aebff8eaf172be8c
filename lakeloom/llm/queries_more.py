"""Queries of operators 11 to 13 with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import divergence, jaccard, repair

WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 11: n-gram Jaccard join ---------------------------------------------------------------


def op11_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH RECURSIVE
tokens AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM tokens, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * k >= 85 * (s.n + t.n - k)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# --- 12: source divergence ----------------------------------------------------------------


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all({_LOWER.format('t')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10),
gr AS (SELECT DISTINCT lang, source FROM d),
voc AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0)::HUGEINT AS nl FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT gr.lang, gr.source, k.term, coalesce(c.c, 0)::HUGEINT AS c, k.n::HUGEINT AS n
  FROM gr JOIN kept k ON gr.lang = k.lang LEFT JOIN c ON c.lang = gr.lang AND c.source = gr.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, c, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS p,
         1 + (1000000000 * (n + 2)) // (nl + 2 * v) AS q
  FROM dense JOIN voc USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM gr a JOIN gr b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# --- 13: conversation structure -----------------------------------------------------------


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return repair.audited(repair.damage(rows), rows)


OP13_SQL = r"""
WITH RECURSIVE
table_of AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], list_transform(range(8), lambda x: 0::BIGINT)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS mark
  FROM conversations),
hit AS (
  SELECT keyed.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(mark, ''), lambda ch: unicode(ch)::BIGINT)),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS z
  FROM keyed, table_of),
damaged AS (
  SELECT conv_id, turn, CASE z WHEN 4 THEN 'user' ELSE role END AS role,
         CASE z WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, range(2) c(k) WHERE z <> 0 AND (k = 0 OR z = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS x,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS x0
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND x0 || x NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
-- States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
ins(s, x, cost, pre, said) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
  (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
  (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])),
acts(x, t, cost, edit, needs, becomes) AS (VALUES
  (0, 0, 2, 'D', NULL, NULL), (1, 1, 2, 'D', NULL, NULL), (2, 2, 2, 'D', NULL, NULL), (3, 3, 2, 'D', NULL, NULL),
  (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL), (1, 2, 0, 'K', 'u', NULL), (3, 2, 0, 'K', 'u', NULL), (2, 3, 0, 'K', 'a', NULL),
  (0, 2, 1, 'R', NULL, 'user'), (1, 2, 1, 'R', NULL, 'user'), (3, 2, 1, 'R', NULL, 'user'), (2, 3, 1, 'R', NULL, 'assistant')),
steps AS (
  SELECT s, t, ins.cost + acts.cost AS cost, pre || edit AS edits, said, edit, needs, becomes FROM ins JOIN acts USING (x)),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]} AS b FROM counts
  UNION ALL
  SELECT conv_id, i, t, min({'cost': c, 'audit': a, 'said': m}) FROM (
    SELECT walk.conv_id, j.i, steps.t,
           b.cost + steps.cost + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 5 ELSE 0 END AS c, b.audit || edits AS a,
           list_concat(list_concat(b.said, steps.said),
                       CASE WHEN edit = 'D' THEN [] ELSE [coalesce(becomes, role) || ':' || text] END) AS m
    FROM walk JOIN judged j ON j.conv_id IS NOT DISTINCT FROM walk.conv_id AND j.i = walk.i + 1
    JOIN steps ON steps.s = walk.s AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (needs IS NULL OR needs = x)) AS o
  GROUP BY conv_id, i, t),
done AS (
  SELECT walk.conv_id, min({'cost': b.cost + ins.cost, 'audit': b.audit || pre, 'said': list_concat(b.said, ins.said)}) AS b
  FROM walk JOIN counts ON counts.conv_id IS NOT DISTINCT FROM walk.conv_id AND walk.i = n
  JOIN ins ON ins.s = walk.s AND ins.x IN (0, 3)
  GROUP BY walk.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

QUERIES = {
    "op11_partition_jaccard": (op11_partition_jaccard, OP11_SQL),
    "op12_source_divergence": (op12_source_divergence, OP12_SQL),
    "op13_conversation_repair": (op13_conversation_repair, OP13_SQL),
}
