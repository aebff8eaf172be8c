"""Queries over the test tables, one per operator, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, html, mixing, neardup, pii, quality, queries_more, repeats, sharding, urls
from .common import rows_of

WORD = r"[^\x20\x09-\x0D]+"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The public vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- 1: sharding --------------------------------------------------------------------------

SHARD_BYTES = 1 << 20


def op1_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES)
    return placed.select("doc_id", F.col("shard.name").alias("shard"), F.col("shard.depth").alias("depth"), F.col("shard.bytes").alias("n_bytes"))


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
levels AS (
  SELECT depth, h >> (60 - depth) AS p, sum(n_bytes) AS bytes FROM d, unnest(range(61)) AS t(depth) GROUP BY ALL),
found AS (
  SELECT doc_id, n_bytes, h, min(depth) AS depth
  FROM d JOIN levels ON h >> (60 - depth) = p WHERE bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT doc_id, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard, depth::INT AS depth, n_bytes FROM found
"""

# --- 2: near duplicates -------------------------------------------------------------------


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


OP2_SQL = rf"""
WITH RECURSIVE
tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM tokens, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * k >= 75 * (s.n + t.n - k)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)
"""

# --- 3: URL rules -------------------------------------------------------------------------

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rows_of(spark, RULES, ["action", "host", "path"])
    judged = urls.judge(_table(spark, sf_dir, "pages"), rules, "page_id", "url")
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
hits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN hits USING (page_id)
"""

# --- 4: main text -------------------------------------------------------------------------


def op4_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extract(pages, "html", "text")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# --- 5: quality rules ---------------------------------------------------------------------


def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.ledger(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    m = lambda c: F.col(f"ledger.{c}").alias(c)
    return found.select(
        "doc_id",
        *[m(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~quality.passes(quality.BASE)).alias("base_failed"),
        quality.passes(quality.CURRENT).alias("kept"),
        F.col("ledger.failed").alias("failed_rules"),
    )


OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i : i + 7], ' ')) AS n
  FROM d, unnest(range(1, len(w) - 6)) AS t(i)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, unnest(range(8)) AS t(k) WHERE n > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeated r USING (doc_id)),
f AS (
  SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (word_chars < 3 * n_words OR word_chars > 12 * n_words)::INT
    + 16 * (2 * n_dup_lines > n_lines)::INT + 32 * (2 * n_upper > word_chars)::INT AS bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed_rules
FROM f
"""

# --- 6: personal data ---------------------------------------------------------------------


def op6_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


# --- 7: repeated passages -----------------------------------------------------------------


def op7_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# --- 8: mixing ----------------------------------------------------------------------------


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs, mixing.damped_weights(docs, "source"))
    return mixed.select("doc_id", "source", F.col("mix.block").alias("block"), F.col("mix.slot").alias("slot"), F.col("mix.place").alias("place"))


OP8_SQL = f"""
WITH RECURSIVE
counts AS (SELECT source, count(*) AS n, ceil(count(*) / {mixing.BLOCK}.0)::BIGINT AS blocks FROM documents GROUP BY source),
steps_of AS (
  SELECT source, blocks, greatest(1, floor(pow(n, 0.7) / max(pow(n, 0.7)) OVER () * {mixing.PRECISION} + 0.5))::BIGINT AS w,
         2 * greatest({mixing.LIMIT // 4}, count(*) OVER ()) AS most
  FROM counts),
weights AS (SELECT source, blocks, greatest(w, (sum(w) OVER () + most - 1) // most)::BIGINT AS w FROM steps_of),
plan AS (
  SELECT list(source ORDER BY source NULLS FIRST) AS s, list(w ORDER BY source NULLS FIRST) AS w, sum(w)::BIGINT AS total,
         least(greatest({mixing.LIMIT}, 4 * count(*)), max(ceil(blocks * (total_w / w)) + 1))::BIGINT AS cycle
  FROM (SELECT *, (sum(w) OVER ())::DOUBLE AS total_w FROM weights)),
walk(slot, done, pick) AS (
  SELECT -1::BIGINT, list_transform(w, lambda x: 0::BIGINT), NULL::BIGINT FROM plan
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda d, i: d + (i = k)::BIGINT), k
  FROM (
    SELECT slot, done,
           list_min(list_filter(list_transform(range(1, len(w) + 1), lambda i:
             CASE WHEN done[i] * total < (slot + 2) * w[i]
                  THEN (((done[i] + 1) * total + w[i] - 1) // w[i]) * 1000000 + i END), lambda v: v IS NOT NULL)) % 1000000 AS k
    FROM walk, plan WHERE slot + 1 < cycle)),
schedule AS (SELECT s[pick] AS source, done[pick] - 1 AS turn, slot, cycle FROM walk, plan WHERE slot >= 0),
slots AS (SELECT source, count(*) AS a FROM schedule GROUP BY source),
placed AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('mix' || doc_id::VARCHAR), doc_id) - 1 AS n FROM documents)
SELECT doc_id, p.source, n // {mixing.BLOCK} AS block, (n // {mixing.BLOCK}) // h.a * cycle + slot AS slot, (n % {mixing.BLOCK})::INT AS place
FROM placed p JOIN slots h ON p.source IS NOT DISTINCT FROM h.source
JOIN schedule c ON c.source IS NOT DISTINCT FROM p.source AND c.turn = (n // {mixing.BLOCK}) % h.a
"""

# --- 9: byte-level BPE --------------------------------------------------------------------


def op9_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, "text", vocabulary()).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


# --- 10: nearest neighbours ---------------------------------------------------------------


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_extendible_shards": (op1_extendible_shards, OP1_SQL),
    "op2_minhash": (op2_minhash, OP2_SQL),
    "op3_url_rules": (op3_url_rules, OP3_SQL),
    "op4_tag_path_text": (op4_tag_path_text, None),
    "op5_quality_ledger": (op5_quality_ledger, OP5_SQL),
    "op6_boosted_pii": (op6_boosted_pii, None),
    "op7_column_suffixes": (op7_column_suffixes, None),
    "op8_pfair_mix": (op8_pfair_mix, OP8_SQL),
    "op9_forced_bpe": (op9_forced_bpe, None),
    "op10_multi_index": (op10_multi_index, None),
} | queries_more.QUERIES
