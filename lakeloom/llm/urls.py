"""URL rules by hash prefixes.

Each distinct URL is expanded into expressions: every suffix of its host at a dot, with every
prefix of its path that has the length of some rule's path. Expressions and rules meet in an
equi-join on the first hex digits of their digests; the full digests confirm, and the longest
rule decides (ties: the longer host, then ``block``).

Cases: a NULL URL or one without ``://`` has an empty host and path and meets no rule. Rows,
repeated rows included, come back one by one; equal URLs are judged once. Rules need a NULL-free
host, path and action. Other columns of the input are not carried. Native expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_ones
from .common import lower_ascii, unused

PREFIX_DIGITS = 8  # hex digits of the digest that the join compares
RULE_BYTES = 32 << 20  # rules up to this size are sent to every executor


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, in lower case."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def judge(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str = "allow") -> DataFrame:
    """``id_col``, ``url_col``, host, path, rule (NULL if none fits) and verdict for every row.

    ``rules`` has ``action`` (allow or block), ``host`` and ``path``.
    """
    key = unused(pages, "_url")
    asked = pages.select(F.col(id_col), F.col(url_col), F.coalesce(F.col(url_col), F.lit("")).alias(key))
    hosts = F.split("host", r"\.")
    parts = asked.select(key).distinct().select(
        key, url_host(F.col(key)).alias("host"), url_path(F.col(key)).alias("path"),
        # As many as the rules' paths have different lengths.
        rules.agg(F.collect_set(F.length("path"))).scalar().alias("_lengths"),
    )

    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(hosts)), lambda i: F.array_join(F.slice(hosts, i, F.size(hosts)), ".")
    )
    prefixes = F.transform(F.filter("_lengths", lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    expanded = parts.select(key, "host", "path", F.explode_outer(expressions).alias("_expression"))
    expanded = expanded.withColumn("_digest", _digest(F.col("_expression")))

    listed = rules.select("action", "host", "path", F.concat("host", "path").alias("_rule"))
    listed = listed.select(
        F.col("action").alias("_action"), F.col("host").alias("_host"), "_rule", _digest(F.col("_rule")).alias("_full")
    ).withColumn("_prefix", F.substring("_full", 1, PREFIX_DIGITS))
    (small,) = small_ones([listed], RULE_BYTES)
    found = expanded.withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS)).join(
        F.broadcast(listed) if small else listed, "_prefix", "left"
    )
    fits = F.col("_full") == F.col("_digest")
    rank = F.struct(
        F.length("_rule").alias("n"), F.length("_host").alias("h"), (F.col("_action") == "block").alias("b"),
        F.col("_rule").alias("rule"), F.col("_action").alias("action"),
    )
    judged = found.groupBy(key, "host", "path").agg(F.max(F.when(fits, rank)).alias("_best"))
    verdicts = judged.select(
        key, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict")
    )
    # Names of the input never clash with the result's: they are told apart by position.
    renamed = asked.toDF("_id", "_asked", key)
    return renamed.join(verdicts, key).select(
        F.col("_id").alias(id_col), F.col("_asked").alias(url_col), "host", "path", "rule", "verdict"
    )
