"""A corpus pipeline over ``documents``: quality rules, near duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as
the next stage's input. All but the last return the columns of ``documents``; any further columns
go along. Rows with NULL texts have no words and are rejected by the quality rules; an empty table
stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import bpe, mixing, neardup, pii, quality
from lakeloom.llm.common import unused
from lakeloom.llm.queries import vocabulary
from lakeloom.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the policy in force."""
    mark = unused(docs, "ledger")
    return quality.ledger(docs, "text", mark).filter(quality.passes(quality.CURRENT, mark)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows with a NULL id stay. Rows that repeat an id and a text stay once, those that share an id but not
    the text are judged each by its own text.
    """
    return neardup.one_of_each(docs, "doc_id", "text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` counts the new text.

    NULL and empty texts stay as they are, and so do repeated rows, each of which is changed alike.
    """
    clean = pii.redact(docs, pii.fit(docs, "text"), "text")
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _mixed(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with their slots; the same ones for the same documents."""
    return mixing.mix(docs, mixing.damped_weights(docs, "source"), "doc_id", "source", out=out)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of their slots: part files follow one another."""
    mark = unused(docs, "mix")
    return mixing.in_mixed_order(_mixed(docs, mark), mark).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, whether they decode to it again, and the document's slot and place in the mix.

    A reader that packs files anew loses the order in which the mixing stage wrote them, so the
    result has it as columns: sorted by ``slot`` (NULLs last) and ``place`` it is the mix. A NULL text has no
    ids and does not change the others; further columns of the table go no further than this stage.
    """
    docs = docs.select("doc_id", "lang", "source", "n_chars", "text")
    placed = _mixed(docs, "mix").select("*", "mix.slot", "mix.place")
    ids, back = "token_ids", "decoded"
    coded = bpe.round_trip(mixing.in_mixed_order(placed, "mix"), "text", vocabulary(), ids, back)
    return coded.select(
        "doc_id", "lang", "source", "n_chars", "text",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.col(ids).alias("token_ids"),
        (F.col(back) == F.coalesce("text", F.lit(""))).alias("round_trip"),
        "slot",
        "place",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixed_sources", mixed_sources),
    ("tokens", tokens),
]

#: The personal-data stage has a fitted model, which SQL cannot say; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
