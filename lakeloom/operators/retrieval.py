"""Texts in chunks for an index, and the quality of what the index returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256  # sentences folded before their chunks are added to those of the text

#: A sentence: up to closing marks or line ends, with the white space behind them. Every character is in one.
SENTENCE = r"(?s)[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*"


def sentences(text: Column, budget: int) -> Column:
    """The text in sentences, in order and complete; longer ones than the budget in pieces."""
    parts = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))
    pieces = lambda s: F.when(F.length(s) <= budget, F.array(s)).otherwise(
        F.regexp_extract_all(s, F.lit(f"(?s).{{1,{budget}}}"), F.lit(0))
    )
    return F.flatten(F.transform(parts, pieces))


def chunks(df: DataFrame, text_col: str, budget: int = 1000, overlap: int = 200) -> DataFrame:
    """One row per chunk: the columns of ``df`` but the text, ``chunk``, ``chunk_start``, ``chunk_end`` and ``chunk_text``.

    Sentences are packed in order into chunks of at most ``budget`` code points. A chunk begins with the last
    sentence of the one before if that has at most ``overlap`` code points and leaves room for the next.
    Offsets are code points of the original, and every code point is in a chunk. One fold per text, in
    blocks of sentences, so that a long text's list of chunks is copied once per block. A NULL or empty text has no chunks.
    """
    if not 0 <= overlap < budget:
        raise ValueError("the overlap must be smaller than the budget")
    kept = [c for c in df.columns if c != text_col]
    parts = df.select(*kept, sentences(F.coalesce(text_col, F.lit("")), budget).alias("_s"))
    kind = "array<struct<first:int,last:int,start:int,stop:int>>"
    number = lambda v: F.lit(v).cast("int")
    # The open chunk: first sentence, number of the next one, offsets of the chunk's start, of the last sentence and of the end.
    start = F.struct(
        F.array().cast(kind).alias("done"), number(0).alias("first"), number(0).alias("next"),
        number(0).alias("start"), number(0).alias("mark"), number(0).alias("stop"),
    )

    def add(state: Column, sentence: Column) -> Column:
        n = F.length(sentence)
        full = state["stop"] + n - state["start"] > budget
        again = (state["stop"] - state["mark"] <= overlap) & (state["stop"] - state["mark"] + n <= budget) & (state["mark"] > state["start"])
        closed = F.array(F.struct(state["first"], state["next"].alias("last"), state["start"], state["stop"]))
        return F.struct(
            F.when(full, F.concat(state["done"], closed)).otherwise(state["done"]).alias("done"),
            F.when(~full, state["first"]).when(again, state["next"] - 1).otherwise(state["next"]).alias("first"),
            (state["next"] + 1).alias("next"),
            F.when(~full, state["start"]).when(again, state["mark"]).otherwise(state["stop"]).alias("start"),
            state["stop"].alias("mark"),
            (state["stop"] + n).alias("stop"),
        )

    def add_block(state: Column, at: Column) -> Column:
        fresh = F.struct(F.array().cast(kind).alias("done"), *[state[c].alias(c) for c in ("first", "next", "start", "mark", "stop")])
        inner = F.aggregate(F.slice("_s", at + 1, F.lit(BLOCK)), fresh, add)
        return F.get(
            F.transform(F.array(inner), lambda b: F.struct(F.concat(state["done"], b["done"]).alias("done"), *[b[c].alias(c) for c in ("first", "next", "start", "mark", "stop")])),
            F.lit(0),
        )

    blocks = F.when(F.size("_s") > 0, F.sequence(F.lit(0), F.size("_s") - 1, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    last = lambda s: F.struct(s["first"].alias("first"), s["next"].alias("last"), s["start"].alias("start"), s["stop"].alias("stop"))
    folded = F.aggregate(blocks, start, add_block, lambda s: F.when(s["stop"] > 0, F.concat(s["done"], F.array(last(s)))).otherwise(s["done"]))
    listed = parts.select(*kept, "_s", F.posexplode(folded).alias("chunk", "_c"))
    text = F.array_join(F.slice("_s", F.col("_c.first") + 1, F.col("_c.last") - F.col("_c.first")), "")
    return listed.select(*kept, "chunk", F.col("_c.start").alias("chunk_start"), F.col("_c.stop").alias("chunk_end"), text.alias("chunk_text"))


def ranked_metrics(results: DataFrame, judged: DataFrame, query: str, item: str, score: str, k: int) -> DataFrame:
    """Per query: ``returned``, ``relevant``, ``precision_at_k``, ``recall_at_k``, ``reciprocal_rank``.

    ``judged`` lists the relevant (query, item) pairs. Results of a query are ranked by score, equal scores by
    item; a repeated item counts at its best place. Precision is out of ``k`` places even if fewer were
    returned, recall out of all relevant items (NULL if there are none), the reciprocal rank is 0 if none of the
    ``k`` is relevant. Queries without results but with judgements are in it. Each task first keeps its own best ``k`` per query.
    """
    best = results.groupBy(query, item).agg(F.max(score).alias(score))
    place = F.row_number().over(Window.partitionBy(query).orderBy(F.desc_nulls_last(score), item))
    top = best.withColumn("_place", place).filter(F.col("_place") <= k)
    right = judged.select(query, item).distinct()
    marked = top.join(right.withColumn("_right", F.lit(1)), [query, item], "left")
    found = marked.groupBy(query).agg(
        F.count(F.lit(1)).alias("returned"), F.count("_right").alias("_hits"), F.min(F.when(F.col("_right") == 1, F.col("_place"))).alias("_first")
    )
    every = right.groupBy(query).agg(F.count(F.lit(1)).alias("relevant"))
    both = found.join(every, query, "full_outer")
    hits = F.coalesce("_hits", F.lit(0)).cast("double")
    return both.select(
        query, F.coalesce("returned", F.lit(0)).alias("returned"), F.coalesce("relevant", F.lit(0)).alias("relevant"),
        (hits / k).alias("precision_at_k"), F.try_divide(hits, "relevant").alias("recall_at_k"),
        F.coalesce(1.0 / F.col("_first"), F.lit(0.0)).alias("reciprocal_rank"),
    )


def index_state(source: DataFrame, index: DataFrame, key: str, changed: str, indexed: str, by: Sequence[str] = ()) -> DataFrame:
    """Coverage and freshness of an index: ``items``, ``covered``, ``stale``, ``orphaned``, ``coverage``.

    An item is covered if the index has its key, stale if its latest change is after its latest indexing (or has no time
    of it), and an indexed key without an item is orphaned.
    """
    items = source.groupBy(key, *by).agg(F.max(changed).alias("_changed"))
    have = index.groupBy(key).agg(F.max(indexed).alias("_indexed"), F.lit(1).alias("_in"))
    both = items.withColumn("_is", F.lit(1)).join(have, key, "full_outer")
    covered = F.col("_is").isNotNull() & F.col("_in").isNotNull()
    fresh = F.coalesce(F.col("_indexed") >= F.col("_changed"), F.lit(False))
    counts = both.groupBy(*by).agg(
        F.count("_is").alias("items"), F.count_if(covered).alias("covered"), F.count_if(covered & ~fresh).alias("stale"),
        F.count_if(F.col("_is").isNull()).alias("orphaned"),
    )
    return counts.select("*", F.try_divide(F.col("covered").cast("double"), "items").alias("coverage"))
