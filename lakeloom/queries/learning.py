"""Split, baseline and comparison of models; chunks, retrieval quality; records of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..operators.retrieval import chunks, index_state, ranked_metrics
from ..plans import learning
from ..plans.runner import Stage, StreamRecords, append_records, read_records, run_stages
from ..session import scratch
from ..sources.writers import staged, write_table
from ..streaming.ingest import append_to_table
from . import raw

CUT, HORIZON = "1999-01-01", "30 days"
FEATURES = ["n_lines", "quantity", "urgent"]


def _labelled(spark, d):
    """Orders with what is known when they are placed, and whether the order is worth more than 150,000."""
    lines = raw.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    orders = raw.table(spark, d, "orders")
    rows = orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", (F.col("o_totalprice") > 150000).cast("int").alias("label"),
        (F.substring("o_orderpriority", 1, 1) < "3").cast("int").alias("urgent"),
    )
    return spread_join(rows, lines, ["o_orderkey"])


def time_split(spark, d):
    """Rows, positives and customers per part of the split."""
    rows = learning.time_split(_labelled(spark, d), "o_orderdate", CUT, HORIZON)
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), F.count_distinct("o_custkey").alias("customers"),
        F.max(F.when(F.col("split") == "train", F.col("o_orderdate"))).alias("last_train"),
    )


def baseline_scores(spark, d):
    """A baseline fitted on train and applied to test: how many test rows got a score, by label; and the four cells add up."""
    rows = staged(learning.time_split(_labelled(spark, d), "o_orderdate", CUT, HORIZON), "labelled")
    model = learning.fit_baseline(rows.filter("split = 'train'"), FEATURES, "label")
    test = learning.scored(model, rows.filter("split = 'test'"), FEATURES)
    found = learning.confusion(test, "label", "score", by=["label"])
    return found.select("label", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("scored"))


def model_comparison(spark, d):
    """A rule on the quantity against a rule on the number of lines, per order, drawn by customer."""
    rows = learning.time_split(_labelled(spark, d), "o_orderdate", CUT, HORIZON).filter("split = 'test'")
    rules = rows.select(
        "o_custkey", "label", (F.col("n_lines") >= 4).cast("double").alias("current"), (F.col("quantity") >= 110).cast("double").alias("candidate")
    )
    return learning.compared(rules, "o_custkey", "label", "current", "candidate")


def document_chunks(spark, d):
    return chunks(raw.table(spark, d, "documents").select("doc_id", "text"), "text")


def _whole(c):
    """A vector in thousandths, so that products add up exactly."""
    return F.transform(c, lambda x: F.round(x.cast("double") * 1000).cast("bigint"))


def retrieval_quality(spark, d):
    """Vectors retrieved by inner product among those with the same strongest component, judged by equal labels."""
    rows = raw.table(spark, d, "embeddings").select("vec_id", "label", _whole(F.col("embedding")).alias("v"))
    rows = rows.withColumn("cell", F.array_position("v", F.array_max("v")))
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("label").alias("wanted"), F.col("v").alias("q"), "cell")
    pairs = asked.join(rows, "cell").filter("query <> vec_id")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x)
    results = pairs.select("query", F.col("vec_id").alias("item"), score.alias("score"))
    judged = pairs.filter("wanted = label").select("query", F.col("vec_id").alias("item"))
    return ranked_metrics(results, judged, "query", "item", "score", 5)


def index_coverage(spark, d):
    """Orders against the index of order lines: a line's last shipping is the indexing time of its order."""
    orders = raw.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.expr("o_orderdate + INTERVAL 60 DAY").alias("changed"))
    lines = raw.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("indexed"))
    return index_state(orders, lines, "o_orderkey", "changed", "indexed", by=["o_orderpriority"])


def run_records(spark, d):
    """A run that fails and is repeated under its id, a run that stays failed, and a stream of four micro-batches."""
    log, lake = scratch(spark, "run-log"), scratch(spark, "run-tables")
    ready = []

    def copied(name):
        return lambda: {name: write_table(raw.table(spark, d, name), f"{lake}/{name}")}

    def lines():
        if not ready:
            raise RuntimeError("not ready")
        return copied("lineitem")()

    stages = [Stage("orders", copied("orders")), Stage("lines", lines), Stage("parts", copied("part"))]
    append_records(spark, run_stages(spark, stages, retries=1), log, "first")
    append_records(spark, run_stages(spark, stages, retries=0), log, "second")
    ready.append(True)
    append_records(spark, run_stages(spark, stages, retries=1), log, "first")

    events = raw.table(spark, d, "events")
    folder, counts = f"{lake}/event-files", StreamRecords()
    events.repartition(4, "event_id").write.parquet(folder)
    spark.streams.addListener(counts)
    try:
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        append_to_table(stream, f"{lake}/captured", f"{lake}/captured-state", name="capture").awaitTermination()
        append_records(spark, counts.records(spark, ["capture"]), log, "stream")
    finally:
        spark.streams.removeListener(counts)
    return read_records(spark, log).select("run_id", "position", "stage", "status", "attempts", "rows_written", "message")


_LABELLED = f"""
    SELECT o_orderkey, o_custkey, o_orderdate, (o_totalprice > 150000)::INT AS label, n_lines, quantity,
           CASE WHEN o_orderdate >= TIMESTAMP '{CUT}' THEN 'test'
                WHEN o_orderdate + INTERVAL 30 DAY <= TIMESTAMP '{CUT}' THEN 'train' ELSE 'gap' END AS split
    FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity::BIGINT) AS quantity FROM lineitem GROUP BY l_orderkey)
      ON l_orderkey = o_orderkey"""

QUERIES = {
    "time_split": (
        time_split,
        f"""
        SELECT split, count(*) AS rows, sum(label)::BIGINT AS positives, count(DISTINCT o_custkey) AS customers,
               max(o_orderdate) FILTER (WHERE split = 'train') AS last_train
        FROM ({_LABELLED}) GROUP BY split""",
    ),
    "baseline_scores": (baseline_scores, f"SELECT label, count(*) AS scored FROM ({_LABELLED}) WHERE split = 'test' GROUP BY label"),
    "model_comparison": (
        model_comparison,
        f"""
        WITH t AS (
            SELECT o_custkey, label, (n_lines >= 4)::INT AS x, (quantity >= 110)::INT AS y FROM ({_LABELLED}) WHERE split = 'test' AND n_lines IS NOT NULL),
        u AS (
            SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE x = label) AS a, count(*) FILTER (WHERE y = label) AS b FROM t GROUP BY o_custkey),
        limits AS (SELECT unnest([{", ".join(map(str, learning.poisson_limits()))}]) AS l),
        w AS (
            SELECT o_custkey, r, (SELECT count(*) FROM limits
                   WHERE ('0x' || substr(md5(o_custkey || ':' || r // 8), (4 * (r % 8) + 1)::INT, 4))::BIGINT >= l) AS w
            FROM u, range(64) AS t(r)),
        g AS (
            SELECT r, sum(w * (b - a))::DOUBLE / nullif(sum(w * n), 0) AS gain FROM u JOIN w USING (o_custkey) GROUP BY r),
        s AS (SELECT list_sort(list(gain) FILTER (WHERE gain IS NOT NULL)) AS gains FROM g)
        SELECT sum(n)::BIGINT AS rows, sum(a)::DOUBLE / sum(n) AS current, sum(b)::DOUBLE / sum(n) AS candidate,
               (sum(b) - sum(a))::DOUBLE / sum(n) AS gain,
               any_value(gains)[1 + floor(len(any_value(gains)) * 0.025)::INT] AS gain_low,
               any_value(gains)[len(any_value(gains)) - floor(len(any_value(gains)) * 0.025)::INT] AS gain_high
        FROM u, s""",
    ),
    "document_chunks": (
        document_chunks,
        r"""
        WITH RECURSIVE
        s AS (
            SELECT doc_id, list_filter(flatten(list_transform(regexp_extract_all(text, '(?s)[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*'),
                       lambda x: CASE WHEN length(x) <= 1000 THEN [x] ELSE regexp_extract_all(x, '(?s).{1,1000}') END)), lambda x: x <> '') AS s
            FROM documents WHERE text <> ''),
        walk AS (
            SELECT doc_id, s, 0 AS i, 0 AS chunk, 0 AS first, 0::BIGINT AS start, 0::BIGINT AS mark, 0::BIGINT AS stop, NULL::INT AS c0,
                   NULL::INT AS c1, NULL::BIGINT AS a, NULL::BIGINT AS b FROM s
            UNION ALL
            SELECT doc_id, s, i + 1, chunk + over::INT, CASE WHEN NOT over THEN first WHEN again THEN i - 1 ELSE i END,
                   CASE WHEN NOT over THEN start WHEN again THEN mark ELSE stop END, stop, stop + n,
                   CASE WHEN over THEN first END, CASE WHEN over THEN i END, CASE WHEN over THEN start END, CASE WHEN over THEN stop END
            FROM (SELECT *, stop + n - start > 1000 AS over, stop - mark <= 200 AND stop - mark + n <= 1000 AND mark > start AS again
                  FROM (SELECT *, length(s[i + 1]) AS n FROM walk WHERE i < len(s)))),
        found AS (
            SELECT doc_id, chunk - 1 AS chunk, s, c0, c1, a, b FROM walk WHERE c0 IS NOT NULL
            UNION ALL SELECT doc_id, chunk, s, first, i, start, stop FROM walk WHERE i = len(s))
        SELECT doc_id, chunk, a::INT AS chunk_start, b::INT AS chunk_end, array_to_string(s[c0 + 1 : c1], '') AS chunk_text FROM found""",
    ),
    "retrieval_quality": (
        retrieval_quality,
        """
        WITH r AS (SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE * 1000)::BIGINT) AS v FROM embeddings),
        c AS (SELECT *, list_position(v, list_max(v)) AS cell FROM r),
        p AS (
            SELECT x.vec_id AS query, y.vec_id AS item, x.label = y.label AS good,
                   list_sum(list_transform(list_zip(x.v, y.v), lambda z: z[1] * z[2])) AS score
            FROM c x JOIN c y ON x.cell = y.cell AND x.vec_id % 20 = 0 AND x.vec_id <> y.vec_id),
        k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS place FROM p)
        SELECT query, count(*) FILTER (place <= 5) AS returned, count(*) FILTER (good) AS relevant,
               count(*) FILTER (good AND place <= 5) / 5.0::DOUBLE AS precision_at_k,
               CASE WHEN count(*) FILTER (good) > 0 THEN count(*) FILTER (good AND place <= 5) / (count(*) FILTER (good))::DOUBLE END AS recall_at_k,
               coalesce(1.0::DOUBLE / min(place) FILTER (good AND place <= 5), 0) AS reciprocal_rank
        FROM k GROUP BY query""",
    ),
    "index_coverage": (
        index_coverage,
        """
        WITH i AS (SELECT l_orderkey, max(l_shipdate) AS indexed FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderpriority, count(o_orderkey) AS items, count(*) FILTER (o_orderkey IS NOT NULL AND l_orderkey IS NOT NULL) AS covered,
               count(*) FILTER (o_orderkey IS NOT NULL AND l_orderkey IS NOT NULL AND indexed < o_orderdate + INTERVAL 60 DAY) AS stale,
               count(*) FILTER (o_orderkey IS NULL) AS orphaned,
               CASE WHEN count(o_orderkey) > 0 THEN count(*) FILTER (o_orderkey IS NOT NULL AND l_orderkey IS NOT NULL) / count(o_orderkey)::DOUBLE END AS coverage
        FROM orders FULL JOIN i ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
    ),
    "run_records": (
        run_records,
        """
        SELECT run_id, position, stage, status, attempts, rows_written, message FROM (VALUES
            ('first', 0, 'orders', 'success', 1, (SELECT count(*) FROM orders), NULL),
            ('first', 1, 'lines', 'success', 1, (SELECT count(*) FROM lineitem), NULL),
            ('first', 2, 'parts', 'success', 1, (SELECT count(*) FROM part), NULL),
            ('second', 0, 'orders', 'success', 1, (SELECT count(*) FROM orders), NULL),
            ('second', 1, 'lines', 'failed', 1, NULL, 'not ready'),
            ('second', 2, 'parts', 'skipped', 0, NULL, NULL),
            ('stream', 0, 'capture', 'success', 4, (SELECT count(*) FROM events), NULL))
            AS t(run_id, position, stage, status, attempts, rows_written, message)""",
    ),
}
