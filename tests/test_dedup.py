from lakeloom.operators.dedup import counted, dedup, dedup_copies, dedup_report, fill, latest_attrs, latest_per_key

ROWS = [(1, "b", 2), (1, "a", 3), (1, "a", 3), (2, None, 1), (2, "z", 1), (None, "n", 0)]
SCHEMA = "k int, s string, t int"


def test_dedup_takes_the_first_by_order_then_by_the_rest(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(dedup(df, ["k"])) == [(None, "n", 0), (1, "a", 3), (2, None, 1)]
    assert rows(dedup(df, ["k"], ["t"])) == [(None, "n", 0), (1, "b", 2), (2, None, 1)]


def test_dedup_does_not_depend_on_partitioning(spark, rows):
    df = spark.createDataFrame(ROWS * 50, SCHEMA)
    want = rows(dedup(df.coalesce(1), ["k"]))
    assert all(rows(dedup(df.repartition(n), ["k"])) == want for n in (2, 7))


def test_dedup_by_all_columns(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(dedup(df, df.columns)) == rows(dedup_copies(df))


def test_hot_copies_shrink_before_the_shuffle(spark):
    """A key with a third of the rows sends one row per map task, not all of them."""
    df = spark.range(90_000, numPartitions=6).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    plan = dedup(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert dedup(df, ["k"]).filter("k = 0").first().v == 0


def test_latest_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, 5, "x"), (1, 7, "y"), (1, 7, "z"), (2, None, "n")], "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [(1, 7, "z"), (2, None, "n")]


def test_latest_attributes_come_from_one_row(spark, rows):
    """Two attempts at one time: the later id decides for both columns."""
    df = spark.createDataFrame(
        [("o", 10, 1, "failed", "wallet"), ("o", 10, 2, "success", "card"), ("p", 5, 3, "success", "cash")],
        "o string, t int, id int, status string, method string",
    )
    got = latest_attrs(df, "o", ["t", "id"], {"status": "last_status", "method": "last_method"})
    assert rows(got) == [("o", "success", "card"), ("p", "success", "cash")]


def test_report_and_observed_counts(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(dedup_report(df, ["k"], "t")) == [("t", 6, 3, 3)]
    assert rows(dedup_report(df.filter("false"), ["k"], "t")) == [("t", 0, 0, 0)]
    seen_df, seen = counted(df, "n")
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 6


def test_fill_only_the_named_columns(spark, rows):
    df = spark.createDataFrame([(None, None), ("a", 1)], "c string, n int")
    assert rows(fill(df, {"c": "unknown"})) == [("a", 1), ("unknown", None)]
