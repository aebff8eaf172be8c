import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakeloom.sources import messages, readers, versions, writers

SCHEMA = "id long, name string, at timestamp_ntz, n int"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_monthly_files_with_growing_schema(spark, rows, tmp_path):
    df = spark.createDataFrame(
        [(1, dt.date(2025, 3, 31), "x"), (2, dt.date(2025, 4, 1), "y"), (3, dt.date(2025, 4, 30), None), (4, None, "z")],
        "id int, d date, channel string",
    )
    path = str(tmp_path / "orders")
    writers.write_monthly(df, "d", path, "2025-04-01", ["channel"])
    assert "channel" not in spark.read.parquet(f"{path}/ym=2025-03").columns
    assert rows(readers.read_merged(spark, path), "id", "channel") == [(1, None), (2, "y"), (3, None), (4, "z")]
    old = readers.read_merged(spark, f"{path}/ym=2025-03", ["channel"])
    assert rows(old, "id", "channel") == [(1, None)]


def test_few_files_per_month(spark, tmp_path):
    df = spark.range(6000, numPartitions=6).select("id", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"))
    writers.write_monthly(df, "d", str(tmp_path / "m"), "2025-01-01", [])
    assert len(list((tmp_path / "m").glob("ym=*/part-*"))) <= 8


def test_union_views_and_optional_tables(spark, rows, tmp_path):
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2, "x")], "k int, s string")
    assert rows(readers.union_by_name([a, b])) == [(1, None), (2, "x")]
    a.write.parquet(str(tmp_path / "a"))
    readers.register_views(spark, {"some_view": str(tmp_path / "a" / "*.parquet")})
    assert spark.sql("SELECT k FROM some_view").first().k == 1
    assert readers.optional_table(spark, "some_view") is not None
    assert readers.optional_table(spark, "no_such_table") is None
    assert readers.object_store_settings("a", "b", "http://h")["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_write_counts_rows_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_table(spark.range(10), path) == 10
    assert writers.write_table(spark.range(3), path) == 3
    assert writers.write_table(spark.range(4), path, mode="append") == 4
    assert readers.read_table(spark, path).count() == 7
    part = spark.range(10).withColumn("p", F.col("id") % 2)
    assert writers.write_table(part, str(tmp_path / "p"), partition_by=["p"]) == 10
    assert sorted(x.name for x in (tmp_path / "p").glob("p=*")) == ["p=0", "p=1"]


def test_sections_are_replaced_one_by_one(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    for section, value in (("batch", 1), ("stream", 2), ("stream", 3)):
        writers.write_section(spark.createDataFrame([("m", value)], "metric string, v int"), path, section)
    assert rows(spark.read.parquet(path), "section", "v") == [("batch", 1), ("stream", 3)]


def test_json_lines_leave_out_nulls(spark, rows, tmp_path):
    df = spark.createDataFrame([(2, "b", dt.datetime(2025, 1, 1, 7), None), (1, None, dt.datetime(2025, 1, 1), 5)], SCHEMA)
    path = tmp_path / "nd"
    writers.write_ndjson(df, str(path), ["at"], ["id"])
    lines = [x for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [
        {"id": 1, "at": "2025-01-01T00:00:00", "n": 5},
        {"id": 2, "name": "b", "at": "2025-01-01T07:00:00"},
    ]
    assert rows(readers.read_json_lines(spark, str(path), schema(spark))) == rows(df)
    assert readers.read_lines(spark, str(path)).count() == 2


def test_lenient_decode(spark, rows):
    lines = [
        '{"id": 1, "name": "a", "at": "2025-01-01T00:00:01", "n": 3}',
        '{"id": 2, "n": "three", "name": "b"}',
        '{"id": 3, "nam',
        "   ",
        '{"id": 4}',
        "[1, 2]",
        "null",
        "plain text",
        '  {"id": 5, "extra": {"x": 1}}',
    ]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, pos int")
    good, bad = messages.decode_json(df, "value", schema(spark))
    assert rows(good, "pos", "id", "name", "n") == [(0, 1, "a", 3), (1, 2, "b", None), (4, 4, None, None), (8, 5, None, None)]
    assert rows(bad, "pos", "value") == [(2, lines[2]), (5, lines[5]), (6, lines[6]), (7, lines[7])]
    assert good.filter("pos = 0").first()["at"] == dt.datetime(2025, 1, 1, 0, 0, 1)


def test_keyed_messages(spark, rows):
    df = spark.createDataFrame([(2, "b", None, 1), (1, "a", None, 2), (3, "c", None, None)], SCHEMA)
    got = messages.to_messages(df, "id", ordered_by=["id"], limit=2)
    assert rows(got) == [("1", '{"id":1,"name":"a","n":2}'), ("2", '{"id":2,"name":"b","n":1}')]
    assert messages.to_messages(df, "id", ordered_by=["id"]).count() == 3


def test_versions(spark, rows, tmp_path):
    path = str(tmp_path / "v")
    with pytest.raises(ValueError):
        versions.read_as_of(spark, path)
    versions.commit(spark.range(50), path, "replace", "2025-01-01")
    versions.commit(spark.range(5), path, "append", "2025-01-02")
    assert versions.read_as_of(spark, path, "2025-01-01 12:00:00").count() == 50
    assert versions.read_as_of(spark, path).count() == 55
    with pytest.raises(ValueError, match="no version"):
        versions.read_as_of(spark, path, "2024-12-31")
    with pytest.raises(ValueError, match="before the last commit"):
        versions.commit(spark.range(1), path, "append", "2025-01-01")
    with pytest.raises(ValueError, match="kind"):
        versions.commit(spark.range(1), path, "merge", "2025-01-03")
    versions.commit(spark.range(2).withColumn("more", F.lit("m")), path, "replace", "2025-01-03")
    assert rows(versions.read_as_of(spark, path), "id", "more") == [(0, "m"), (1, "m")]
    versions.rollback(spark, path, "2025-01-02", "2025-01-04")
    assert versions.read_as_of(spark, path).count() == 55
    versions.compact(spark, path, "2025-01-05", files=1)
    assert versions.read_as_of(spark, path).count() == 55
    assert versions.read_as_of(spark, path, "2025-01-03").count() == 2
    assert [r.batch_id for r in versions.expired_batches(spark, path, "2025-01-05").orderBy("batch_id").collect()] == [1, 2, 3, 4]
    assert versions.expire(spark, path, "2025-01-05") == 4
    assert versions.read_as_of(spark, path).count() == 55


def test_repeated_epoch_is_written_once(spark, tmp_path):
    path = str(tmp_path / "v")
    for epoch in (0, 1, 1, 0):
        versions.commit(spark.range(10), path, "append", "2025-01-01", epoch=epoch)
    assert versions.read_as_of(spark, path).count() == 20


def test_only_visible_batches_are_read(spark, tmp_path):
    path = str(tmp_path / "v")
    for day in (1, 2, 3):
        versions.commit(spark.range(10), path, "replace", f"2025-01-0{day}")
    plan = versions.read_as_of(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_catalog_tables(spark, tmp_path):
    writers.create_namespace(spark, f"ns_lakeloom LOCATION '{tmp_path}/ns'")
    try:
        assert writers.save_table(spark.range(4), "ns_lakeloom.t") == 4
        assert readers.optional_table(spark, "ns_lakeloom.t").count() == 4
        writers.drop_table(spark, "ns_lakeloom.t")
        assert readers.optional_table(spark, "ns_lakeloom.t") is None
    finally:
        spark.sql("DROP DATABASE ns_lakeloom CASCADE")
