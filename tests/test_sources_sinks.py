"""Scans and sinks: wildcard scan with a type filter, JSON lines, bundle,
overwrite text sink, bounded driver iteration."""

from pyspark.sql import functions as F

from conftest import rows
from eventide.sources import sinks
from eventide.sources.tables import full_scan, iterate_rows, wildcard_scan


def _write_datasets(spark, root):
    a = spark.createDataFrame([("a1", "email", 1), ("a2", "sms", 2)], "id string, type string, n int")
    b = spark.createDataFrame([("b1", "email", 3)], "id string, type string, n int")
    other = spark.createDataFrame([("x1", "email", 9)], "id string, type string, n int")
    a.write.parquet(f"{root}/saas_a")
    b.write.parquet(f"{root}/saas_b")
    other.write.parquet(f"{root}/ops_x")


def test_wildcard_scan_and_type_filter(spark, scratch):
    _write_datasets(spark, scratch)
    emails = wildcard_scan(spark, f"{scratch}/saas_*", "email")
    assert rows(emails, "id", "_dataset") == [("a1", "saas_a"), ("b1", "saas_b")]
    one = spark.read.parquet(f"{scratch}/saas_b").coalesce(1)
    one.write.parquet(f"{scratch}/single+1.parquet")
    named = wildcard_scan(spark, f"{scratch}/s*", "*").groupBy("_dataset").count()
    assert rows(named) == [("saas_a", 2), ("saas_b", 1), ("single+1", 1)]
    every = wildcard_scan(spark, f"{scratch}/saas_*", "*")
    assert rows(every, "id") == [("a1",), ("a2",), ("b1",)]
    assert full_scan(every, F.col("n") > 1).count() == 2


def test_json_lines_bundle_and_text_overwrite(spark, scratch):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, s string")
    sinks.write_json_lines(df, f"{scratch}/dump")
    back = spark.read.schema("id int, s string").json(f"{scratch}/dump")
    assert rows(back) == rows(df)

    total = sinks.bundle(df.where("id > 1"), f"{scratch}/bundle")
    assert total == 2
    assert spark.read.json(f"{scratch}/bundle/total").collect()[0].total == 2
    assert sorted(r.id for r in spark.read.json(f"{scratch}/bundle/data").collect()) == [2, 3]

    sinks.write_text_overwrite(df, f"{scratch}/txt", "s")
    sinks.write_text_overwrite(df.where("id = 3"), f"{scratch}/txt", "s")
    assert [r.value for r in spark.read.text(f"{scratch}/txt").collect()] == ["z"]

    assert [r.line for r in sinks.json_lines(df.where("id = 1")).collect()] == ['{"id":1,"s":"x"}']


def test_iterate_rows_streams_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7)
    assert sum(r.id for r in iterate_rows(df)) == sum(range(1000))
