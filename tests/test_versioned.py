"""Copy-on-write updates: touched files only, versions, lost writes."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventide.sources.versioned import VersionedTable


def test_updates_touch_few_files(spark, scratch):
    df = spark.range(4000).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 5 > 0, F.lit("a")).alias("s"))
    t = VersionedTable(spark, f"{scratch}/t")
    with pytest.raises(ValueError):
        t.read()
    assert t.create(df.repartitionByRange(8, "id")) == 0
    before = set(t._manifest(None)[1])
    assert len(before) == 8
    assert t.update((F.col("id") < 300) & (F.col("v") == 3), "s", None) == 1
    after = set(t._manifest(None)[1])
    assert len(before & after) == 7 and len(after - before) >= 1            # untouched files keep their names
    want = df.withColumn("s", F.when((F.col("id") < 300) & (F.col("v") == 3), F.lit(None)).otherwise(F.col("s")))
    assert rows(t.read()) == rows(want) and rows(t.read(0)) == rows(df)
    assert t.update(F.col("v") == 99, "s", "z") == 1                        # nothing to change, nothing written
    assert t.update(F.col("s").isNull() & (F.col("id") >= 3900), "v", 70) == 2
    assert t.delete(F.col("id") >= 3990) == 3 and t.append(df.where("id >= 3995")) == 4
    got = t.read()
    assert got.count() == 3995 and got.where("v = 70").agg(F.min("id")).first()[0] == 3900 and got.where("id >= 3995 and v = 70").count() == 0
    with pytest.raises(ValueError):
        t.create(df)


def test_a_lost_write_leaves_the_version_before(spark, scratch):
    df = spark.range(100).select("id", F.lit(1).alias("v"))
    t = VersionedTable(spark, f"{scratch}/t")
    t.create(df.repartitionByRange(4, "id"))
    real, t._commit = t._commit, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        t.update(F.col("id") == 5, "v", 2)
    t._commit = real
    assert t.versions() == [0] and rows(t.read()) == rows(df)
    os.makedirs(f"{scratch}/t/manifests/version=1/_temporary/0")             # a manifest that was never finished
    assert t.update(F.col("id") == 5, "v", 2) == 2 and t.versions() == [0, 2]
    assert t.read().where("v = 2").count() == 1 and t.read(0).where("v = 2").count() == 0
    empty = VersionedTable(spark, f"{scratch}/e")
    empty.create(df.where("false"))
    assert empty.read().count() == 0 and empty.update(F.col("id") == 1, "v", 2) == 0 and empty.append(df) == 1 and empty.read().count() == 100
