"""Rows held until their window closes, two aggregations in a row, functions of
whole windows, stored distinct sketches."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import rows
from eventide.operators import sketches, windows as batch
from eventide.plans.catalog import median_of
from eventide.streaming import windows
from eventide.streaming.runner import event_stream, start_to_parquet
from test_streaming import SPARK_SCHEMA, _write_files

T0 = 1_704_067_200_000_000


def _stream(spark, src, out, build, **kw):
    q = start_to_parquet(build(event_stream(spark, src, spark.createDataFrame([], SPARK_SCHEMA).schema, max_files_per_trigger=1, **kw)),
                         f"{out}/data", f"{out}/chk")
    q.awaitTermination()
    assert q.exception() is None, q.exception()
    return q, spark.read.parquet(f"{out}/data")


def _events(n):
    return [(f"k{i % 3}", T0 + i * 700_000, None if i % 5 == 0 else 9_007_199_254_740_993 + i, i % 7, "ab"[i % 2]) for i in range(n)]


def _frame(spark, data):
    return spark.createDataFrame([(k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), s, v, e) for k, t, s, v, e in data], SPARK_SCHEMA)


def test_rows_come_out_when_their_window_closes(spark, scratch):
    data = _events(60)                                       # 42 s
    late = [("late", T0 + 3_000_000, 1, 1, "x"), ("open", T0 + 41_000_000, 2, 2, "x")]   # first window closed, last one open
    src = f"{scratch}/src"
    _write_files(src, [data[:20], data[20:60]])
    build = lambda s: windows.rows_on_close(s, "ts", "10 seconds", parts=3)
    _, got = _stream(spark, src, scratch, build)
    closed = [r for r in data if r[1] < T0 + 40_000_000]
    assert got.count() == len(closed)
    _write_files(src, [data[:20], data[20:60], late, [("zz", T0 + 10**12, 0, 0, "x")]])
    q, got = _stream(spark, src, scratch, build)             # goes on from its checkpoint
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]) == 1
    want = batch.tag_rows(_frame(spark, data + late[1:]), "ts", "10 seconds")
    cols = ("k", "ts", "seq", "v", "e", "window_start", "window_end")
    assert rows(got, *cols) == rows(want, *cols)


def test_two_state_operators_both_emit(spark, scratch):
    data = _events(90)
    src = f"{scratch}/src"
    _write_files(src, [data[:40], data[40:], [("zz", T0 + 10**12, 0, 0, "x")]])
    q, got = _stream(spark, src, scratch, lambda s: windows.two_stage_windows(s, "ts", "5 seconds", "20 seconds", "k"))
    assert any(len(p["stateOperators"]) == 2 and all(o["numRowsRemoved"] > 0 for o in p["stateOperators"]) for p in q.recentProgress)
    want = batch.two_stage_windows(_frame(spark, data), "ts", "5 seconds", "20 seconds", "k")
    assert rows(got) == rows(want) and want.count() == 4


def test_function_of_a_window_in_batches(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.timestamp_seconds(F.col("id") % 30).alias("ts"),
                                  F.when(F.col("id") % 11 > 0, F.col("id") * 7919 % 1000).alias("v"))
    df = df.unionByName(spark.createDataFrame([(0, None, 5)], df.schema))       # no time: in no window
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = rows(batch.apply_to_windows(df, "ts", "10 seconds", median_of("v"), "n bigint, median double", "k"))
        want = rows(df.where("ts is not null").groupBy(F.window("ts", "10 seconds").alias("w"), "k")
                    .agg(F.count("v").alias("n"), F.expr("percentile(v, 0.5)").alias("median")).select("w.start", "w.end", "k", "n", "median"))
        assert got == want and len(got) == 6

        def sizes(batches):
            given = [b.num_rows for b in batches]
            yield pa.RecordBatch.from_arrays([pa.array([max(given)]), pa.array([len(given)])], names=["most", "batches"])

        # columns by name, whatever their order; several batches a window
        out = batch.apply_to_windows(df, "ts", "10 seconds", sizes, "batches bigint, most bigint").collect()
        assert len(out) == 3 and all(r.most <= 100 and r.batches >= 16 for r in out)
        empty = batch.apply_to_windows(df.where("false"), "ts", "10 seconds", median_of("v"), "n bigint, median double")
        assert empty.count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_daily_sketches_unite(spark):
    df = spark.range(30000).select((F.col("id") * 7 % 4000).alias("u"), F.timestamp_seconds(F.col("id") % 10 * 86400).alias("ts"), (F.col("id") % 2).alias("g"))
    df = df.unionByName(spark.createDataFrame([(None, dt.datetime(1970, 1, 3), 0), (5, None, 0)], df.schema))
    stored = sketches.daily_distinct(df, "u", "ts", ["g"])
    assert stored.count() == 10
    for first, last in ((None, None), ("1970-01-02", "1970-01-04"), ("1999-01-01", None)):
        r = sketches.distinct_in_range(stored, first, last).first()
        own = df.where("ts is not null")
        own = own.where(F.col("ts") >= F.lit(first)) if first else own
        own = own.where(F.to_date("ts") <= F.lit(last).cast("date")) if last else own
        exact = own.agg(F.count_distinct("u"), F.count(F.lit(1))).first()
        assert r.rows == exact[1] and abs(r.cardinality - exact[0]) <= sketches.error_bound() * exact[0]
    by = {r.g: r.cardinality for r in sketches.distinct_in_range(stored, by=["g"]).collect()}
    exact = {r.g: r.n for r in df.where("ts is not null").groupBy("g").agg(F.count_distinct("u").alias("n")).collect()}
    assert all(abs(by[g] - n) <= sketches.error_bound() * n for g, n in exact.items())
    text = sketches.distinct_in_range(sketches.daily_distinct(df.withColumn("u", F.col("u") / 3), "u", "ts")).first()
    assert abs(text.cardinality - 4000) <= sketches.error_bound() * 4000
