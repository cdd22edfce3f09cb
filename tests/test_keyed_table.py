"""Keyed streams over a state table: a key with 90 % of the rows, several
micro-batches, restarts, redone batches; all equal to the batch operators."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventide.operators import keyed, patterns, timeout
from eventide.streaming import keyed_table as K
from eventide.streaming.runner import event_stream

SCHEMA = pa.schema([("k", pa.string()), ("ts", pa.timestamp("us")), ("seq", pa.int64()), ("v", pa.int64()), ("e", pa.string())])
SPARK_SCHEMA = "k string, ts timestamp_ntz, seq bigint, v bigint, e string"
def _stages():
    return [F.col("e") == x for x in "abc"]


GAP, WITHIN = 60_000_000, 300_000_000


def _events(n, seed):
    rnd, t, out = random.Random(seed), -3_000_000_000, []       # event times before 1970, too
    for i in range(n):
        t += rnd.choice([1, 2, 30, 61, 90]) * 1_000_000
        key = "hot" if rnd.random() < 0.9 else rnd.choice([None, "b", "c"])
        out.append((key, t, i, rnd.choice([None, *range(-5, 9)]), rnd.choice("abcx")))
    return out


def _write(folder, chunks):
    os.makedirs(folder, exist_ok=True)
    for i, chunk in enumerate(chunks):
        chunk = list(chunk)
        random.Random(i).shuffle(chunk)
        cols = list(zip(*chunk)) if chunk else [()] * len(SCHEMA)
        path = f"{folder}/part-{len(os.listdir(folder)):04d}.parquet"
        pq.write_table(pa.table({f.name: pa.array(c, f.type) for f, c in zip(SCHEMA, cols)}, schema=SCHEMA), path)
        at = 1_700_000_000 + len(os.listdir(folder))
        os.utime(path, (at, at))


CASES = {
    "reduce": (lambda s, p, c: K.running_reduce(s, p, c, "k", "seq", "v", buckets=4, n_buckets=4),
               lambda d: keyed.running_reduce(d.select("k", "seq", "v"), "k", "seq", "v"), ("k", "seq", "v", "running_sum")),
    "reduce_count": (lambda s, p, c: K.running_reduce(s, p, c, "k", "seq", "v", op="count", buckets=4, n_buckets=4),
                     lambda d: keyed.running_reduce(d.select("k", "seq", "v"), "k", "seq", "v", op="count"), ("k", "seq", "running_sum")),
    "count_window": (lambda s, p, c: K.count_window_avg(s, p, c, "k", "seq", "v", 4, buckets=4, n_buckets=4),
                     lambda d: keyed.count_window_avg(d, "k", "seq", "v", 4), ("k", "window_idx", "avg_value", "first_seq", "last_seq")),
    "timeout": (lambda s, p, c: K.inactivity_timeout(s, p, c, "k", "ts", "seq", GAP, buckets=4, n_buckets=4),
                lambda d: timeout.inactivity_timeout(d, "k", "ts", "seq", GAP), ("k", "count", "last_ts", "fire_ts")),
    "pattern_within": (lambda s, p, c: K.sequence_match_stream(s, p, c, _stages(), "ts", "seq", "seq", "k", buckets=4, n_buckets=4, within_us=WITHIN),
                       lambda d: patterns.sequence_match(d, _stages(), "ts", "seq", "seq", key="k", within_us=WITHIN), ("k", "id0", "id1", "id2")),
}


def _run(spark, src, out, build):
    q = build(event_stream(spark, src, spark.createDataFrame([], SPARK_SCHEMA).schema, delay=None, max_files_per_trigger=1), f"{out}/sink", f"{out}/chk")
    q.awaitTermination()
    assert q.exception() is None, q.exception()
    return spark.read.option("basePath", f"{out}/sink/rows").parquet(f"{out}/sink/rows/batch=*")


def _ntz(df):
    for c, t in df.dtypes:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz")) if t == "timestamp" else df
    return df


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_key_equals_batch(spark, scratch, name):
    build, batch, cols = CASES[name]
    data = _events(120, 3)
    sentinel = ("zz", data[-1][1] + 10**12, 10**6, 0, "x")
    _write(f"{scratch}/src", [data[:50], data[50:100]])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _run(spark, f"{scratch}/src", scratch, build)
        _write(f"{scratch}/src", [data[100:], [sentinel]])        # goes on from the checkpoint and the table
        got = _run(spark, f"{scratch}/src", scratch, build)
        hot = got.withColumn("file", F.input_file_name()).where("k = 'hot'").groupBy("batch").agg(F.count_distinct("file").alias("files"))
        assert hot.agg(F.max("files")).first()[0] > 1               # one key's rows left several tasks
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    import datetime as dt
    whole = spark.createDataFrame([(k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), s, v, e) for k, t, s, v, e in data], SPARK_SCHEMA)
    want = rows(batch(whole), *cols)
    assert rows(_ntz(got.where("k is null or k <> 'zz'")), *cols) == want and len(want) > 8


def test_redone_batches_and_untouched_buckets(spark, scratch):
    data = _events(60, 4)
    schema = spark.createDataFrame([], SPARK_SCHEMA).schema
    make = lambda part: spark.createDataFrame(part, "k string, us bigint, seq bigint, v bigint, e string").select(
        "k", F.timestamp_micros("us").alias("ts"), "seq", "v", "e").select(*schema.fieldNames())
    sink = K.TimeoutTable(f"{scratch}/t", "k", "ts", "seq", GAP, 0, 16, 4)
    first, second = make(data[:30]), make(data[30:])
    sink(first, 0)
    sink(first, 0)                                  # delivered again: skipped
    sink(second, 1)
    before = rows(spark.read.parquet(f"{scratch}/t/rows/batch=1"))
    # a batch that failed before its marker is redone from the state it first saw
    twin = K.TimeoutTable(f"{scratch}/u", "k", "ts", "seq", GAP, 0, 16, 4)
    twin(first, 0)
    real, K.commit = K.commit, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            twin(second, 1)
    finally:
        K.commit = real
    twin(second, 1)
    assert rows(spark.read.parquet(f"{scratch}/u/rows/batch=1")) == before
    # only the buckets of a batch's keys, and those that are due, are rewritten
    run = K.RunningReduceTable(f"{scratch}/r", "k", "seq", "v", "s", "sum", 16, 4)
    run(make([("b", 0, 0, 1, "x"), ("c", 0, 1, 1, "x"), ("hot", 0, 2, 1, "x")]), 0)
    run(make([("b", 0, 3, 1, "x")]), 1)
    marker = K.last_commit(spark, f"{scratch}/r/_state", K._MARKER)
    assert sorted(v // 2 for v in marker.written.values()) in ([0, 0, 1], [0, 1])
    # late rows and rows without a time are counted
    sink(make([("b", data[0][1], 999, 1, "x"), ("b", None, 1000, 1, "x")]), 2)
    assert K.dropped_rows(spark, f"{scratch}/t") == 2


def test_on_time_and_late_rows_add_up(spark, scratch):
    schema = spark.createDataFrame([], SPARK_SCHEMA).schema
    t0 = 1_704_067_200_000_000
    data = [("ab"[i % 2], t0 + i * 1_000_000, i, i, "x") for i in range(50)]
    late = [("a", t0 + 2_000_000, 100, 1000, "x"), ("b", t0 + 47_000_000, 101, 2000, "x"), ("a", None, 102, 4000, "x")]     # closed, open, no time
    _write(f"{scratch}/src", [data[:30], data[30:], late])

    def run():
        q = K.tumbling_sum(event_stream(spark, f"{scratch}/src", schema, delay=None, max_files_per_trigger=1), f"{scratch}/sink", f"{scratch}/chk",
                           "ts", "10 seconds", "v", ["k"], buckets=4)
        q.awaitTermination()
        assert q.exception() is None, q.exception()

    run()
    _write(f"{scratch}/src", [[("zz", t0 + 10**12, 0, 0, "x")]])
    run()
    got = spark.read.parquet(f"{scratch}/sink/rows/batch=*")
    kept = spark.read.parquet(f"{scratch}/sink/late/batch=*")
    assert rows(kept, "v") == [(1000,), (4000,)] and K.dropped_rows(spark, f"{scratch}/sink") == 2
    whole = spark.createDataFrame([(k, t, v) for k, t, _, v, _ in data + late[1:2]], "k string, us bigint, v bigint")
    want = whole.groupBy(F.window(F.timestamp_micros("us"), "10 seconds").alias("w"), "k").agg(F.count("v").alias("n"), F.sum("v").alias("s"))
    assert rows(got, "window_start", "window_end", "k", "n", "sum_value") == rows(want.select("w.start", "w.end", "k", "n", "s"))
