"""Running reduce by user-defined associative functions, batch and stream."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventide.operators import reducers as R
from eventide.plans.catalog import best_so_far, product_modulo
from eventide.streaming import keyed_table as K
from eventide.streaming.runner import event_stream
from test_streaming import SPARK_SCHEMA, _events, _write_files


def text():
    """Joins words: associative, far from commutative."""
    return R.Reducer({"s": ("string", F.coalesce(F.col("e"), F.lit("")))}, lambda a, b: {"s": a["s"] + b["s"]})


def _slow(data):
    state, out = {}, []
    for k, _t, s, v, e in sorted(data, key=lambda r: r[2]):
        p, best, at, n, t = state.get(k, (1, -10**9, None, 0, ""))
        best, at = (v, s) if v > best else (best, at)
        state[k] = p, best, at, n, t = p * (v + 7) % 1_000_003, best, at, n + 1, t + e
        out.append((s, p, best, at, n, t))
    return sorted(out)


def _got(df):
    return sorted((r.seq, r.p.p, r.b.best, r.b.at, r.b.n, r.t.s) for r in df.collect())


@pytest.mark.parametrize("n_buckets,batch", [(1, 10_000), (5, 3), (40, 7)])
def test_running_reduce_equals_a_loop(spark, n_buckets, batch):
    data = _events(n_keys=1, n=50, seed=1) + [(None, t, 100 + s, v, e) for _, t, s, v, e in _events(n_keys=1, n=20, seed=2)] + [("one", 0, 500, 3, "x")]
    df = spark.createDataFrame([(k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), s, v, e) for k, t, s, v, e in data], SPARK_SCHEMA).repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))      # groups go on over batches
    try:
        out = R.running_reduce(df, "k", "seq", product_modulo(F.col("v") + 7), "p", n_buckets)
        out = R.running_reduce(out, "k", "seq", best_so_far("v", "seq"), "b", n_buckets)
        out = R.running_reduce(out, "k", "seq", text(), "t", n_buckets)
        assert out.columns == [*df.columns, "p", "b", "t"] and _got(out) == _slow(data)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_scan_by_doubling():
    group = np.array([0, 0, 0, 1, 2, 2, 2, 2, 2])
    got = R.scanned({"s": np.array(list("abcdefghi"), object)}, group, lambda a, b: {"s": a["s"] + b["s"]})["s"]
    assert got.tolist() == ["a", "ab", "abc", "d", "e", "ef", "efg", "efgh", "efghi"]


def test_empty_and_null_contributions(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 4)], "k string, seq bigint, v bigint")
    assert R.running_reduce(df.where("false"), "k", "seq", best_so_far("v", "seq")).count() == 0
    with pytest.raises(Exception, match="neutral"):
        R.running_reduce(df, "k", "seq", R.Reducer({"x": ("bigint", F.col("v"))}, lambda a, b: {"x": a["x"] + b["x"]})).collect()


def test_stream_equals_a_loop(spark, scratch):
    data = _events(n_keys=2, n=40, seed=6)
    src = f"{scratch}/src"
    _write_files(src, [data[:25], data[25:]])

    def run(name, reducer):
        stream = event_stream(spark, src, spark.createDataFrame([], SPARK_SCHEMA).schema, delay=None, max_files_per_trigger=1)
        q = K.running_reduce_by(stream.select("k", "seq", "v", "e"), f"{scratch}/{name}", f"{scratch}/{name}-c", "k", "seq", reducer, name, buckets=4, n_buckets=3)
        q.awaitTermination()
        assert q.exception() is None, q.exception()
        return spark.read.parquet(f"{scratch}/{name}/rows/batch=*").select("seq", name)

    out = run("p", product_modulo(F.col("v") + 7)).join(run("b", best_so_far("v", "seq")), "seq").join(run("t", text()), "seq")
    assert _got(out) == _slow(data)
