"""Bucketed prefix scans equal plain single-partition windows (brute force),
including a key holding most rows, NULL keys, ties and few/many buckets."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from eventide.operators import keyed, patterns, timeout, windows

row_st = st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2, None]),   # key 0 is hot
                   st.integers(0, 40),                          # event time (s), many ties
                   st.integers(-50, 50),                        # value
                   st.sampled_from(["a", "b", "c", "x"]))


def _df(spark, data):
    tagged = [(k, t, v, e, i) for i, (k, t, v, e) in enumerate(data)]
    df = spark.createDataFrame(tagged, "k bigint, t bigint, v bigint, e string, seq bigint")
    return df.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))


SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
# None: the default number of buckets, more than there are rows
NB = st.one_of(st.none(), st.integers(1, 6))


@settings(**SETTINGS)
@given(st.lists(row_st, min_size=1, max_size=40), NB)
def test_running_and_count_windows(spark, data, nb):
    df = _df(spark, data)
    got = rows(keyed.running_reduce(df, "k", "seq", "v", n_buckets=nb), "seq", "running_sum")
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    assert got == rows(df.withColumn("running_sum", F.sum("v").over(w)), "seq", "running_sum")
    got = rows(keyed.count_window_avg(df, "k", "seq", "v", n=3, n_buckets=nb))
    rn = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("seq")))
    ref = (rn.groupBy("k", F.expr("(rn - 1) div 3").alias("window_idx"))
             .agg(F.count("*").alias("c"), F.sum("v").alias("s"), F.min("seq").alias("first_seq"),
                  F.max("seq").alias("last_seq"))
             .where("c = 3").select("k", "window_idx", F.expr("s div 3").alias("avg_value"),
                                     "first_seq", "last_seq"))
    assert got == rows(ref)


@settings(**SETTINGS)
@given(st.lists(row_st, min_size=1, max_size=40), NB)
def test_timeout_and_watermark(spark, data, nb):
    df = _df(spark, data)
    got = rows(timeout.inactivity_timeout(df, "k", "ts", "seq", 5_000_000, n_buckets=nb))
    w = Window.partitionBy("k").orderBy("ts", "seq")
    ref = (df.withColumn("count", F.row_number().over(w).cast("bigint"))
             .withColumn("nxt", F.lead("ts").over(w))
             .where(F.col("nxt").isNull() | (F.col("nxt") > F.col("ts") + F.expr("INTERVAL 5 SECONDS")))
             .select("k", "count", F.col("ts").alias("last_ts"),
                     (F.col("ts") + F.expr("INTERVAL 5 SECONDS")).alias("fire_ts")))
    assert got == rows(ref)
    got = rows(windows.watermark_trace(df, "ts", "seq", n_buckets=nb), "seq", "watermark", "is_late")
    wg = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ref = (df.withColumn("watermark", F.max("ts").over(wg))
             .withColumn("is_late", F.coalesce(F.col("ts") <= F.col("watermark"), F.lit(False))))
    assert got == rows(ref, "seq", "watermark", "is_late")


def _brute_matches(data, within=None):
    """Reference semantics, written directly: for each start, first later
    middle, then first later end (order = (time, seq)), per key."""
    tagged = sorted(((k, t, i, e) for i, (k, t, _v, e) in enumerate(data)), key=lambda r: (r[1], r[2]))
    out = []
    for k, t, i, e in tagged:
        if e != "a":
            continue
        later = [r for r in tagged if r[0] == k and (r[1], r[2]) > (t, i)]
        mid = next((r for r in later if r[3] == "b"), None)
        if mid is None:
            continue
        end = next((r for r in later if (r[1], r[2]) > (mid[1], mid[2]) and r[3] == "c"), None)
        if end is not None and (within is None or end[1] - t <= within):
            out.append((k, i, mid[2], end[2]))
    return sorted(out, key=repr)


@settings(**SETTINGS)
@given(st.lists(row_st, min_size=1, max_size=40), NB)
def test_sequence_match_brute_force(spark, data, nb):
    df = _df(spark, data)
    stg = [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"]
    got = rows(patterns.sequence_match(df, stg, "ts", "seq", "seq", key="k", n_buckets=nb),
               "k", "id0", "id1", "id2")
    assert got == _brute_matches(data)


@settings(**SETTINGS)
@given(st.lists(row_st, min_size=1, max_size=40), NB, st.integers(0, 30))
def test_sequence_match_within_brute_force(spark, data, nb, within_s):
    df = _df(spark, data)
    stg = [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"]
    got = rows(patterns.sequence_match(df, stg, "ts", "seq", "seq", key="k", n_buckets=nb,
                                       within_us=within_s * 1_000_000),
               "k", "id0", "id1", "id2")
    assert got == _brute_matches(data, within_s)


SPREAD = {
    "outlier": "case when id = 0 then 1000000000000 else id end",
    "two_values": "id % 2",
    "half_null": "case when id % 2 = 0 then null else id end",
    "text": "concat('name ', cast(id * 7919 % 1000 as string))",
    "skewed_text": "case when id % 3 > 0 then 'hot' else cast(id as string) end",
    "decimal": "cast(id % 13 as decimal(20, 3)) / 7",
}


@pytest.mark.parametrize("name", sorted(SPREAD))
@pytest.mark.parametrize("asc", [True, False])
def test_buckets_are_even_for_any_distribution(spark, name, asc):
    from eventide.plans import prefix
    df = spark.range(0, 20000, 1, 5).selectExpr(f"{SPREAD[name]} as v", "id")
    sizes = [r["count"] for r in prefix.with_buckets(df, [("v", asc), "id"], 20).groupBy(prefix.BUCKET).count().collect()]
    assert sum(sizes) == 20000 and max(sizes) <= 3 * 1000, sizes
    # buckets follow the order
    edge = prefix.with_buckets(df, [("v", asc), "id"], 20)
    w = Window.orderBy(*prefix.sort_columns([("v", asc), "id"]))
    assert edge.withColumn("back", F.col(prefix.BUCKET) < F.lag(prefix.BUCKET).over(w)).where("back").count() == 0


def test_a_hot_key_is_spread(spark):
    from eventide.plans import prefix
    df = spark.range(0, 20000, 1, 5).selectExpr("case when id % 10 > 0 then 'hot' else cast(id as string) end as k", "id")
    b, kcols, _ = prefix.prepare(df, ["k"], ["id"], 20)
    rows_of = b.where("k = 'hot'").groupBy(prefix.BUCKET).count().collect()
    assert len(rows_of) >= 15 and max(r["count"] for r in rows_of) <= 3000


def test_row_numbers_over_text_and_reduce_operators(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"n{i * 37 % 11}", float(i % 4)) for i in range(60)], "id bigint, s string, v double")
    got = rows(keyed.row_numbers(df, [], [("s", False), "id"], n_buckets=7), "id", "rn")
    w = Window.orderBy(F.col("s").desc_nulls_last(), "id")
    assert got == rows(df.withColumn("rn", F.row_number().over(w).cast("bigint")), "id", "rn")
    for op, fn in (("max", F.max), ("min", F.min), ("count", F.count), ("sum", F.sum)):
        got = rows(keyed.running_reduce(df, "s", "id", "v", n_buckets=4, op=op), "id", "running_sum")
        wk = Window.partitionBy("s").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
        assert got == rows(df.withColumn("running_sum", fn("v").over(wk)), "id", "running_sum")


def test_ties_are_spread(spark):
    """A third of the rows tie on every order column: they fill many buckets,
    and running values, row numbers and next matches stay right."""
    from eventide.plans import prefix
    df = spark.range(0, 12000, 1, 5).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id % 7) end as k",
                                                "case when id % 3 = 0 then 5 else id end as t", "id", "cast(id % 11 as bigint) as v")
    b, kcols, _ = prefix.prepare(df, ["k"], ["t"], 12)
    own = [r["count"] for r in b.where("k = 'hot'").groupBy(prefix.BUCKET).count().collect()]
    assert len(own) >= 4 and max(own) <= 3 * 1000, own
    got = keyed.running_reduce(df, "k", "t", "v", n_buckets=12)
    assert got.columns == [*df.columns, "running_sum"]
    hot = got.where("k = 'hot'")
    assert hot.agg(F.max("running_sum")).first()[0] == df.where("k = 'hot'").agg(F.sum("v")).first()[0]
    rn = keyed.row_numbers(df, [], ["t"], n_buckets=12)
    assert rn.select("rn").distinct().count() == 12000
    w = Window.orderBy("rn")
    assert rn.withColumn("back", F.col("t") < F.lag("t").over(w)).where("back").count() == 0
    fires = timeout.inactivity_timeout(df.withColumn("ts", F.timestamp_seconds("t")), "k", "ts", "id", 10**15, n_buckets=12)
    assert rows(fires, "k", "count") == rows(df.groupBy("k").count(), "k", "count")


def test_no_ties_no_row_hash(spark):
    from eventide.plans import prefix
    df = spark.range(0, 5000, 1, 3).selectExpr("id % 10 as k", "id", "map(1, id) as m")
    assert prefix.TIE not in prefix.with_buckets(df, ["k", "id"], 16).columns
    tied = prefix.with_buckets(df, ["k"], 16)
    assert prefix.TIE in tied.columns and tied.groupBy(prefix.BUCKET).count().count() == 16
