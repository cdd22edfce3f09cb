"""Search-style predicates, aggregations, paging and updates."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from eventide.functions import predicates as P
from eventide.functions.text import match, query_tokens
from eventide.operators import aggregates as A
from eventide.operators import ordering, updates, windows
from eventide.sources.lines import good_rows, parse_json_lines, split_key_value

EMAILS = [
    ("e1", "email", "Electrical Technician", "上海", "21644", 1000),
    ("e2", "email", "Techniciansx", "北京", "9", 2000),
    ("e3", "email", "Software Engineer", None, "100", 3000),
    ("e4", "email", "technician", "镇江", "x1", 4000),
    ("e5", "email", "技术员Technician", "镇江市", "55", 5000),
    ("e6", "other", "Technician", "Paris", "7", 6000),
]
EMAIL_SCHEMA = "id string, type string, role string, location string, size string, occur_time bigint"


def test_match_whole_tokens_and_cjk(spark):
    df = spark.createDataFrame(EMAILS, EMAIL_SCHEMA)
    got = [r.id for r in df.where(match("role", "Technician")).orderBy("id").collect()]
    assert got == ["e1", "e4", "e5", "e6"]
    assert query_tokens("镇江 Data") == ["镇", "江", "data"]


def test_bool_must_not_keeps_missing_fields(spark):
    df = spark.createDataFrame(EMAILS, EMAIL_SCHEMA).where(P.term("type", "email"))
    q = P.bool_query(must_=[match("role", "Technician")], must_not_=[match("location", "镇江")])
    assert [r.id for r in df.where(q).collect()] == ["e1"]
    q2 = P.bool_query(must_=[match("role", "engineer")], must_not_=[match("location", "镇江")])
    assert [r.id for r in df.where(q2).collect()] == ["e3"]  # NULL location survives


def test_sort_by_numeric_size_text(spark):
    df = spark.createDataFrame(EMAILS, EMAIL_SCHEMA).withColumn("size_n", F.col("size").try_cast("bigint"))
    out = ordering.sort_by(df, [("size_n", False), ("id", True)]).collect()
    assert [r.id for r in out] == ["e1", "e3", "e5", "e2", "e6", "e4"]  # numeric order, NULL last


def test_terms_top_n_ties_and_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",), (None,), (None,), (None,)], "k string")
    assert rows(A.terms(df, "k", 2), "k", "doc_count") == [("b", 2), ("c", 2)]


def test_avg_or_zero_on_empty(spark):
    df = spark.createDataFrame([(1.0,)], "v double").where("v > 5")
    assert A.avg_or_zero(df, "v").collect()[0].avg_value == 0.0


def test_cardinality_ignores_nulls_and_counts_all_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "u bigint")
    r = A.cardinality(df, "u", exact=True).collect()[0]
    assert (r.cardinality, r.total) == (3, 5)
    r = A.cardinality(df, "u").collect()[0]
    assert (r.cardinality, r.total) == (3, 5)
    assert A.cardinality_check(df, "u").collect()[0].within_5pct is True
    r = A.cardinality(df.where("u > 10"), "u", exact=True).collect()[0]
    assert (r.cardinality, r.total) == (0, 0)


def test_range_is_inclusive_and_exists_counts_empty(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x"), (4, "y")], "t bigint, s string")
    assert [r.t for r in df.where(P.range_between("t", 2, 3)).orderBy("t").collect()] == [2, 3]
    assert [r.t for r in df.where(P.exists("s")).orderBy("t").collect()] == [1, 3, 4]


def test_date_histogram_fills_gaps(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01",), ("2024-01-01 00:00:01",), ("2024-01-01 00:00:04",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    for per in (1, 3, 1000):                      # chunks of 1 and 3 buckets, and one chunk
        out = A.date_histogram(df, "ts", 1_000_000, chunk_buckets=per).orderBy("bucket_start").collect()
        assert [r.doc_count for r in out] == [2, 0, 0, 1]
        assert out[0].bucket_start.second == 1


def test_histogram_top_terms_include(spark):
    data = [("2024-01-01 00:00:00", u) for u in ["a", "a", "a", "b", "b", "c"]]
    df = spark.createDataFrame(data, "t string, u string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    out = A.histogram_top_terms(df, "ts", 86_400_000_000, "u", 5, include=["b", "c"])
    assert rows(out, "u", "doc_count", "rank") == [("b", 2, 1), ("c", 1, 2)]


def test_terms_and_avg_grouping_sets(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 4.0)], "k string, v double")
    got = rows(A.terms_and_avg(df, "k", "v"), "k", "is_total", "doc_count", "avg_value")
    assert got == sorted([("x", False, 2, 1.5), ("y", False, 1, 4.0), (None, True, 3, 7.0 / 3)], key=repr)


def test_paginate_ties_across_buckets(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "id bigint, price double")
    out = ordering.paginate(df, [("price", False), ("id", True)], 8, n_buckets=3)
    expect = sorted(((i, float(i % 7)) for i in range(50)), key=lambda r: (-r[1], r[0]))
    got = sorted(out.collect(), key=lambda r: r.rn)
    assert [(r.id, r.price) for r in got] == expect
    assert [r.page for r in got] == [(n - 1) // 8 for n in range(1, 51)]


def test_conditional_update_and_backfill(spark):
    df = spark.createDataFrame([(1, "s1", ""), (2, "s1", "x"), (3, "s2", "")], "id int, sid string, sc string")
    upd = updates.conditional_update(df, P.must(P.term("sid", "s1"), P.term("sc", "")), "sc", None)
    assert rows(upd, "id", "sc") == [(1, None), (2, "x"), (3, "")]
    dst = spark.createDataFrame([(1, None), (2, "d2")], "id int, v string")
    src = spark.createDataFrame([(1, "s1"), (3, "s3")], "id int, v string")
    assert rows(updates.backfill(dst, src, "id")) == [(1, "s1"), (2, "d2"), (3, "s3")]


def test_split_key_value_quarantines_bad_lines(spark):
    df = spark.createDataFrame([("a 1",), ("b",), ("c x",), ("d  2",), ("e 3",)], "line string")
    out = split_key_value(df)
    assert rows(out, "key", "value", "bad") == [("a", 1, False), ("b", None, True), ("c", None, True),
                                                 ("d", None, True), ("e", 3, False)]
    more = spark.createDataFrame([("c 3 extra",), ("x",), (None,)], "line string")
    seen = Observation("bad")
    good = good_rows(split_key_value(more), seen)
    assert rows(good, "key", "value") == [("c", 3)] and seen.get["bad_lines"] == 2


def test_failfast_fails(spark):
    df = spark.createDataFrame([("a 1",), ("c x",)], "line string")
    with pytest.raises(Exception, match="malformed line: c x"):
        split_key_value(df, failfast=True).select("value").collect()
    good = spark.createDataFrame([("a 1",)], "line string")
    assert split_key_value(good, failfast=True).select("key", "value").collect() == [("a", 1)]


def test_json_lines_flag_only_what_does_not_parse(spark):
    lines = ['{"id":1,"t":2}', '{"other":5}', "{}", '{"id":null,"t":null}', '{"id":1,"t":"abc"}', "no json", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, line string")
    got = parse_json_lines(df, "id bigint, t bigint").orderBy("n").collect()
    assert [(r.id, r.t) for r in got[:4]] == [(1, 2), (None, None), (None, None), (None, None)]
    assert [r._corrupt for r in got] == [None, None, None, None, lines[4], lines[5], None]
    assert got[4].id == 1


def test_backfill_keeps_null_keys_apart(spark):
    dst = spark.createDataFrame([(1, "d"), (None, "n1")], "k int, v string")
    src = spark.createDataFrame([(1, None), (None, "n2"), (2, "s")], "k int, v string")
    assert rows(updates.backfill(dst, src, "k")) == sorted([(1, "d"), (2, "s"), (None, "n1"), (None, "n2")], key=repr)


def test_sums_keep_their_digits(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:01", 0.004), ("a", "2024-01-01 00:00:02", 0.004)], "k string, t string, v double").withColumn(
        "ts", F.col("t").cast("timestamp_ntz"))
    assert windows.tumbling_sum(df, "ts", "1 hour", "v", key="k").first().sum_value == 0.008
    assert A.avg_or_zero(df, "v").first().avg_value == 0.004
    assert [r.avg_value for r in A.terms_and_avg(df, "k", "v").collect()] == [0.004, 0.004]
    assert A.terms_and_avg(df.limit(0), "k", "v").count() == 0


def test_display_time_keeps_small_values_numeric(spark):
    from eventide.functions.scalars import display_time
    df = spark.createDataFrame([(0,), (50000,), (50001,), (1704110301764,)], "ms bigint")
    got = [r.d for r in df.orderBy("ms").select(display_time("ms").alias("d")).collect()]
    assert got == ["0", "50000", "1970-01-01 00:00:50.001", "2024-01-01 11:58:21.764"]


def test_nulls_in_a_list_take_no_rows(spark):
    from eventide.functions import predicates as P
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    kept = lambda p: sorted(str(r.x) for r in df.where(p).collect())
    assert kept(P.must_not(P.terms("x", ["a", None]))) == ["None", "b"]
    assert kept(P.must_not(P.term("x", None))) == ["None", "a", "b"] == kept(P.must_not(P.terms("x", [None])))
    assert kept(P.terms("x", ["a", None])) == ["a"] and kept(P.term("x", None)) == [] == kept(P.terms("x", []))
    assert kept(P.bool_query(must_=[P.exists("x")], must_not_=[P.terms("x", [None, "b"])])) == ["a"]
    assert kept(P.must_not(P.term("x", F.col("x")))) == ["None"]
