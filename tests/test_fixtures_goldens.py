"""Goldens from the fixtures (FIXTURES.md) plus invented edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from eventide.functions.scalars import from_epoch_ms
from eventide.operators import buffer, keyed, patterns, windows
from eventide.sources.lines import parse_json_lines


def _pattern_df(spark, data, keyed_=False):
    cols = "id int, event_name string, value double, ts_ms bigint, seq bigint"
    if keyed_:
        cols = "k string, " + cols
    df = spark.createDataFrame(data, cols)
    return df.withColumn("ts", from_epoch_ms("ts_ms").cast("timestamp_ntz"))


def stages():
    return [F.col("event_name") == n for n in ("start", "middle", "end")]


def test_pattern_literal_golden(spark):
    # fixture 1: arrival order differs from event time; the only match is 1 5 4
    data = [(1, "start", 1.0, 5, 1), (2, "middle", 2.0, 1, 2), (3, "end", 3.0, 3, 3),
            (4, "end", 4.0, 10, 4), (5, "middle", 5.0, 7, 5), (6, "middle", 6.0, 100, 6)]
    out = patterns.sequence_match(_pattern_df(spark, data), stages(), "ts", "seq", "id", n_buckets=3)
    assert [r.ids for r in out.collect()] == ["1 5 4 "]


def test_pattern_shared_rows_ties_and_keys(spark):
    data = [
        # key a: two starts share one middle and end
        ("a", 1, "start", 0.0, 1, 1), ("a", 2, "start", 0.0, 2, 2), ("a", 3, "middle", 0.0, 3, 3),
        ("a", 4, "end", 0.0, 4, 4),
        # key b: equal timestamps resolved by seq; middle before start in seq does not count
        ("b", 10, "middle", 0.0, 5, 10), ("b", 11, "start", 0.0, 5, 11), ("b", 12, "middle", 0.0, 5, 12),
        ("b", 13, "end", 0.0, 5, 13),
        # key c: no end
        ("c", 20, "start", 0.0, 1, 20), ("c", 21, "middle", 0.0, 2, 21),
    ]
    df = _pattern_df(spark, data, keyed_=True)
    for nb in (1, 2, 5):
        out = patterns.sequence_match(df, stages(), "ts", "seq", "id", key="k", n_buckets=nb)
        assert rows(out, "k", "ids") == [("a", "1 3 4 "), ("a", "2 3 4 "), ("b", "11 12 13 ")]


def test_count_window_average_literal(spark):
    # fixture 2: k=1, values 4 5 3 8 6, n=2 -> (1,4), (1,5); fifth row pending
    df = spark.createDataFrame([(1, v, i) for i, v in enumerate([4, 5, 3, 8, 6], 1)],
                               "k bigint, v bigint, seq bigint")
    out = keyed.count_window_avg(df, "k", "seq", "v", n=2, n_buckets=2)
    assert rows(out, "k", "avg_value") == [(1, 4), (1, 5)]


def test_count_window_truncates_toward_zero_and_interleaves(spark):
    data = [(1, -4, 1), (2, 10, 2), (1, -3, 3), (2, 1, 4), (2, 2, 5), (2, 2, 6)]
    df = spark.createDataFrame(data, "k bigint, v bigint, seq bigint")
    out = keyed.count_window_avg(df, "k", "seq", "v", n=2, n_buckets=3)
    assert rows(out, "k", "window_idx", "avg_value") == [(1, 0, -3), (2, 0, 5), (2, 1, 2)]


def test_buffered_sink_literal(spark, scratch):
    # fixture 3
    data = [("id", 12345, 1), ("salary", 1000, 2), ("phone_num", 732888888, 3), ("id", 45678, 4)]
    df = spark.createDataFrame(data, "name string, v int, seq bigint")
    latest = buffer.latest_buffers(df, "name", "seq", 1)
    assert rows(latest, "file_name", "v") == [("id", 45678), ("phone_num", 732888888), ("salary", 1000)]
    two = buffer.latest_buffers(df, "name", "seq", 2)
    assert rows(two, "file_name", "seq") == [("id", 3), ("id", 4), ("salary", 1), ("salary", 2)]
    buffer.write_latest(df, scratch, "name", "seq", 1)
    back = spark.read.json(scratch)
    assert rows(back, "file_name", "v") == [("id", 45678), ("phone_num", 732888888), ("salary", 1000)]


def _ticks(spark):
    base = 1536000000000
    lines = [(f'{{"id":{i},"occur_time":{base + 100 * i}}}',) for i in range(1, 11)]
    df = parse_json_lines(spark.createDataFrame(lines, "line string"), "id int, occur_time bigint")
    return df.withColumn("ts", from_epoch_ms("occur_time"))


def test_offset_windows_golden(spark):
    # fixture 4: 500 ms windows hold 4, 5, 1 rows; with a 150 ms offset 1, 5, 4
    df = _ticks(spark)
    plain = windows.tumbling_count(df, "ts", "500 milliseconds").orderBy("window_start")
    assert [r.n for r in plain.collect()] == [4, 5, 1]
    shifted = windows.tumbling_count(df, "ts", "500 milliseconds", offset="150 milliseconds")
    assert [r.n for r in shifted.orderBy("window_start").collect()] == [1, 5, 4]


def test_chained_windows_flag_every_row(spark):
    df = _ticks(spark)
    out = windows.chained_windows(df, "ts", "500 milliseconds", "500 milliseconds", "150 milliseconds")
    got = out.orderBy("window_start").collect()
    assert [r.n for r in got] == [1, 5, 4]
    assert all(r.n == r.n_flagged for r in got)


def test_window_tag_rows_last_ms(spark):
    df = _ticks(spark)
    out = windows.tag_rows(df, "ts", "500 milliseconds").orderBy("id").collect()
    assert out[0].window_max_ts - out[0].window_start == dt.timedelta(milliseconds=499)
    assert {r.window_start for r in out[:4]} == {out[0].window_start}


def test_corrupt_json_line_is_kept_aside(spark):
    df = spark.createDataFrame([('{"id":1,"occur_time":5}',), ("not json",)], "line string")
    out = parse_json_lines(df, "id int, occur_time bigint").orderBy("id").collect()
    assert out[0]._corrupt == "not json" and out[0].id is None
    assert out[1].id == 1 and out[1]._corrupt is None
