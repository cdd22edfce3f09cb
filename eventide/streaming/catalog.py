"""Streaming entries of the query catalogue.

Each entry streams a whole driver table through the streaming operator with
``Trigger.AvailableNow`` (the closing no-data batch included) and returns
what the sink received.  The SQL oracle is the batch answer restricted to
what the final watermark has closed: with a 0 s delay the watermark is the
largest event time, truncated to milliseconds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators.metrics import counted_stream
from eventide.plans import catalog as C
from eventide.streaming import keyed_table, processors, windows
from eventide.streaming.runner import event_stream, run_available, table_stream


def _ev(spark, sf_dir, cols, delay="0 seconds"):
    return table_stream(spark, sf_dir, "events", cols, delay=delay)


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def sq_tumbling_sum(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["ts", "event_type", "value"])
    ev = ev.withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = run_available(windows.tumbling_sum(ev, "ts", C.TUMBLE, "value", key="event_type"), "stream_tumbling_sum")
    return out.withColumn("sum_value", F.col("sum_value").cast("double"))


def sq_tumbling_offset_count(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["ts"])
    return run_available(windows.tumbling_count(ev, "ts", C.TUMBLE, offset=C.OFFSET),
                         "stream_tumbling_offset_count")


def sq_window_tag_rows(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "ts", "event_type"], delay=None)
    return run_available(windows.tag_rows(ev, "ts", C.TAG_WINDOW), "stream_window_tag_rows")


def sq_chained_windows(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "ts"])
    return run_available(windows.chained_windows(ev, "ts", C.CHAIN_W1, C.CHAIN_W2, C.CHAIN_OFFSET),
                         "stream_chained_windows")


def sq_two_stage_windows(spark, sf_dir):
    """W5 as two stateful operators, both emitting."""
    ev = _ev(spark, sf_dir, ["ts", "user_id"])
    return run_available(windows.two_stage_windows(ev, "ts", C.CHAIN_W1, C.TUMBLE, "user_id"), "stream_two_stage_windows")


def sq_rows_on_close(spark, sf_dir):
    """W3 with the rows held until their window closes."""
    ev = _ev(spark, sf_dir, ["event_id", "ts", "event_type"])
    return run_available(windows.rows_on_close(ev, "ts", C.TUMBLE), "stream_rows_on_close")


def sq_running_reduce(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "value"], delay=None).select(
        "event_id", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    return run_available(processors.running_reduce(ev, "user_id", "event_id", "v"),
                         "stream_running_reduce")


def sq_count_window_avg(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "value"], delay=None).select(
        "event_id", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    return run_available(processors.count_window_avg(ev, "user_id", "event_id", "v", C.COUNT_WINDOW_N),
                         "stream_count_window_avg")


def sq_running_reduce_decimal(spark, sf_dir):
    """A8 streamed over exact decimals, some of them NULL."""
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "event_type", "value"], delay=None).select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value").cast("decimal(18,2)")).alias("v"))
    out = run_available(processors.running_reduce(ev, "user_id", "event_id", "v"), "stream_running_reduce_decimal")
    return out.select("event_id", "user_id", F.col("v").cast("string").alias("v"),
                      F.col("running_sum").cast("string").alias("running_sum"))


def _write_out_of_order(spark, sf_dir, path, cols):
    """The events as files that arrive about in event-time order: one write per
    shifted week, rows shifted by up to six hours, so files overlap.  The table
    is read once and dealt by week; each write reads its own week."""
    from eventide.session import scratch_path
    ev, weeks = C.read_table(spark, sf_dir, "events", cols), scratch_path(spark, "weeks")
    week = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("event_id") % 7) * C.HOUR_US) / F.lit(7 * C.DAY_US))
    ev.withColumn("week", week).write.partitionBy("week").parquet(weeks)
    dealt = spark.read.schema(ev.withColumn("week", week).schema).parquet(weeks)
    for r in dealt.select("week").distinct().orderBy("week").collect():      # one row per week
        dealt.where(F.col("week") == r["week"]).drop("week").write.mode("append").parquet(path)


def _out_of_order(spark, sf_dir, name, cols):
    from eventide.session import scratch_path
    path = scratch_path(spark, name)
    _write_out_of_order(spark, sf_dir, path, cols)
    return event_stream(spark, path, spark.read.parquet(path).schema, delay=OUT_OF_ORDER_DELAY, max_files_per_trigger=1)


def sq_timeout_out_of_order(spark, sf_dir):
    """T1 over overlapping files, one per micro-batch, with a watermark delay."""
    ev = _out_of_order(spark, sf_dir, "stream_timeout_out_of_order_in", ["event_id", "user_id", "ts"])
    out = run_available(processors.inactivity_timeout(ev, "user_id", "ts", "event_id", C.TIMEOUT_GAP_US),
                        "stream_timeout_out_of_order")
    return _ntz(out, "last_ts", "fire_ts")


def sq_pattern_out_of_order(spark, sf_dir):
    """T2 over overlapping files with text ids."""
    ev = _out_of_order(spark, sf_dir, "stream_pattern_out_of_order_in", ["event_id", "user_id", "ts", "event_type"])
    ev = ev.withColumn("name", F.concat(F.lit("e"), F.col("event_id").cast("string")))
    out = run_available(processors.sequence_match(ev, C._stages(), "ts", "event_id", "name", key="user_id"),
                        "stream_pattern_out_of_order")
    return _ntz(out, "start_ts", "end_ts")


def sq_late_rows(spark, sf_dir):
    """A tenth of the rows arrive after the watermark of all others; those
    whose window is closed by then are dropped."""
    from eventide.session import scratch_path
    path, out = scratch_path(spark, "stream_late_rows_in"), scratch_path(spark, "stream_late_rows")
    ev = C.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    for late in (False, True):      # the second run goes on from the first one's checkpoint
        ev.where((F.col("event_id") % 10 == 0) == F.lit(late)).write.mode("append").parquet(path)
        stream = event_stream(spark, path, ev.schema)
        result = run_available(windows.tumbling_count(stream, "ts", C.TUMBLE), "stream_late_rows", out=out)
    return result


def sq_late_rows_kept(spark, sf_dir):
    """W7 with the late rows as data: a tenth of the rows arrive after the
    watermark of all others.  Each row of the input is in a closed window, in
    an open one, or late: the three parts, which add up to the table."""
    from eventide.session import scratch_path
    path, out = scratch_path(spark, "stream_late_kept_in"), scratch_path(spark, "stream_late_kept")
    ev = C.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    for late in (False, True):      # the second run goes on from the first one's checkpoint
        ev.where((F.col("event_id") % 10 == 0) == F.lit(late)).write.mode("append").parquet(path)
        stream = event_stream(spark, path, ev.schema, delay=None)
        q = keyed_table.tumbling_sum(stream, f"{out}/sink", f"{out}/_checkpoint", "ts", C.TUMBLE, "event_id")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    closed = (spark.read.schema("window_start timestamp, window_end timestamp, n bigint, sum_value bigint").parquet(f"{out}/sink/rows/batch=*")
              .select(F.lit("closed").alias("part"), "window_start", "n", F.col("sum_value").alias("id_sum")))
    kept = (spark.read.schema("ts timestamp, event_id bigint, window_start timestamp").parquet(f"{out}/sink/late/batch=*")
            .groupBy("window_start").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))
            .select(F.lit("late").alias("part"), "window_start", "n", "id_sum"))
    return _ntz(closed.unionByName(kept), "window_start")


def sq_watermark_trace(spark, sf_dir):
    """W6 streamed: the events arrive in three lots, in the order of their ids."""
    from eventide.session import scratch_path
    from eventide.streaming.trace import watermark_trace_stream
    path, out = scratch_path(spark, "stream_watermark_trace_in"), scratch_path(spark, "stream_watermark_trace")
    ev = C.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    lo, hi = lo or 0, hi or 0
    third = (hi - lo) // 3 + 1
    for k in range(3):
        first = lo + k * third
        ev.where(F.col("event_id").between(first, first + third - 1)).write.mode("append").parquet(path)
        stream = event_stream(spark, path, ev.schema, delay=None, max_files_per_trigger=None)
        q = watermark_trace_stream(stream, f"{out}/sink", f"{out}/_checkpoint", "ts", "event_id")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    rows = spark.read.schema("event_id bigint, ts timestamp, watermark timestamp, is_late boolean").parquet(f"{out}/sink/trace")
    return _ntz(rows.select("event_id", "ts", "watermark", "is_late"), "ts", "watermark")


def sq_inactivity_timeout(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "ts"])
    out = run_available(processors.inactivity_timeout(ev, "user_id", "ts", "event_id", C.TIMEOUT_GAP_US),
                        "stream_inactivity_timeout")
    return _ntz(out, "last_ts", "fire_ts")


def sq_sequence_match(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"])
    out = run_available(processors.sequence_match(ev, C._stages(), "ts", "event_id", "event_id",
                                                  key="user_id"), "stream_sequence_match")
    return _ntz(out, "start_ts", "end_ts")


def sq_pattern_null_ids(spark, sf_dir):
    """T2 where one id in seven is NULL."""
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"])
    ev = ev.withColumn("name", F.expr("nullif(event_id, event_id div 7 * 7)"))
    out = run_available(processors.sequence_match(ev, C._stages(), "ts", "event_id", "name", key="user_id"), "stream_pattern_null_ids")
    return _ntz(out, "start_ts", "end_ts")


def sq_sequence_match_global(spark, sf_dir):
    """T2 unkeyed, streamed: the pattern sink with its own 0 s watermark; all
    work is the distributed batch pattern over final and retained rows."""
    from eventide.session import scratch_path
    from eventide.streaming.global_pattern import global_pattern_stream
    ev = _ev(spark, sf_dir, ["event_id", "ts", "event_type"], delay=None)
    out = scratch_path(spark, "stream_sequence_match_global")
    q = global_pattern_stream(ev, f"{out}/sink", f"{out}/_checkpoint", C._stages(), "ts",
                              "event_id", "event_id")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    m = spark.read.schema("id0 bigint, id1 bigint, id2 bigint, start_ts timestamp, end_ts timestamp, "
                          "ids string").parquet(f"{out}/sink/matches")
    return _ntz(m.select("id0", "id1", "id2", "start_ts", "end_ts", "ids"), "start_ts", "end_ts")


def _table_rows(spark, name, schema, start):
    """Run a keyed-table sink over all there is; return the rows it has written."""
    from eventide.session import scratch_path
    out = scratch_path(spark, name)
    q = start(f"{out}/sink", f"{out}/_checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(schema).parquet(f"{out}/sink/rows/batch=*")


def sq_table_running_reduce(spark, sf_dir):
    """A8 over a state table: event types are few, so every key is hot."""
    ev = _ev(spark, sf_dir, ["event_id", "event_type", "value"], delay=None).select(
        "event_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    return _table_rows(spark, "stream_table_running_reduce", "event_type string, event_id bigint, v bigint, running_sum bigint",
                       lambda p, c: keyed_table.running_reduce(ev, p, c, "event_type", "event_id", "v"))


def sq_table_running_best(spark, sf_dir):
    """A8 over a state table by a user-defined function."""
    ev = _ev(spark, sf_dir, ["event_id", "event_type", "value"], delay=None).select(
        "event_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    out = _table_rows(spark, "stream_table_running_best", "event_id bigint, event_type string, state struct<best: bigint, at: bigint, n: bigint>",
                      lambda p, c: keyed_table.running_reduce_by(ev, p, c, "event_type", "event_id", C.best_so_far("v", "event_id")))
    return out.select("event_id", "event_type", "state.*")


def sq_table_count_window_avg(spark, sf_dir):
    """A9 over a state table."""
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "value"], delay=None).select(
        "event_id", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    return _table_rows(spark, "stream_table_count_window", "user_id bigint, window_idx bigint, avg_value bigint, first_seq bigint, last_seq bigint",
                       lambda p, c: keyed_table.count_window_avg(ev, p, c, "user_id", "event_id", "v", C.COUNT_WINDOW_N))


def sq_table_inactivity_timeout(spark, sf_dir):
    """T1 over a state table."""
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "ts"], delay=None)
    return _ntz(_table_rows(spark, "stream_table_timeout", "user_id bigint, count bigint, last_ts timestamp, fire_ts timestamp",
                            lambda p, c: keyed_table.inactivity_timeout(ev, p, c, "user_id", "ts", "event_id", C.TIMEOUT_GAP_US)), "last_ts", "fire_ts")


def sq_table_sequence_match(spark, sf_dir):
    """T2 over a state table."""
    ev = _ev(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"], delay=None)
    return _ntz(_table_rows(spark, "stream_table_pattern", "user_id bigint, id0 bigint, id1 bigint, id2 bigint, start_ts timestamp, end_ts timestamp, ids string",
                            lambda p, c: keyed_table.sequence_match_stream(ev, p, c, C._stages(), "ts", "event_id", "event_id", "user_id")), "start_ts", "end_ts")


def sq_record_counter(spark, sf_dir):
    ev = _ev(spark, sf_dir, ["event_id", "event_type", "user_id"], delay=None)
    from eventide.sources.lines import good_rows, split_key_value
    lines = ev.select("event_id", F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("line"))
    parsed = counted_stream(good_rows(split_key_value(lines, "line", "bigint")), "records")
    return run_available(parsed.select("event_id", "key", "value"), "stream_record_counter")


# File size and trigger size of the derived line stream
LINES_PER_FILE = 1_000_000
LINE_FILES_PER_TRIGGER = 64


def sq_line_source(spark, sf_dir):
    """S4 with S2c: "<key> <value>" text lines, which Spark derives from
    ``events`` and writes as files under the shared root, read back as an
    unbounded text stream, parsed, and counted (T4).  Malformed lines are
    dropped by ``good_rows``."""
    from eventide.session import scratch_path
    from eventide.sources.lines import good_rows, split_key_value, stream_lines
    out = scratch_path(spark, "stream_line_source")
    ev = C.read_table(spark, sf_dir, "events", ["event_type", "user_id"])
    (ev.select(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("value"))
       .write.option("maxRecordsPerFile", LINES_PER_FILE).text(f"{out}/lines"))
    lines = stream_lines(spark, f"{out}/lines", max_files_per_trigger=LINE_FILES_PER_TRIGGER)
    parsed = counted_stream(good_rows(split_key_value(lines, "line", "bigint")), "records")
    return run_available(parsed.select("key", "value"), "stream_line_source", out=f"{out}/result")


def sq_buffered_sink_latest(spark, sf_dir):
    """T3 streamed: buffers of ``BUFFER_N`` rows written per file name by the
    exactly-once sink; the result is what survives in the sink folder."""
    from eventide.session import scratch_path
    from eventide.streaming.buffered_sink import buffered_sink_stream
    ev = _ev(spark, sf_dir, ["event_id", "event_type"], delay=None)
    out = scratch_path(spark, "stream_buffered_sink")
    q = buffered_sink_stream(ev, f"{out}/sink", f"{out}/_checkpoint", "event_type", "event_id",
                             C.BUFFER_N)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    written = spark.read.schema("event_id bigint, event_type string, buffer_idx bigint, file_name string") \
                   .json(f"{out}/sink")
    return (written.groupBy("file_name", "buffer_idx")
                   .agg(F.count(F.lit(1)).alias("buffer_rows"), F.min("event_id").alias("first_seq"),
                        F.max("event_id").alias("last_seq")))


# Fixed value: over a week and six hours, the most by which a row of
# _write_out_of_order can arrive behind a later one.
OUT_OF_ORDER_DELAY = "8 days"

STREAM_QUERIES = {
    "stream_running_reduce_decimal": sq_running_reduce_decimal,
    "stream_timeout_out_of_order": sq_timeout_out_of_order,
    "stream_pattern_null_ids": sq_pattern_null_ids,
    "stream_pattern_out_of_order": sq_pattern_out_of_order,
    "stream_late_rows": sq_late_rows,
    "stream_late_rows_kept": sq_late_rows_kept,
    "stream_watermark_trace": sq_watermark_trace,
    "stream_tumbling_sum": sq_tumbling_sum,
    "stream_tumbling_offset_count": sq_tumbling_offset_count,
    "stream_window_tag_rows": sq_window_tag_rows,
    "stream_chained_windows": sq_chained_windows,
    "stream_two_stage_windows": sq_two_stage_windows,
    "stream_rows_on_close": sq_rows_on_close,
    "stream_running_reduce": sq_running_reduce,
    "stream_count_window_avg": sq_count_window_avg,
    "stream_inactivity_timeout": sq_inactivity_timeout,
    "stream_sequence_match": sq_sequence_match,
    "stream_sequence_match_global": sq_sequence_match_global,
    "stream_record_counter": sq_record_counter,
    "stream_table_running_reduce": sq_table_running_reduce,
    "stream_table_running_best": sq_table_running_best,
    "stream_table_count_window_avg": sq_table_count_window_avg,
    "stream_table_inactivity_timeout": sq_table_inactivity_timeout,
    "stream_table_sequence_match": sq_table_sequence_match,
    "stream_buffered_sink_latest": sq_buffered_sink_latest,
    "stream_line_source": sq_line_source,
}

# the final watermark of a 0 s delay stream over ``events``
_WM = "(select date_trunc('millisecond', max(ts)) from events)"


_WM_DELAYED = f"({_WM} - interval 8 days)"


def _timeout_sql(wm: str) -> str:
    return f"""
select user_id, count, ts as last_ts, ts + to_microseconds({C.TIMEOUT_GAP_US}) as fire_ts from (
  select user_id, ts, row_number() over (partition by user_id order by ts, event_id) as count,
         lead(ts) over (partition by user_id order by ts, event_id) as nxt
  from events)
where (nxt is null or nxt > ts + to_microseconds({C.TIMEOUT_GAP_US}))
  and ts + to_microseconds({C.TIMEOUT_GAP_US}) <= {wm}"""


def _closed(sql: str, end_col: str = "window_end") -> str:
    return f"select * from ({sql}) where {end_col} <= {_WM}"


STREAM_ORACLE_SQL = {
    "stream_tumbling_sum": _closed(C.ORACLE_SQL["tumbling_sum"]),
    "stream_tumbling_offset_count": _closed(C.ORACLE_SQL["tumbling_offset_count"]),
    "stream_window_tag_rows": C.ORACLE_SQL["window_tag_rows"],
    "stream_watermark_trace": C.ORACLE_SQL["watermark_trace"],
    "stream_chained_windows": _closed(C.ORACLE_SQL["chained_windows"]),
    "stream_two_stage_windows": _closed(C.ORACLE_SQL["two_stage_windows"]),
    "stream_rows_on_close": f"""
select * from (select event_id, ts, event_type, {C._bucket_sql('ts', C.TUMBLE_US)} as window_start,
                      {C._bucket_sql('ts', C.TUMBLE_US)} + interval 6 hours as window_end from events)
where window_end <= {_WM}""",
    "stream_running_reduce": C.ORACLE_SQL["running_reduce"],
    "stream_count_window_avg": C.ORACLE_SQL["count_window_avg"],
    "stream_inactivity_timeout": _timeout_sql(_WM),
    "stream_timeout_out_of_order": _timeout_sql(_WM_DELAYED),
    "stream_pattern_out_of_order": "select user_id, 'e' || id0 as id0, 'e' || id1 as id1, 'e' || id2 as id2, start_ts, end_ts, "
                                   "'e' || id0 || ' e' || id1 || ' e' || id2 || ' ' as ids from ("
                                   + C._seq_sql(True).replace("from events)", f"from events where ts <= {_WM_DELAYED})", 1) + ")",
    "stream_pattern_null_ids": "select user_id, nullif(id0, id0 // 7 * 7) as id0, nullif(id1, id1 // 7 * 7) as id1, nullif(id2, id2 // 7 * 7) as id2, "
                               "start_ts, end_ts, case when id0 % 7 > 0 and id1 % 7 > 0 and id2 % 7 > 0 then ids end as ids from ("
                               + C._seq_sql(True).replace("from events)", f"from events where ts <= {_WM})", 1) + ")",
    "stream_running_reduce_decimal": """
select event_id, user_id, cast(v as varchar) as v,
       cast(sum(v) over (partition by user_id order by event_id rows between unbounded preceding and current row) as varchar) as running_sum
from (select event_id, user_id, case when event_type <> 'error' then cast(value as decimal(18,2)) end as v from events)""",
    "stream_late_rows_kept": f"""
with w as (select date_trunc('millisecond', max(ts)) as first from events where event_id % 10 <> 0),
e as (select event_id, {C._bucket_sql('ts', C.TUMBLE_US)} as window_start, event_id % 10 = 0 and
             {C._bucket_sql('ts', C.TUMBLE_US)} + interval 6 hours <= (select first from w) as late
      from events)
select case when late then 'late' else 'closed' end as part, window_start, count(*) as n, cast(sum(event_id) as bigint) as id_sum
from e where late or window_start + interval 6 hours <= {_WM} group by all""",
    "stream_late_rows": f"""
select * from (
  select {C._bucket_sql('ts', C.TUMBLE_US)} as window_start,
         {C._bucket_sql('ts', C.TUMBLE_US)} + interval 6 hours as window_end, count(*) as n
  from events
  where event_id % 10 <> 0 or {C._bucket_sql('ts', C.TUMBLE_US)} + interval 6 hours
        > (select date_trunc('millisecond', max(ts)) from events where event_id % 10 <> 0)
  group by all)
where window_end <= {_WM}""",
    "stream_sequence_match": C._seq_sql(True).replace(
        "from events)", f"from events where ts <= {_WM})", 1),
    "stream_sequence_match_global": C._seq_sql(False).replace(
        "from events)", f"from events where ts <= {_WM})", 1),
    "stream_record_counter": C.ORACLE_SQL["record_counter"],
    "stream_table_running_reduce": """
select event_type, event_id, cast(round(value * 100) as bigint) as v,
       cast(sum(cast(round(value * 100) as bigint)) over (partition by event_type order by event_id rows between unbounded preceding and current row) as bigint) as running_sum
from events""",
    "stream_table_running_best": C.ORACLE_SQL["running_best"],
    "stream_table_count_window_avg": C.ORACLE_SQL["count_window_avg"],
    "stream_table_inactivity_timeout": _timeout_sql(_WM),
    "stream_table_sequence_match": C._seq_sql(True).replace("from events)", f"from events where ts <= {_WM})", 1),
    "stream_buffered_sink_latest": C.ORACLE_SQL["buffered_sink_latest"],
    "stream_line_source": """
select event_type as key, user_id as value from events
where event_type is not null and event_type <> '' and user_id is not null""",
}
