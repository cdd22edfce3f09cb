"""Query catalogue over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` over whole tables, and most
have an ANSI SQL twin (DuckDB dialect) computing the same rows, used as the
correctness oracle.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventide.functions import predicates as P
from eventide.functions.scalars import display_time, epoch_ms, json_number
from eventide.functions.text import match
from eventide.operators import aggregates as A
from eventide.operators import buffer, keyed, ordering, patterns, reducers, sketches, timeout, updates, windows
from eventide.operators.metrics import counted
from eventide.sources.lines import good_rows, parse_json_lines, split_key_value
from eventide.sources.tables import (full_scan, read_table, time_range, time_range_scan, wildcard_scan,
                                     write_time_partitioned)

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US

# Parameters of the catalogue queries.
TUMBLE = "6 hours"
TUMBLE_US = 6 * HOUR_US
OFFSET = "90 minutes"
OFFSET_US = 90 * 60 * 1_000_000
TAG_WINDOW = "10 minutes"
TAG_WINDOW_US = 10 * 60 * 1_000_000
CHAIN_W1, CHAIN_W1_US = "1 hour", HOUR_US
CHAIN_W2, CHAIN_W2_US = "1 hour", HOUR_US
CHAIN_OFFSET, CHAIN_OFFSET_US = "15 minutes", 15 * 60 * 1_000_000
TIMEOUT_GAP_US = 6 * HOUR_US
HIST_WIDTH_US = 30 * 60 * 1_000_000
PAGE_SIZE = 100
BUFFER_N = 7
COUNT_WINDOW_N = 2
SPLIT_BUCKETS = 200
INCLUDE_USERS = (3, 7, 11, 19, 23, 42, 77, 101, 149)
MATCH_QUERY = "esat chch"
RENAME_FROM, RENAME_TO = "error", "failure"
RANGE_START, RANGE_END = "2024-01-05 00:00:00", "2024-01-12 00:00:00"
SKETCH_FIRST, SKETCH_LAST = "2024-01-05", "2024-01-20"
SCAN_GLOB, SCAN_TYPE = "doc*.parquet", "src7"


def _events(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    return read_table(spark, sf_dir, "events", cols)


def _cents(c: str = "value"):
    return F.round(F.col(c) * 100).cast("bigint")


def _money(c: str = "value"):
    """The field as exact cents; the queries choose the type, not the operators."""
    return F.col(c).cast("decimal(18,2)").alias(c)


# --------------------------------------------------------------------- windows

def q_tumbling_sum(spark, sf_dir):
    ev = _events(spark, sf_dir, ["ts", "event_type", "value"]).select("ts", "event_type", _money())
    out = windows.tumbling_sum(ev, "ts", TUMBLE, "value", key="event_type")
    return out.withColumn("sum_value", F.col("sum_value").cast("double"))


def q_tumbling_sum_fine(spark, sf_dir):
    """W2 on a field with digits beyond the cent."""
    ev = _events(spark, sf_dir, ["ts", "event_type", "value"]).select(
        "ts", "event_type", (_money() * F.lit("0.001").cast("decimal(4,3)")).alias("value"))
    out = windows.tumbling_sum(ev, "ts", TUMBLE, "value", key="event_type")
    return out.withColumn("sum_value", F.col("sum_value").cast("string"))


def q_tumbling_offset_count(spark, sf_dir):
    ev = _events(spark, sf_dir, ["ts"])
    return windows.tumbling_count(ev, "ts", TUMBLE, offset=OFFSET)


def q_window_tag_rows(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "ts", "event_type"])
    return windows.tag_rows(ev, "ts", TAG_WINDOW)


def q_chained_windows(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "ts"])
    return windows.chained_windows(ev, "ts", CHAIN_W1, CHAIN_W2, CHAIN_OFFSET)


def q_two_stage_windows(spark, sf_dir):
    return windows.two_stage_windows(_events(spark, sf_dir, ["ts", "user_id"]), "ts", CHAIN_W1, TUMBLE, "user_id")


def median_of(column: str):
    """The exact median of a column of whole numbers, as a window function: the
    batches' values alone are kept, eight bytes each."""
    def median(batches):
        import numpy as np
        import pyarrow as pa
        parts = [b.column(b.schema.get_field_index(column)).drop_null().to_numpy(zero_copy_only=False) for b in batches]
        values = np.concatenate([np.zeros(0, np.int64), *parts])
        middle = np.partition(values, [(len(values) - 1) // 2, len(values) // 2])[(len(values) - 1) // 2:len(values) // 2 + 1] if len(values) else values
        yield pa.RecordBatch.from_arrays([pa.array([len(values)], pa.int64()), pa.array([float(middle.mean()) if len(middle) else None], pa.float64())],
                                         names=["n", "median"])
    return median


def q_window_median(spark, sf_dir):
    """A function of whole windows: the median of each window and event type."""
    ev = _events(spark, sf_dir, ["ts", "event_type", "value"]).select("ts", "event_type", _cents().alias("v"))
    return windows.apply_to_windows(ev, "ts", TUMBLE, median_of("v"), "n bigint, median double", "event_type")


def q_watermark_trace(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "ts"])
    return windows.watermark_trace(ev, "ts", "event_id", delay_us=0)


def q_watermark_trace_split(spark, sf_dir):
    """W6 with many more buckets than tasks."""
    ev = _events(spark, sf_dir, ["event_id", "ts"])
    return windows.watermark_trace(ev, "ts", "event_id", delay_us=0, n_buckets=SPLIT_BUCKETS)


# ------------------------------------------------------------- keyed operators

def q_running_reduce(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"]).select(
        "event_id", "user_id", _cents().alias("v"))
    return keyed.running_reduce(ev, "user_id", "event_id", "v")


def product_modulo(value: Column, modulus: int = 1_000_003) -> reducers.Reducer:
    """Product of whole numbers modulo a number below 2**31."""
    return reducers.Reducer({"p": ("bigint", F.pmod(F.coalesce(value, F.lit(1)), F.lit(modulus)))},
                            lambda a, b: {"p": a["p"] * b["p"] % modulus})


def best_so_far(value: str, at: str) -> reducers.Reducer:
    """The largest value, where it was first reached, and the rows so far."""
    def merge(a, b):
        import numpy as np
        later = b["best"] > a["best"]
        return {"best": np.where(later, b["best"], a["best"]), "at": np.where(later, b["at"], a["at"]), "n": a["n"] + b["n"]}
    return reducers.Reducer({"best": ("bigint", F.coalesce(value, F.lit(-2**63).cast("bigint"))), "at": ("bigint", F.coalesce(at, F.lit(-1))),
                             "n": ("bigint", F.lit(1))}, merge)


def q_running_product(spark, sf_dir):
    """A8 by a user-defined function: product modulo a prime."""
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"]).select("event_id", "user_id", _cents().alias("v"))
    return reducers.running_reduce(ev, "user_id", "event_id", product_modulo(F.col("v"))).select("event_id", "user_id", "v", "state.p")


def q_running_best(spark, sf_dir):
    """A8 by a user-defined function over a struct, few keys, all hot."""
    ev = _events(spark, sf_dir, ["event_id", "event_type", "value"]).select("event_id", "event_type", _cents().alias("v"))
    return reducers.running_reduce(ev, "event_type", "event_id", best_so_far("v", "event_id")).select("event_id", "event_type", "state.*")


def q_count_window_avg(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"]).select(
        "event_id", "user_id", _cents().alias("v"))
    return keyed.count_window_avg(ev, "user_id", "event_id", "v", n=COUNT_WINDOW_N)


def q_inactivity_timeout(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts"])
    return timeout.inactivity_timeout(ev, "user_id", "ts", "event_id", TIMEOUT_GAP_US)


def _stages():
    return [F.col("event_type") == "view", F.col("event_type") == "click",
            F.col("event_type") == "purchase"]


def q_sequence_match(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"])
    return patterns.sequence_match(ev, _stages(), "ts", "event_id", "event_id", key="user_id")


def q_sequence_match_split(spark, sf_dir):
    """T2 with the keys cut into many buckets."""
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"])
    return patterns.sequence_match(ev, _stages(), "ts", "event_id", "event_id", key="user_id", n_buckets=SPLIT_BUCKETS)


def q_running_max(spark, sf_dir):
    """A8 with another reduction."""
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"]).select("event_id", "user_id", _cents().alias("v"))
    return keyed.running_reduce(ev, "user_id", "event_id", "v", name="running_max", op="max")


def q_sequence_match_global(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "ts", "event_type"])
    return patterns.sequence_match(ev, _stages(), "ts", "event_id", "event_id", key=None)


def q_buffered_sink_latest(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "event_type"])
    return buffer.latest_buffer_summary(ev, "event_type", "event_id", BUFFER_N)


def q_record_counter(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "event_type", "user_id"])
    lines = ev.select("event_id", F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("line"))
    return good_rows(split_key_value(lines, "line", "bigint")).select("event_id", "key", "value")


def q_record_counter_value(spark, sf_dir):
    """T4: what the counter holds after the job, beside the lines it left out."""
    ev = _events(spark, sf_dir, ["event_id", "event_type", "user_id"])
    # every seventh line has no number
    lines = ev.select(F.concat_ws(" ", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("string"))
                                  .otherwise("none")).alias("line"))
    bad = Observation("bad")
    observed, good = counted(good_rows(split_key_value(lines, "line", "bigint"), bad), "records")
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(good.get["records"]), int(bad.get["bad_lines"]))], "records bigint, bad_lines bigint")


def q_string_lines(spark, sf_dir):
    """Key and text value, further tokens ignored."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    lines = c.select("c_custkey", F.concat_ws(" ", "c_mktsegment", "c_name", F.lit("extra")).alias("line"))
    return good_rows(split_key_value(lines, "line", "string")).select("c_custkey", "key", "value")


# ------------------------------------------------------------ search analytics

def q_terms_top10(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    f = orders.where(P.range_between("o_orderdate", "1995-01-01 00:00:00", "1996-12-31 00:00:00"))
    return A.terms(f, "o_custkey", 10)


def q_avg_or_zero(spark, sf_dir):
    ev = _events(spark, sf_dir, ["value"])
    return A.avg_or_zero(ev.where(F.col("value") > 1e12), "value")


def q_avg_value(spark, sf_dir):
    return A.avg_or_zero(_events(spark, sf_dir, ["value"]).select(_money()), "value")


def q_avg_event_time(spark, sf_dir):
    return A.avg_epoch_ms(_events(spark, sf_dir, ["ts"]), "ts")


def q_cardinality_exact(spark, sf_dir):
    ev = _events(spark, sf_dir, ["user_id", "ts"])
    f = ev.where(P.range_between("ts", "2024-01-05 00:00:00", "2024-01-20 00:00:00"))
    return A.cardinality(f, "user_id", exact=True)


def q_cardinality_within_5pct(spark, sf_dir):
    ev = _events(spark, sf_dir, ["user_id", "ts"])
    f = ev.where(P.range_between("ts", "2024-01-05 00:00:00", "2024-01-20 00:00:00"))
    return A.cardinality_check(f, "user_id")


def q_distinct_from_daily_sketches(spark, sf_dir):
    """Distinct users of a range of days from stored daily sketches alone,
    against the exact count."""
    from eventide.session import scratch_path
    ev, path = _events(spark, sf_dir, ["user_id", "ts"]), scratch_path(spark, "daily_sketches")
    sketches.daily_distinct(ev, "user_id", "ts").write.parquet(path)
    stored = spark.read.schema("day date, sketch binary, rows bigint").parquet(path)
    union = sketches.distinct_in_range(stored, SKETCH_FIRST, SKETCH_LAST)
    exact = A.cardinality(ev.where(F.to_date("ts").between(F.lit(SKETCH_FIRST).cast("date"), F.lit(SKETCH_LAST).cast("date"))), "user_id", exact=True)
    off = F.abs(union.select("cardinality").scalar() - F.col("cardinality"))
    return exact.select("cardinality", "total", union.select("rows").scalar().alias("sketched_rows"),
                        (off <= F.lit(sketches.error_bound()) * F.col("cardinality")).alias("within_bound"))


def q_date_histogram_filled(spark, sf_dir):
    ev = _events(spark, sf_dir, ["ts", "event_type"]).where(P.term("event_type", "purchase"))
    return A.date_histogram(ev, "ts", HIST_WIDTH_US, fill=True)


def q_histogram_top_terms(spark, sf_dir):
    return A.histogram_top_terms(_events(spark, sf_dir, ["ts", "user_id"]), "ts", DAY_US, "user_id", 5)


def q_histogram_top_terms_include(spark, sf_dir):
    return A.histogram_top_terms(_events(spark, sf_dir, ["ts", "user_id"]), "ts", DAY_US, "user_id", 5,
                                 include=INCLUDE_USERS)


def q_terms_and_avg_one_pass(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", ["c_mktsegment", "c_acctbal"]).select("c_mktsegment", _money("c_acctbal"))
    return A.terms_and_avg(cust, "c_mktsegment", "c_acctbal")


def _docs_with_null_lang(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    return d.withColumn("lang", F.expr("nullif(lang, 'fr')"))


def q_bool_must_mustnot(spark, sf_dir):
    d = _docs_with_null_lang(spark, sf_dir)
    q = P.bool_query(must_=[F.col("n_chars") > 200],
                     must_not_=[P.term("lang", "de"), P.term("source", "src3")])
    return ordering.sort_by(d.where(q).select("doc_id", "lang", "source", "n_chars"),
                            [("n_chars", False), ("doc_id", True)])


def q_match_tokens(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return d.where(match("text", MATCH_QUERY)).select("doc_id", "lang")


def q_exists_filter(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "event_type"]).withColumn(
        "event_type", F.expr("nullif(event_type, 'error')"))
    return ev.where(P.exists("event_type"))


def q_project_and_cast(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "props"])
    return ev.select("event_id", json_number("props", "$.k").alias("k"))


def q_paged_scan(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return ordering.paginate(o, [("o_totalprice", False), ("o_orderkey", True)], PAGE_SIZE)


def q_paged_scan_by_name(spark, sf_dir):
    """L3 over a text column."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return ordering.paginate(c, [("c_name", False), ("c_custkey", True)], PAGE_SIZE)


def q_paged_scan_by_status(spark, sf_dir):
    """L3 over a column of three values."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    return ordering.paginate(o, [("o_orderstatus", True), ("o_orderkey", False)], PAGE_SIZE)


def q_top_hits(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderstatus"])
    return ordering.top_hits(o.where(P.term("o_orderstatus", "F")),
                             [("o_totalprice", False), ("o_orderkey", True)], 10)


def q_conditional_update(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "event_type"])
    cond = P.must(P.term("user_id", 42), P.term("event_type", "error"))
    return updates.conditional_update(ev, cond, "event_type", None)


def q_backfill_merge(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    src = o.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).drop("o_orderdate")
    dst = (o.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).drop("o_orderdate")
            .withColumn("o_orderpriority", F.lit(None).cast("string")))
    return updates.backfill(dst, src, "o_orderkey", ["o_orderpriority", "o_orderstatus"])


def q_json_bundle_lines(spark, sf_dir):
    from eventide.sources.sinks import json_lines
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return json_lines(c)


def q_bundle_total(spark, sf_dir):
    """The total written beside the bundle's data."""
    from eventide.session import scratch_path
    from eventide.sources.sinks import bundle
    path = scratch_path(spark, "bundle")
    bundle(read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"]), path)
    lines = spark.read.schema("c_custkey bigint").json(f"{path}/data").agg(F.count("c_custkey").alias("n"))
    return spark.read.schema("total bigint").json(f"{path}/total").select("total", lines.select("n").scalar().alias("lines"))


def q_json_line_source(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "props"]).withColumnRenamed("props", "line")
    return parse_json_lines(ev, "k bigint", "line")


def q_full_scan_count(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return full_scan(li, P.match_all()).agg(F.count(F.lit(1)).alias("total"))


def q_epoch_display(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "ts"]).select("event_id", epoch_ms("ts").alias("ts_ms"))
    return ev.withColumn("ts_display", display_time("ts_ms"))


def q_update_touched_files(spark, sf_dir):
    """T10 on a stored table: only the files of the days in question are rewritten."""
    from eventide.session import scratch_path
    from eventide.sources.versioned import VersionedTable
    stored = VersionedTable(spark, scratch_path(spark, "versioned_events"))
    stored.create(_events(spark, sf_dir, ["event_id", "ts", "event_type"]).repartitionByRange("ts"))
    stored.update(P.range_between("ts", RANGE_START, RANGE_END) & P.term("event_type", RENAME_FROM), "event_type", RENAME_TO)
    return stored.read()


def q_rename_value(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "event_type"])
    return updates.rename_value(ev, "event_type", RENAME_FROM, RENAME_TO)


def q_sequence_last_match(spark, sf_dir):
    """The match a file sink overwritten per match keeps (T6): the one
    completed last in event time (ties by later end row, then later start)."""
    m = q_sequence_match(spark, sf_dir)
    return ordering.top_hits(m, [("end_ts", False), ("id2", False), ("start_ts", False), ("id0", False)], 1)


def q_time_range_scan(spark, sf_dir):
    """S6 on an unpartitioned table: the half-open range reaches the Parquet
    reader as pushed filters (row groups outside it are skipped)."""
    ev = _events(spark, sf_dir, ["event_id", "ts", "user_id"])
    return time_range(ev, "ts", RANGE_START, RANGE_END)


def q_time_pruned_scan(spark, sf_dir):
    """S6 on a date-partitioned copy: whole days outside the range are not opened."""
    from eventide.session import scratch_path
    path = scratch_path(spark, "events-by-day")
    write_time_partitioned(_events(spark, sf_dir, ["event_id", "ts", "user_id"]), path, "ts")
    return time_range_scan(spark, path, "ts", RANGE_START, RANGE_END).select("event_id", "ts", "user_id")


def q_wildcard_multi_scan(spark, sf_dir):
    """S5 over several datasets, each row with its dataset's name."""
    df = wildcard_scan(spark, f"{sf_dir.rstrip('/')}/{{documents,labels}}.parquet", merge_schema=True)
    return df.select("doc_id", F.col("_dataset").alias("dataset"), "quality")


def q_wildcard_type_scan(spark, sf_dir):
    """Every dataset matching a glob, restricted to one type; the glob
    and the type predicate are the only inputs (no table name)."""
    df = wildcard_scan(spark, f"{sf_dir.rstrip('/')}/{SCAN_GLOB}", SCAN_TYPE, type_col="source",
                       merge_schema=False, with_dataset=False)
    return df.select("doc_id", "lang", "source", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumbling_sum": q_tumbling_sum,
    "tumbling_sum_fine": q_tumbling_sum_fine,
    "tumbling_offset_count": q_tumbling_offset_count,
    "window_tag_rows": q_window_tag_rows,
    "chained_windows": q_chained_windows,
    "update_touched_files": q_update_touched_files,
    "running_product": q_running_product,
    "running_best": q_running_best,
    "two_stage_windows": q_two_stage_windows,
    "window_median": q_window_median,
    "distinct_from_daily_sketches": q_distinct_from_daily_sketches,
    "watermark_trace": q_watermark_trace,
    "watermark_trace_split": q_watermark_trace_split,
    "running_reduce": q_running_reduce,
    "running_max": q_running_max,
    "count_window_avg": q_count_window_avg,
    "inactivity_timeout": q_inactivity_timeout,
    "sequence_match": q_sequence_match,
    "sequence_match_split": q_sequence_match_split,
    "sequence_match_global": q_sequence_match_global,
    "buffered_sink_latest": q_buffered_sink_latest,
    "record_counter": q_record_counter,
    "record_counter_value": q_record_counter_value,
    "string_lines": q_string_lines,
    "terms_top10": q_terms_top10,
    "avg_or_zero": q_avg_or_zero,
    "avg_value": q_avg_value,
    "avg_event_time": q_avg_event_time,
    "cardinality_exact": q_cardinality_exact,
    "cardinality_within_5pct": q_cardinality_within_5pct,
    "date_histogram_filled": q_date_histogram_filled,
    "histogram_top_terms": q_histogram_top_terms,
    "histogram_top_terms_include": q_histogram_top_terms_include,
    "terms_and_avg_one_pass": q_terms_and_avg_one_pass,
    "bool_must_mustnot": q_bool_must_mustnot,
    "match_tokens": q_match_tokens,
    "exists_filter": q_exists_filter,
    "project_and_cast": q_project_and_cast,
    "paged_scan": q_paged_scan,
    "paged_scan_by_name": q_paged_scan_by_name,
    "paged_scan_by_status": q_paged_scan_by_status,
    "top_hits": q_top_hits,
    "conditional_update": q_conditional_update,
    "backfill_merge": q_backfill_merge,
    "json_bundle_lines": q_json_bundle_lines,
    "bundle_total": q_bundle_total,
    "json_line_source": q_json_line_source,
    "full_scan_count": q_full_scan_count,
    "epoch_display": q_epoch_display,
    "rename_value": q_rename_value,
    "sequence_last_match": q_sequence_last_match,
    "time_range_scan": q_time_range_scan,
    "time_pruned_scan": q_time_pruned_scan,
    "wildcard_type_scan": q_wildcard_type_scan,
    "wildcard_multi_scan": q_wildcard_multi_scan,
}


def _bucket_sql(expr: str, width_us: int, offset_us: int = 0) -> str:
    return f"make_timestamp(((epoch_us({expr}) - {offset_us}) // {width_us}) * {width_us} + {offset_us})"


_NEXT = ("partition by {k} order by ts desc, event_id desc "
         "rows between unbounded preceding and 1 preceding")


def _seq_sql(keyed: bool) -> str:
    k = "user_id" if keyed else "0"
    frame = _NEXT.format(k=k)
    sel_key = "user_id, " if keyed else ""
    return f"""
with e as (select event_id, {'user_id, ' if keyed else ''}ts, event_type from events),
p as (select *, last(case when event_type = 'purchase' then {{'id': event_id, 'ts': ts}} end ignore nulls)
        over ({frame}) as nx_end from e),
m as (select *, last(case when event_type = 'click' then {{'id': event_id, 'nxt': nx_end}} end ignore nulls)
        over ({frame}) as nx_mid from p)
select {sel_key}event_id as id0, nx_mid.id as id1, nx_mid.nxt.id as id2,
       ts as start_ts, nx_mid.nxt.ts as end_ts,
       concat(event_id, ' ', nx_mid.id, ' ', nx_mid.nxt.id, ' ') as ids
from m where event_type = 'view' and nx_mid is not null and nx_mid.nxt is not null
"""


ORACLE_SQL: dict[str, str] = {
    "tumbling_sum": f"""
select {_bucket_sql('ts', TUMBLE_US)} as window_start,
       {_bucket_sql('ts', TUMBLE_US)} + interval 6 hours as window_end,
       event_type, cast(sum(cast(value as decimal(18,2))) as double) as sum_value,
       count(*) as n, max(ts) as last_ts
from events group by all""",
    "tumbling_sum_fine": f"""
select {_bucket_sql('ts', TUMBLE_US)} as window_start,
       {_bucket_sql('ts', TUMBLE_US)} + interval 6 hours as window_end,
       event_type, cast(sum(cast(value as decimal(18,2)) * cast(0.001 as decimal(4,3))) as varchar) as sum_value,
       count(*) as n, max(ts) as last_ts
from events group by all""",
    "tumbling_offset_count": f"""
select {_bucket_sql('ts', TUMBLE_US, OFFSET_US)} as window_start,
       {_bucket_sql('ts', TUMBLE_US, OFFSET_US)} + interval 6 hours as window_end,
       count(*) as n
from events group by all""",
    "window_tag_rows": f"""
select event_id, ts, event_type,
       {_bucket_sql('ts', TAG_WINDOW_US)} as window_start,
       {_bucket_sql('ts', TAG_WINDOW_US)} + interval 10 minutes as window_end,
       {_bucket_sql('ts', TAG_WINDOW_US)} + interval 10 minutes - interval 1 millisecond as window_max_ts
from events""",
    "chained_windows": f"""
select {_bucket_sql('ts', CHAIN_W2_US, CHAIN_OFFSET_US)} as window_start,
       {_bucket_sql('ts', CHAIN_W2_US, CHAIN_OFFSET_US)} + interval 1 hour as window_end,
       count(*) as n, count(*) as n_flagged,
       min({_bucket_sql('ts', CHAIN_W1_US)}) as first_w1_start,
       max({_bucket_sql('ts', CHAIN_W1_US)}) as last_w1_start
from events group by all""",
    "update_touched_files": f"""
select event_id, ts, case when event_type = '{RENAME_FROM}' and ts between timestamp '{RANGE_START}' and timestamp '{RANGE_END}'
                          then '{RENAME_TO}' else event_type end as event_type
from events""",
    "running_product": """
select event_id, user_id, v, list_reduce(list(v % 1000003) over (partition by user_id order by event_id), lambda a, b: a * b % 1000003) as p
from (select event_id, user_id, cast(round(value * 100) as bigint) as v from events)""",
    "running_best": """
select event_id, event_type, best, min(case when v = best then event_id end) over (partition by event_type, best order by event_id) as at, n
from (select event_id, event_type, v, max(v) over (partition by event_type order by event_id) as best,
             row_number() over (partition by event_type order by event_id) as n
      from (select event_id, event_type, cast(round(value * 100) as bigint) as v from events))""",
    "two_stage_windows": f"""
with g as (select {_bucket_sql('ts', CHAIN_W1_US)} as w1, user_id, count(*) as n from events group by all)
select {_bucket_sql("w1 + interval 1 hour - interval 1 microsecond", TUMBLE_US)} as window_start,
       {_bucket_sql("w1 + interval 1 hour - interval 1 microsecond", TUMBLE_US)} + interval 6 hours as window_end,
       count(*) as groups, cast(sum(n) as bigint) as n, max(n) as largest
from g group by all""",
    "window_median": f"""
select {_bucket_sql('ts', TUMBLE_US)} as window_start, {_bucket_sql('ts', TUMBLE_US)} + interval 6 hours as window_end,
       event_type, count(value) as n, median(cast(cast(round(value * 100) as bigint) as double)) as median
from events group by all""",
    "distinct_from_daily_sketches": f"""
select count(distinct user_id) as cardinality, count(*) as total, count(*) as sketched_rows, true as within_bound
from events where cast(ts as date) between date '{SKETCH_FIRST}' and date '{SKETCH_LAST}'""",
    "watermark_trace": """
select event_id, ts, wm as watermark, coalesce(ts <= wm, false) as is_late
from (select event_id, ts, max(ts) over (order by event_id rows between unbounded preceding and 1 preceding) as wm
      from events)""",
    "running_reduce": """
select event_id, user_id, cast(round(value * 100) as bigint) as v,
       cast(sum(cast(round(value * 100) as bigint)) over (partition by user_id order by event_id
            rows between unbounded preceding and current row) as bigint) as running_sum
from events""",
    "count_window_avg": f"""
select user_id, window_idx, avg_value, first_seq, last_seq from (
  select user_id, (rn - 1) // {COUNT_WINDOW_N} as window_idx, count(*) as n,
         cast(sum(v) // {COUNT_WINDOW_N} as bigint) as avg_value,
         min(event_id) as first_seq, max(event_id) as last_seq
  from (select user_id, event_id, cast(round(value * 100) as bigint) as v,
               row_number() over (partition by user_id order by event_id) as rn from events)
  group by all) where n = {COUNT_WINDOW_N}""",
    "inactivity_timeout": f"""
select user_id, count, ts as last_ts, ts + to_microseconds({TIMEOUT_GAP_US}) as fire_ts from (
  select user_id, ts, row_number() over (partition by user_id order by ts, event_id) as count,
         lead(ts) over (partition by user_id order by ts, event_id) as nxt
  from events)
where nxt is null or nxt > ts + to_microseconds({TIMEOUT_GAP_US})""",
    "sequence_match": _seq_sql(True),
    "sequence_match_global": _seq_sql(False),
    "buffered_sink_latest": f"""
with b as (
  select (row_number() over (order by event_id) - 1) // {BUFFER_N} as buffer_idx, event_id, event_type
  from events),
f as (select buffer_idx, arg_max(event_type, event_id) as file_name, count(*) as buffer_rows,
             min(event_id) as first_seq, max(event_id) as last_seq
      from b group by buffer_idx having count(*) = {BUFFER_N})
select file_name, buffer_idx, buffer_rows, first_seq, last_seq from f
qualify row_number() over (partition by file_name order by buffer_idx desc) = 1""",
    "record_counter": """
select event_id, event_type as key, user_id as value from events""",
    "record_counter_value": """
select count(*) filter (where event_id % 7 <> 0) as records, count(*) filter (where event_id % 7 = 0) as bad_lines
from events""",
    "string_lines": """
select c_custkey, c_mktsegment as key, c_name as value from customer""",
    "running_max": """
select event_id, user_id, cast(round(value * 100) as bigint) as v,
       max(cast(round(value * 100) as bigint)) over (partition by user_id order by event_id
            rows between unbounded preceding and current row) as running_max
from events""",
    "paged_scan_by_name": f"""
select c_custkey, c_name, rn, (rn - 1) // {PAGE_SIZE} as page from (
  select c_custkey, c_name, row_number() over (order by c_name desc nulls last, c_custkey) as rn from customer)""",
    "paged_scan_by_status": f"""
select o_orderkey, o_orderstatus, rn, (rn - 1) // {PAGE_SIZE} as page from (
  select o_orderkey, o_orderstatus, row_number() over (order by o_orderstatus nulls first, o_orderkey desc) as rn
  from orders)""",
    "bundle_total": """
select count(*) as total, count(*) as lines from customer""",
    "wildcard_multi_scan": """
select doc_id, 'documents' as dataset, cast(null as integer) as quality from documents
union all select doc_id, 'labels', quality from labels""",
    "terms_top10": """
select o_custkey, count(*) as doc_count from orders
where o_orderdate between timestamp '1995-01-01 00:00:00' and timestamp '1996-12-31 00:00:00'
  and o_custkey is not null
group by o_custkey order by doc_count desc, o_custkey asc limit 10""",
    "avg_or_zero": """
select coalesce(avg(value), 0.0) as avg_value from events where value > 1e12""",
    "avg_value": """
select coalesce(cast(sum(cast(value as decimal(18,2))) as double) / count(value), 0.0) as avg_value
from events""",
    "avg_event_time": """
select cast(sum((epoch_us(ts) // 1000)::hugeint) // count(ts) as bigint) as avg_ms,
       make_timestamp(cast(sum((epoch_us(ts) // 1000)::hugeint) // count(ts) as bigint) * 1000) as avg_ts
from events""",
    "cardinality_exact": """
select count(distinct user_id) as cardinality, count(*) as total from events
where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 00:00:00'""",
    "cardinality_within_5pct": """
select true as within_5pct, count(distinct user_id) as cardinality, count(*) as total from events
where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 00:00:00'""",
    "date_histogram_filled": f"""
with c as (select (epoch_us(ts) // {HIST_WIDTH_US}) as idx, count(*) as n
           from events where event_type = 'purchase' and ts is not null group by 1),
s as (select unnest(range((select min(idx) from c), (select max(idx) from c) + 1)) as idx)
select make_timestamp(s.idx * {HIST_WIDTH_US}) as bucket_start, cast(coalesce(c.n, 0) as bigint) as doc_count
from s left join c on s.idx = c.idx""",
    "histogram_top_terms": f"""
select bucket_start, user_id, doc_count, rank from (
  select bucket_start, user_id, doc_count,
         row_number() over (partition by bucket_start order by doc_count desc, user_id) as rank
  from (select {_bucket_sql('ts', DAY_US)} as bucket_start, user_id, count(*) as doc_count
        from events where ts is not null and user_id is not null group by all))
where rank <= 5""",
    "histogram_top_terms_include": f"""
select bucket_start, user_id, doc_count, rank from (
  select bucket_start, user_id, doc_count,
         row_number() over (partition by bucket_start order by doc_count desc, user_id) as rank
  from (select {_bucket_sql('ts', DAY_US)} as bucket_start, user_id, count(*) as doc_count
        from events where ts is not null and user_id in {INCLUDE_USERS} group by all))
where rank <= 5""",
    "terms_and_avg_one_pass": """
select c_mktsegment, grouping(c_mktsegment) = 1 as is_total, count(*) as doc_count,
       cast(sum(cast(c_acctbal as decimal(18,2))) as double) / count(c_acctbal) as avg_value
from customer group by grouping sets ((c_mktsegment), ())""",
    "bool_must_mustnot": """
select doc_id, nullif(lang, 'fr') as lang, source, n_chars from documents
where coalesce(n_chars > 200, false)
  and not coalesce(nullif(lang, 'fr') = 'de', false)
  and not coalesce(source = 'src3', false)
order by n_chars desc, doc_id""",
    "match_tokens": """
select doc_id, lang from documents
where regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])(esat|chch)([^\\p{L}\\p{N}_]|$)')""",
    "exists_filter": """
select event_id, nullif(event_type, 'error') as event_type from events
where nullif(event_type, 'error') is not null""",
    "project_and_cast": """
select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "paged_scan": f"""
select o_orderkey, o_totalprice, rn, (rn - 1) // {PAGE_SIZE} as page from (
  select o_orderkey, o_totalprice,
         row_number() over (order by o_totalprice desc nulls last, o_orderkey asc nulls first) as rn
  from orders)""",
    "top_hits": """
select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderstatus = 'F'
order by o_totalprice desc nulls last, o_orderkey limit 10""",
    "conditional_update": """
select event_id, user_id,
       case when user_id = 42 and event_type = 'error' then null else event_type end as event_type
from events""",
    "backfill_merge": """
with src as (select o_orderkey, o_orderpriority, o_orderstatus from orders
             where o_orderdate < timestamp '1997-01-01'),
dst as (select o_orderkey, cast(null as varchar) as o_orderpriority, o_orderstatus from orders
        where o_orderdate >= timestamp '1996-01-01')
select coalesce(s.o_orderkey, d.o_orderkey) as o_orderkey,
       coalesce(s.o_orderpriority, d.o_orderpriority) as o_orderpriority,
       coalesce(s.o_orderstatus, d.o_orderstatus) as o_orderstatus
from dst d full outer join src s on d.o_orderkey = s.o_orderkey""",
    "json_bundle_lines": """
select to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_mktsegment': c_mktsegment})::varchar as line
from customer""",
    "json_line_source": """
select event_id, try_cast(json_extract(props, '$.k') as bigint) as k, cast(null as varchar) as _corrupt
from events""",
    "full_scan_count": """
select count(*) as total from lineitem""",
    "epoch_display": """
select event_id, ms as ts_ms,
       case when ms <= 50000 then cast(ms as varchar)
            else strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') end as ts_display
from (select event_id, epoch_us(ts) // 1000 as ms from events)""",
    "rename_value": f"""
select event_id, user_id,
       case when event_type = '{RENAME_FROM}' then '{RENAME_TO}' else event_type end as event_type
from events""",
    "sequence_last_match": f"""
select * from ({_seq_sql(True)}) order by end_ts desc, id2 desc, start_ts desc, id0 desc limit 1""",
    "time_range_scan": f"""
select event_id, ts, user_id from events
where ts >= timestamp '{RANGE_START}' and ts < timestamp '{RANGE_END}'""",
    "wildcard_type_scan": f"""
select doc_id, lang, source, n_chars from documents where source = '{SCAN_TYPE}'""",
}

ORACLE_SQL["watermark_trace_split"] = ORACLE_SQL["watermark_trace"]
ORACLE_SQL["sequence_match_split"] = ORACLE_SQL["sequence_match"]
ORACLE_SQL["time_pruned_scan"] = ORACLE_SQL["time_range_scan"]
