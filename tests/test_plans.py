"""Physical-plan checks: pushdown, pruning, shuffles, no single-partition
exchange over a fact table."""

import contextlib
import io

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from eventide.functions import predicates as P
from eventide.sources.tables import time_range_scan, write_time_partitioned

Q = E.queries()


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_pushed_and_columns_pruned(spark):
    p = _plan(Q["terms_top10"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    p = _plan(Q["cardinality_exact"](spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p


def test_range_and_type_scans_push_down(spark):
    p = _plan(Q["time_range_scan"](spark, SF001))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00), LessThan(ts,2024-01-12T00:00)" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p
    p = _plan(Q["wildcard_type_scan"](spark, SF001))
    assert "EqualTo(source,src7)" in p
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in p


def test_top_n_is_bounded(spark):
    assert "TakeOrderedAndProject" in _plan(Q["terms_top10"](spark, SF001))
    assert "WindowGroupLimit" in _plan(Q["histogram_top_terms"](spark, SF001))


def test_global_order_without_single_partition(spark):
    """Nothing but partial aggregates (a row per task) and bucket summaries (a
    row per bucket) may meet in one partition."""
    for name in ("watermark_trace", "paged_scan", "paged_scan_by_name", "buffered_sink_latest", "sequence_match_global"):
        df = Q[name](spark, SF001)
        assert "Window" in _plan(df)
        assert _single_partition_inputs(df) <= {"HashAggregate", "SortAggregate", "ObjectHashAggregate"}
    # the check itself can fail
    bare = spark.range(10).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert _single_partition_inputs(bare) - {"HashAggregate"}


def _single_partition_inputs(df) -> set[str]:
    """Operators that feed a single-partition exchange, projections passed over."""
    p = _plan(df)
    tree = {}           # operator id -> (depth, name), in the order of the trees
    found, lines = set(), [re.match(r"([\s:|+*-]*)(\w[\w ]*?) \((\d+)\)", x) for x in p.splitlines()]
    single = set(re.findall(r"\((\d+)\) Exchange\n(?:[^\n]+\n)*?Arguments: SinglePartition", p))
    lines = [(len(m[1]), m[2].strip(), m[3]) for m in lines if m]
    for i, (_, name, at) in enumerate(lines):
        if name == "Exchange" and at in single:
            below = [n for _, n, _ in lines[i + 1:]]
            found.add(next(n for n in below if n not in ("Project", "ColumnarToRow", "Filter")))
    return found


def test_bool_query_is_pushed_down(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").where(P.bool_query(
        must_=[F.col("n_chars") > 200], must_not_=[P.term("lang", "de"), P.term("source", "src3"), P.range_between("doc_id", 5, 9)]))
    pushed = re.search(r"PushedFilters: \[(.*)\]", _plan(df))[1]
    for part in ("GreaterThan(n_chars,200)", "Or(IsNull(lang),Not(EqualTo(lang,de)))", "Or(IsNull(source),Not(EqualTo(source,src3)))",
                 "LessThan(doc_id,5)"):
        assert part in pushed, pushed
    assert "EqualTo(source,src3)" in _plan(Q["bool_must_mustnot"](spark, SF001)).split("PushedFilters")[1].split("\n")[0]


def test_approximate_count_sends_one_sketch_per_task(spark):
    from eventide.operators import aggregates as A
    p = _plan(A.cardinality(spark.read.parquet(f"{SF001}/events.parquet"), "user_id"))
    assert p.count("Exchange (") == 1 + p.count("ReusedExchange (") and "Expand" not in p
    assert "Expand" not in _plan(Q["terms_and_avg_one_pass"](spark, SF001)).split("Scan parquet")[0].split("Exchange")[-1]


def test_scans_of_ordered_operators(spark):
    """Two scans, the rows and the map-side summaries (only the pattern's middle
    stage is summarised from the shuffled rows, which it reuses; the timeout has
    two summaries), and a bucket search without lambdas."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # reuse is then in the static plan
    try:
        for name in ("sequence_match", "running_reduce", "inactivity_timeout", "paged_scan", "watermark_trace"):
            df = Q[name](spark, SF001)
            spark.conf.set("spark.sql.adaptive.enabled", "false")     # the query sets the library's own
            plan = _plan(df)
            schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
            assert len(schemas) == 2 + (name == "inactivity_timeout"), (name, schemas)
            assert "aggregate(" not in plan and "lambdafunction" not in plan.split("Subqueries")[0], name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_plan_of_mixed_orders_is_made_at_once(spark):
    """The bucket is a join key; traced to the scan through every search step it
    took 18 s at 128 buckets, eight times that for each doubling, and then the
    driver's memory."""
    import time
    from eventide.operators import ordering
    df = spark.range(0, 3000, 1, 4).selectExpr("id", "cast(id % 7 as string) as s", "nullif(id * 37 % 101, 5) as v")
    order = [("s", False), ("v", True), ("id", False)]
    out = ordering.paginate(df, order, 10, n_buckets=512)
    t = time.time()
    out._jdf.queryExecution().optimizedPlan()
    assert time.time() - t < 10
    w = Window.orderBy(F.col("s").desc_nulls_last(), F.col("v").asc_nulls_first(), F.col("id").desc_nulls_last())
    want = df.withColumn("rn", F.row_number().over(w).cast("bigint")).withColumn("page", F.expr("(rn - 1) div 10"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def _executed_exchanges(df):
    import re
    df.collect()                                   # AQE: inspect the final plan
    text = _plan(df)
    tree = text.split("+- == Initial Plan ==")[0]
    ids = set(re.findall(r"[-:] Exchange \((\d+)\)", tree))   # executed shuffles
    details = {b.split(")")[0].lstrip("("): b for b in text.split("\n\n") if b.startswith("(")}
    # a shuffle moves table rows when its input still has the row id column
    moving_rows = [i for i in ids
                   if "event_id#" in details[i].split("Input [")[1].split("\n")[0]]
    return ids, moving_rows, tree


def test_pattern_shuffles_the_table_once(spark):
    # users cut into buckets: summaries shuffle too, the rows once, and both
    # passes read that one shuffle
    ids, moving_rows, tree = _executed_exchanges(Q["sequence_match"](spark, SF001))
    assert len(ids) >= 3 and len(moving_rows) == 1, moving_rows
    assert "ReusedExchange" in tree


def test_time_pruned_scan_prunes_partitions(spark, scratch):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    write_time_partitioned(ev, scratch, "ts")
    df = time_range_scan(spark, scratch, "ts", "2024-01-05 00:00:00", "2024-01-07 00:00:00")
    p = _plan(df)
    assert "PartitionFilters: [isnotnull(dt" in p
    ref = ev.where((F.col("ts") >= "2024-01-05") & (F.col("ts") < "2024-01-07")).count()
    assert df.count() == ref
