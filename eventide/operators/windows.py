"""Event-time windows in batch form.

Tumbling windows are Spark's ``window`` expression: aggregations become a
partial/final hash aggregate on (window, key), row-preserving windows are a
plain projection with no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.plans import prefix


def _keys(key: str | Sequence[str] | None) -> list[str]:
    if key is None:
        return []  # constant key: the window alone is the group (W0)
    return [key] if isinstance(key, str) else list(key)


def tumbling_agg(df: DataFrame, ts: str, size: str, aggs: Sequence[Column],
                 key: str | Sequence[str] | None = None, offset: str | None = None) -> DataFrame:
    """Keyed tumbling-window aggregation.

    Output has ``window_start``, ``window_end``, the key columns and ``aggs``.
    """
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    out = df.groupBy(w.alias("_w"), *_keys(key)).agg(*aggs)
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *[c for c in out.columns if c != "_w"])


def tumbling_sum(df: DataFrame, ts: str, size: str, value: str, key: str | None = None,
                 offset: str | None = None) -> DataFrame:
    """Sum, count and latest event time per (window, key).

    The sum is in the value's own type, no digit dropped; a caller who wants a
    sum that does not depend on the order of addition passes a DECIMAL.
    """
    aggs = [F.sum(value).alias("sum_value"),
            F.count(F.lit(1)).alias("n"),
            F.max(ts).alias("last_ts")]
    return tumbling_agg(df, ts, size, aggs, key, offset)


def tumbling_count(df: DataFrame, ts: str, size: str, key: str | None = None,
                   offset: str | None = None) -> DataFrame:
    """Row count per (window, key)."""
    return tumbling_agg(df, ts, size, [F.count(F.lit(1)).alias("n")], key, offset)


def tag_rows(df: DataFrame, ts: str, size: str, offset: str | None = None,
             prefix_: str = "window") -> DataFrame:
    """Row-preserving window: every row gets its window bounds and the
    window's last millisecond (W3).  A projection: no shuffle, no state."""
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    return (df.withColumn("_w", w)
              .withColumn(f"{prefix_}_start", F.col("_w.start"))
              .withColumn(f"{prefix_}_end", F.col("_w.end"))
              .withColumn(f"{prefix_}_max_ts", F.col("_w.end") - F.expr("INTERVAL 1 MILLISECOND"))
              .drop("_w"))


def chained_windows(df: DataFrame, ts: str, size1: str, size2: str, offset2: str | None = None,
                    flag: str = "window1") -> DataFrame:
    """Two windows in a row.

    Stage 1 passes every row through with its window and a constant flag
    (P3); stage 2 re-windows the same event time (with an optional offset)
    and counts, under a constant key (W0).  Both stages are evaluated in one
    aggregation: stage 1 is row-preserving, so it adds no shuffle.
    """
    stage1 = tag_rows(df, ts, size1, prefix_="w1").withColumn("flag", F.lit(flag))
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("flag") == F.lit(flag)).alias("n_flagged"),
            F.min("w1_start").alias("first_w1_start"),
            F.max("w1_start").alias("last_w1_start")]
    return tumbling_agg(stage1, ts, size2, aggs, None, offset2)


def two_stage_windows(df: DataFrame, ts: str, size1: str, size2: str, key: str | Sequence[str] | None = None) -> DataFrame:
    """A second aggregation over the results of a first (W5): rows counted per
    (window of ``size1``, key), then per window of ``size2`` the number of those
    groups, their rows and the largest.  Stage 2 sees a group at the end of its
    first window (``window_time``), which keeps the event time that a stream's
    watermark follows: on a stream these are two stateful operators in a row.
    """
    first = df.groupBy(F.window(ts, size1).alias("_w1"), *_keys(key)).agg(F.count(F.lit(1)).alias("_n"))
    second = first.groupBy(F.window(F.window_time("_w1"), size2).alias("_w2"))
    out = second.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("n"), F.max("_n").alias("largest"))
    return out.select(F.col("_w2.start").alias("window_start"), F.col("_w2.end").alias("window_end"), "groups", "n", "largest")


def apply_to_windows(df: DataFrame, ts: str, size: str, func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                     schema: str, key: str | Sequence[str] | None = None, offset: str | None = None) -> DataFrame:
    """Any function of a whole window (and key): ``func`` reads the window's
    rows, all columns of ``df``, as Arrow batches one after the other and yields
    batches of ``schema``; ``window_start``, ``window_end`` and the keys are put
    before its columns.  A window is never one frame: what is in memory beside a
    batch is what ``func`` keeps.  Rows without event time are in no window.
    """
    keys = _keys(key)
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    rows = (df.withColumn("window_start", w["start"]).withColumn("window_end", w["end"]).where("window_start is not null"))
    own = T.StructType.fromDDL(schema)
    bounds = [rows.schema[c] for c in ("window_start", "window_end", *keys)]
    names, drop = [f.name for f in bounds], [rows.columns.index(c) for c in ("window_start", "window_end")]
    order = [f.name for f in own.fields]

    def run(group: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = [i for i in range(b.num_columns) if i not in drop]
                yield pa.RecordBatch.from_arrays([b.column(i) for i in keep], names=[b.schema.names[i] for i in keep])

        for out in func(given()):
            yield pa.RecordBatch.from_arrays([*(pa.repeat(k, out.num_rows) for k in group), *(out.column(out.schema.get_field_index(n)) for n in order)],
                                             names=[*names, *order])

    run.__annotations__ = {"group": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return rows.groupBy("window_start", "window_end", *keys).applyInArrow(run, T.StructType([*bounds, *own.fields]))


def watermark_trace(df: DataFrame, ts: str, seq: str, delay_us: int = 0,
                    n_buckets: int | None = None) -> DataFrame:
    """The watermark in force before each row, in arrival order ``seq``.

    ``watermark = max(ts of all earlier rows) - delay``; the first row has
    none (NULL).  ``is_late`` marks rows at or behind it.  Global order is
    handled by the bucketed prefix scan, never by one partition.
    """
    b, kcols, raw = prefix.prepare(df, [], [seq], n_buckets)
    out = prefix.running(b, kcols, [seq], {"_maxprev": (F.col(ts), "max", False)}, raw)
    wm = F.col("_maxprev") - F.make_dt_interval(secs=F.lit(delay_us / 1e6).cast("decimal(18,6)"))
    return (out.withColumn("watermark", wm)
               .withColumn("is_late", F.coalesce(F.col(ts) <= F.col("watermark"), F.lit(False)))
               .transform(lambda d: prefix.cleanup(d, kcols)).drop("_maxprev"))
