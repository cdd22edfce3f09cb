"""Streaming twins of the window operators.

The batch functions build the same Column expressions; here they run over
a watermarked stream.  Windowed aggregates are emitted in append mode once
the watermark passes the window end; rows behind the watermark are dropped
before the aggregate (and counted in ``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import windows as batch
from eventide.streaming.processors import HoldUntilClose

PARTS = 16      # lists a window's rows are kept in


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def tumbling_sum(stream: DataFrame, ts: str, size: str, value: str, key: str | None = None,
                 offset: str | None = None) -> DataFrame:
    """Windowed keyed sum (W2): state holds one partial row per open
    (window, key); memory is bounded by the watermark."""
    out = batch.tumbling_sum(stream, ts, size, value, key, offset)
    return _ntz(out, "window_start", "window_end", "last_ts")


def tumbling_count(stream: DataFrame, ts: str, size: str, key: str | None = None,
                   offset: str | None = None) -> DataFrame:
    out = batch.tumbling_count(stream, ts, size, key, offset)
    return _ntz(out, "window_start", "window_end")


def tag_rows(stream: DataFrame, ts: str, size: str, offset: str | None = None) -> DataFrame:
    """Row-preserving window (W3): a projection, no state."""
    out = batch.tag_rows(stream, ts, size, offset)
    return _ntz(out, ts, "window_start", "window_end", "window_max_ts")


def chained_windows(stream: DataFrame, ts: str, size1: str, size2: str,
                    offset2: str | None = None) -> DataFrame:
    """Two windows (W5) without chaining two stateful operators.

    Stage 1 is row-preserving, so both window assignments are computed from
    the same event time before the single stateful aggregation.  Re-applying
    a watermark to stage-1 output would stall: stage 1 could not emit before
    the watermark moved, and the second watermark could not move before
    stage 1 emitted.
    """
    out = batch.chained_windows(stream, ts, size1, size2, offset2)
    return _ntz(out, "window_start", "window_end", "first_w1_start", "last_w1_start")


def two_stage_windows(stream: DataFrame, ts: str, size1: str, size2: str, key: str | None = None) -> DataFrame:
    """Two aggregations in a row (W5), two stateful operators: a window of the
    first stage is emitted when the watermark passes its end, and one of the
    second when the first can emit nothing more into it."""
    return _ntz(batch.two_stage_windows(stream, ts, size1, size2, key), "window_start", "window_end")


def rows_on_close(stream: DataFrame, ts: str, size: str, offset: str | None = None, parts: int = PARTS) -> DataFrame:
    """Row-preserving window that holds its rows until it closes (W3): every row
    with its window's bounds, emitted once the watermark passes the window's end.

    Rows are kept under (window, part), ``parts`` by a hash of the row, so a
    window's rows are spread over tasks, and appended to their list, never
    rewritten.  A row is late, dropped and counted when its window is closed, as
    in a windowed aggregation: the operator's event time is the window's.
    """
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    names = stream.columns
    bare = F.timestamp_micros(F.unix_micros(F.col(ts)))        # an event time of its own would decide what is late
    rows = (stream.withColumn("_w", w).where(F.col("_w").isNotNull())
            .select(F.window_time("_w").alias("closes"), F.pmod(F.xxhash64(*names), F.lit(int(parts))).alias("part"),
                    *[bare.alias(c) if c == ts else F.col(c) for c in names], F.unix_micros("_w.start").alias("window_from")))
    kept = T.StructType([rows.schema[c] for c in (*names, "window_from")])
    out = rows.groupBy("closes", "part").transformWithState(
        HoldUntilClose(kept), T.StructType([T.StructField("closes", T.TimestampType()), *kept.fields]), "Append", "EventTime")
    return _ntz(out.select(*names, F.timestamp_micros("window_from").alias("window_start"),
                           (F.col("closes") + F.expr("interval 1 microsecond")).alias("window_end")), ts, "window_start", "window_end")
