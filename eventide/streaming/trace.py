"""Watermark trace on a stream (W6): every row with the watermark in force
before it, rows of a micro-batch in arrival order.

A ``foreachBatch`` sink: the batch trace, a distributed prefix scan, runs over
the micro-batch, and the largest event time of all earlier batches is carried
in the commit marker.  Exactly-once as in the other sinks
(:mod:`eventide.streaming.state_log`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.windows import watermark_trace
from eventide.streaming.state_log import commit, last_commit, next_slot

_MARKER = "batch_id bigint, top_us bigint"


class TraceSink:
    def __init__(self, path: str, ts: str, seq: str, delay_us: int = 0):
        self.path, self.ts, self.seq, self.delay_us = path.rstrip("/"), ts, seq, int(delay_us)
        self.out, self.state = f"{self.path}/trace", f"{self.path}/_trace_state"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_commit(spark, self.state, _MARKER)
        if last and batch_id <= last.batch_id:
            return
        carried = last.top_us if last else None
        out = watermark_trace(batch, self.ts, self.seq, self.delay_us)
        if carried is not None:
            before = F.timestamp_micros(F.lit(carried - self.delay_us)).cast(dict(out.dtypes)["watermark"])
            out = (out.withColumn("watermark", F.greatest(F.col("watermark"), before))
                      .withColumn("is_late", F.coalesce(F.col(self.ts) <= F.col("watermark"), F.lit(False))))
        out.write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")
        top = batch.agg(F.max(F.unix_micros(F.col(self.ts).cast("timestamp"))).alias("m")).first()["m"]     # one value
        top = carried if top is None else top if carried is None else max(top, carried)
        commit(spark, self.state, next_slot(last), (batch_id, top), _MARKER)


def watermark_trace_stream(stream: DataFrame, path: str, checkpoint: str, ts: str, seq: str, delay_us: int = 0,
                           available_now: bool = True):
    """Start the stream with the trace sink; returns the StreamingQuery.  The
    rows land under ``<path>/trace``."""
    w = stream.writeStream.foreachBatch(TraceSink(path, ts, seq, delay_us)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
