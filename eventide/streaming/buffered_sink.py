"""Buffered file sink for streams (T3, streaming form).

Rows are cut into buffers of ``n`` in arrival (``seq``) order across
micro-batches; each full buffer is written under ``file_name=<key of its last
row>``, replacing the earlier content of that name.  The partial last buffer
is carried to the next micro-batch in a versioned table.

Exactly-once: every micro-batch writes its carry into the free one of two
slots and then a commit marker holding the number of rows consumed so far.  A
re-delivered batch id at or below the last marker is skipped; a batch that
failed before its marker is redone with the same inputs, and its output
overwrite is idempotent.  Nothing is kept in driver or executor memory
between batches (:mod:`eventide.streaming.state_log`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.keyed import row_numbers
from eventide.streaming.state_log import commit, keep, kept_path, last_commit, next_slot

_MARKER = "batch_id bigint, consumed bigint"


class BufferedSink:
    def __init__(self, path: str, name_col: str, seq: str, n: int, fmt: str = "json"):
        self.path, self.name_col, self.seq, self.n, self.fmt = path.rstrip("/"), name_col, seq, n, fmt
        self.state = f"{self.path}/_buffer_state"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_commit(spark, self.state, _MARKER)
        consumed = int(last.consumed) if last else 0
        if last and batch_id <= last.batch_id:
            return
        rows = batch
        if last:
            rows = spark.read.schema(batch.schema).parquet(kept_path(self.state, last.slot)).unionByName(batch)
        numbered = (row_numbers(rows, [], [self.seq], "_rn")
                    .withColumn("_pos", F.col("_rn") + F.lit(consumed))
                    .withColumn("buffer_idx", F.expr(f"(_pos - 1) div {self.n}")).drop("_rn"))
        # reused by three writes; lost blocks are recomputed from the batch's files
        numbered = numbered.cache()
        try:
            per_buf = (numbered.groupBy("buffer_idx")
                       .agg(F.count(F.lit(1)).alias("buffer_rows"),
                            F.max_by(self.name_col, self.seq).alias("file_name")))
            full = per_buf.where(F.col("buffer_rows") == self.n)
            last_full = full.groupBy("file_name").agg(F.max("buffer_idx").alias("buffer_idx"))
            out = numbered.join(last_full, "buffer_idx").drop("_pos")
            (out.write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
                .partitionBy("file_name").format(self.fmt).save(self.path))
            n_full = full.count()
            tail = numbered.join(per_buf.where(F.col("buffer_rows") < self.n).select("buffer_idx"),
                                 "buffer_idx").select(*batch.columns)
            slot = next_slot(last)
            keep(tail, self.state, slot)
            commit(spark, self.state, slot, (batch_id, consumed + n_full * self.n), _MARKER)
        finally:
            numbered.unpersist()


def buffered_sink_stream(stream: DataFrame, path: str, checkpoint: str, name_col: str, seq: str,
                         n: int, available_now: bool = True):
    """Start the stream with the buffered sink; returns the StreamingQuery."""
    sink = BufferedSink(path, name_col, seq, n)
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
