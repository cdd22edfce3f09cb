"""Unkeyed ordered pattern on a stream (T2 without a key).

A stateful operator keyed by a constant would put every row of the stream in
one state group.  This form is a ``foreachBatch`` sink instead: its state is
tables under the shared root, and every step is the distributed batch
operator (:func:`eventide.operators.patterns.sequence_match`).

* The sink keeps its own watermark: the largest event time in milliseconds,
  less the delay, as Spark computes it.  A row at or behind the previous
  watermark, or without event time, is dropped and counted.
* Rows at or behind the new watermark are final: no earlier row can still
  arrive.  The batch pattern runs over them together with the rows retained
  from earlier batches, and complete matches are appended to the output.
* Retained for the next batch: open starts, the rows their partial chains
  point to, and the rows that are not final yet.  A partial chain holds the
  first row of each stage after its start, so re-running the batch pattern on
  retained plus new rows finds the same chain, continued.  With ``within_us``
  a start is kept no longer than its span allows; without, until it completes,
  as the pattern's semantics require.  The state is a table, not one group's
  memory.

Exactly-once as in the buffered sink: output is written under the batch id,
retained rows into the free slot, then a commit marker with the watermark.  A
re-delivered batch at or below the last marker is skipped; a redone batch
overwrites its own output (:mod:`eventide.streaming.state_log`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventide.functions.scalars import concat_ids
from eventide.operators.patterns import sequence_match
from eventide.streaming.state_log import commit, keep, kept_path, last_commit, next_slot

_MARKER = "batch_id bigint, wm_us bigint, dropped bigint"


def dropped_rows(spark: SparkSession, path: str) -> int:
    """Rows the sink at ``path`` has left out as late or without event time."""
    last = last_commit(spark, f"{path.rstrip('/')}/_pattern_state", _MARKER)
    return int(last.dropped) if last else 0


class GlobalPatternSink:
    def __init__(self, path: str, stages: Sequence[Column], ts: str, seq: str, id_col: str,
                 delay_us: int = 0, within_us: int | None = None):
        self.path, self.stages = path.rstrip("/"), list(stages)
        self.ts, self.seq, self.id_col, self.delay_us = ts, seq, id_col, int(delay_us)
        self.within_us = None if within_us is None else int(within_us)
        self.out, self.state = f"{self.path}/matches", f"{self.path}/_pattern_state"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_commit(spark, self.state, _MARKER)
        wm, dropped = (last.wm_us, int(last.dropped)) if last else (None, 0)
        if last and batch_id <= last.batch_id:
            return
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        timely = us.isNotNull() if wm is None else us.isNotNull() & (us > F.lit(wm))
        seen = Observation()
        rows = batch.observe(seen, F.count_if(~timely).alias("dropped")).where(timely)
        if last:
            rows = spark.read.schema(batch.schema).parquet(kept_path(self.state, last.slot)).unionByName(rows)
        rows = rows.cache()   # read four times; lost blocks are recomputed from the inputs
        try:
            top = rows.agg(F.max(us).alias("m")).first()["m"]   # one value to the driver
            new_wm = wm
            if top is not None:
                cand = (int(top) // 1000) * 1000 - self.delay_us
                new_wm = cand if wm is None else max(wm, cand)
            final = rows.where(us <= F.lit(new_wm)) if new_wm is not None else rows.limit(0)
            pending = rows.where(us > F.lit(new_wm)) if new_wm is not None else rows
            k = len(self.stages)
            # a start is known by its (time, sequence number), whatever its id
            chains = sequence_match(final.withColumn("_row", F.struct(F.col(self.ts).alias("ts"), F.col(self.seq).alias("seq"), F.col(self.id_col).alias("id"))),
                                    self.stages, self.ts, self.seq, "_row", within_us=self.within_us, partials=True).cache()
            try:
                (chains.where("complete")
                       .select(*[F.col(f"id{i}")["id"].alias(f"id{i}") for i in range(k)], "start_ts", "end_ts")
                       .withColumn("ids", concat_ids(*[f"id{i}" for i in range(k)]))
                       .write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}"))
                waiting = ~F.col("complete") & F.col(f"id{k - 1}").isNull()
                if self.within_us is not None and new_wm is not None:
                    # every later row is newer than the watermark
                    waiting = waiting & (F.unix_micros(F.col("start_ts").cast("timestamp")) + self.within_us > F.lit(new_wm))
                held = (chains.where(waiting).select(F.explode(F.array(*[f"id{i}" for i in range(k - 1)])).alias("_r"))
                              .where("_r is not null").select(F.col("_r.ts").alias("_ts"), F.col("_r.seq").alias("_seq"))
                              .distinct())
                kept = final.join(held, (final[self.ts] == held["_ts"]) & (final[self.seq] == held["_seq"]), "left_semi")
                slot = next_slot(last)
                keep(kept.unionByName(pending), self.state, slot)
            finally:
                chains.unpersist()
            commit(spark, self.state, slot, (batch_id, new_wm, dropped + int(seen.get["dropped"])), _MARKER)
        finally:
            rows.unpersist()


def global_pattern_stream(stream: DataFrame, path: str, checkpoint: str, stages: Sequence[Column],
                          ts: str, seq: str, id_col: str, delay_us: int = 0,
                          available_now: bool = True, within_us: int | None = None):
    """Start the stream with the pattern sink; returns the StreamingQuery.
    Matches land under ``<path>/matches``; :func:`dropped_rows` tells how many
    late or timeless rows were left out."""
    sink = GlobalPatternSink(path, stages, ts, seq, id_col, delay_us, within_us)
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
