"""Keyed streams whose hot keys are split.

Under ``transformWithState`` all rows that one key has in a micro-batch are
handled by one call.  Where a key may hold a third of the stream, these sinks
keep the state of the keys in a table instead and advance it, micro-batch by
micro-batch, with the distributed batch operators: the state enters as rows in
front of the key's new ones, so the prefix scan cuts a hot key over many tasks
and no join is needed.

The table is cut into buckets by a hash of the key.  A batch reads and rewrites
only the buckets it touches: those of its keys, and those that a passing
watermark makes due.  Each bucket has two slots used in turn; a commit marker
names the slot and the batch that wrote it, so a crash at any point leaves the
last committed state whole, and a re-delivered batch is skipped or redone with
the same result.  Output rows land under ``<path>/rows/batch=<id>``.

T1 and T2 keep their own watermark, the largest event time less the delay, in
milliseconds, as Spark does.  Rows at or behind the previous watermark, and
rows without event time, are dropped and counted (:func:`dropped_rows`); rows
ahead of the new one wait in the table.  Unlike Spark's, this watermark has no
start, so event times before 1970 are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.scalars import concat_ids
from eventide.operators import reducers
from eventide.operators.patterns import sequence_match
from eventide.plans import prefix
from eventide.streaming.state_log import commit, last_commit, next_slot

BUCKETS = 64
_MARKER = "batch_id bigint, wm_us bigint, dropped bigint, written map<int,bigint>, due map<int,bigint>"
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def dropped_rows(spark: SparkSession, path: str) -> int:
    """Rows the sink at ``path`` has left out as late or without event time."""
    last = last_commit(spark, f"{path.rstrip('/')}/_state", _MARKER)
    return int(last.dropped) if last else 0


class KeyedTableSink:
    """``advance`` makes output rows and the new state of the touched buckets."""

    timed = False
    late = False        # keep rows that come too late, under ``<path>/late``

    def __init__(self, path: str, key: str, buckets: int = BUCKETS):
        self.path, self.key, self.buckets = path.rstrip("/"), key, int(buckets)
        self.out, self.state, self.table = f"{self.path}/rows", f"{self.path}/_state", f"{self.path}/_state/table"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def state_type(self, batch: DataFrame) -> T.StructType:
        raise NotImplementedError

    def advance(self, batch: DataFrame, state: DataFrame, wm: int | None) -> tuple[DataFrame, DataFrame]:
        raise NotImplementedError

    def late_at(self, us: Column) -> Column:
        """The watermark, in microseconds, at or behind which a row is too late."""
        return us

    def due(self) -> Column:
        """When, in microseconds, a state row needs its bucket again."""
        return F.lit(None).cast("bigint")

    def _read(self, spark: SparkSession, schema: T.StructType, touched: set[int], written: dict[int, int]) -> DataFrame:
        """The state rows of the touched buckets, as last committed."""
        out = None
        stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        for slot in (0, 1):
            own = {b: v // 2 for b, v in written.items() if b in touched and v % 2 == slot}
            if own:
                rows = spark.read.schema(stored).parquet(*[f"{self.table}/slot={slot}/bucket={b}" for b in sorted(own)])
                part = rows.where(F.col("batch").isin(sorted(set(own.values())))).drop("batch")
                out = part if out is None else out.unionByName(part)
        return spark.createDataFrame([], schema) if out is None else out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_commit(spark, self.state, _MARKER)
        if last and batch_id <= last.batch_id:
            return
        written, due = (dict(last.written), dict(last.due)) if last else ({}, {})
        wm, dropped = (last.wm_us, int(last.dropped)) if last else (None, 0)
        rows, new_wm, seen = batch, wm, Observation()
        if self.timed:
            us = F.unix_micros(F.col(self.ts).cast("timestamp"))
            timely = us.isNotNull() if wm is None else us.isNotNull() & (self.late_at(us) > F.lit(wm))
            if self.late:
                batch.where(~timely).write.mode("overwrite").parquet(f"{self.path}/late/batch={batch_id}")
            rows = batch.observe(seen, F.count_if(~timely).alias("dropped")).where(timely)
        rows = rows.cache()         # read several times; lost blocks are recomputed from the batch's files
        try:
            touched = {r[0] for r in rows.select(self.bucket()).distinct().collect()}       # one number a bucket
            if self.timed:
                top = rows.agg(F.max(us)).first()[0]
                if top is not None:
                    own = (int(top) // 1000) * 1000 - self.delay_us
                    new_wm = own if wm is None else max(wm, own)
                if new_wm is not None:
                    touched |= {b for b, at in due.items() if at <= new_wm}
            schema = self.state_type(batch)
            state = self._read(spark, schema, touched, written)
            out, new = self.advance(rows, state, new_wm)
            out.write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")
            slots = {b: 1 - written[b] % 2 if b in written else 0 for b in touched}
            slot = F.create_map(*[F.lit(x) for p in slots.items() for x in p])[F.col("bucket")] if slots else F.lit(0)
            placed = (new.select(*[f.name for f in schema.fields], F.lit(batch_id).cast("bigint").alias("batch"), self.bucket().alias("bucket"))
                      .withColumn("slot", slot))
            if touched:
                (placed.repartition("bucket").write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
                 .partitionBy("slot", "bucket").parquet(self.table))
                kept = spark.read.schema(placed.schema).parquet(self.table)
                found = (kept.where((F.col("batch") == batch_id) & F.col("bucket").isin(sorted(touched)))
                         .groupBy("slot", "bucket").agg(F.min(self.due()).alias("due")).collect())      # a row a bucket
                for b in touched:
                    written.pop(b, None)
                    due.pop(b, None)
                for r in found:
                    if r.slot == slots[r.bucket]:
                        written[r.bucket] = batch_id * 2 + r.slot
                        if r.due is not None:
                            due[r.bucket] = r.due
            commit(spark, f"{self.state}", next_slot(last),
                   (batch_id, new_wm, dropped + (int(seen.get["dropped"]) if self.timed else 0), written, due), _MARKER)
        finally:
            rows.unpersist()


def _start(sink: KeyedTableSink, stream: DataFrame, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


# --------------------------------------------------------------------------- A8

class RunningReduceTable(KeyedTableSink):
    """State: the key's reduced value so far."""

    def __init__(self, path: str, key: str, seq: str, value: str, name: str, op: str, buckets: int, n_buckets: int | None):
        super().__init__(path, key, buckets)
        self.seq, self.value, self.name, self.op, self.n = seq, value, name, op, n_buckets

    def _total(self) -> Column:
        merged = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[self.op]
        return merged("_part").alias("total")

    def state_type(self, batch: DataFrame) -> T.StructType:
        part = F.count(self.value) if self.op == "count" else {"sum": F.sum, "max": F.max, "min": F.min}[self.op](self.value)
        return batch.groupBy(self.key).agg(part.alias("total")).schema

    def advance(self, batch, state, wm):
        given = F.col(self.value).isNotNull().cast("bigint") if self.op == "count" else F.col(self.value)
        kind = state.schema["total"].dataType
        old = state.select(self.key, F.lit(None).cast(batch.schema[self.seq].dataType).alias(self.seq),
                           F.lit(None).cast(batch.schema[self.value].dataType).alias(self.value), F.col("total").alias("_part"), F.lit(0).alias("_fresh"))
        rows = old.unionByName(batch.select(self.key, self.seq, self.value, given.cast(kind).alias("_part"), F.lit(1).alias("_fresh")))
        op = "sum" if self.op == "count" else self.op
        order = ["_fresh", self.seq]
        b, kcols, raw = prefix.prepare(rows, [self.key], order, self.n)
        out = prefix.cleanup(prefix.running(b, kcols, order, {self.name: (F.col("_part"), op, True)}, raw), kcols).where("_fresh = 1")
        new = rows.groupBy(self.key).agg(self._total().cast(kind).alias("total"))
        return out.select(*dict.fromkeys([self.key, self.seq, self.value]), F.col(self.name).cast(kind).alias(self.name)), new


def running_reduce(stream: DataFrame, path: str, checkpoint: str, key: str, seq: str, value: str, name: str = "running_sum",
                   op: str = "sum", buckets: int = BUCKETS, n_buckets: int | None = None, available_now: bool = True):
    """Start the stream: every row with its key's ``value`` reduced so far, rows
    of a micro-batch in ``seq`` order; ``op`` is sum, count, max or min."""
    src = stream.select(*dict.fromkeys([key, seq, value]))
    return _start(RunningReduceTable(path, key, seq, value, name, op, buckets, n_buckets), src, checkpoint, available_now)


# --------------------------------------------------------------------------- A9

class CountWindowTable(KeyedTableSink):
    """State: the windows a key has completed, and the rows of its open one."""

    def __init__(self, path: str, key: str, seq: str, value: str, size: int, buckets: int, n_buckets: int | None):
        super().__init__(path, key, buckets)
        self.seq, self.value, self.size, self.n = seq, value, int(size), n_buckets

    def state_type(self, batch: DataFrame) -> T.StructType:
        row = T.StructType([T.StructField("s", batch.schema[self.seq].dataType), T.StructField("v", batch.schema[self.value].dataType)])
        return T.StructType([batch.schema[self.key], T.StructField("done", T.LongType()), T.StructField("open", T.ArrayType(row))])

    def advance(self, batch, state, wm):
        seq, value = F.col(self.seq), F.col(self.value)
        none = [F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in (self.seq, self.value)]
        marks = state.select(self.key, *none, F.lit(0).alias("_fresh"), F.lit(0).alias("_row"), F.col("done").alias("_done"))
        held = (state.select(self.key, F.explode("open").alias("o"))
                .select(self.key, F.col("o.s").alias(self.seq), F.col("o.v").alias(self.value), F.lit(1).alias("_fresh"), F.lit(1).alias("_row"),
                        F.lit(None).cast("bigint").alias("_done")))
        new = batch.select(self.key, self.seq, self.value, F.lit(2).alias("_fresh"), F.lit(1).alias("_row"), F.lit(None).cast("bigint").alias("_done"))
        rows, order = marks.unionByName(held).unionByName(new), ["_fresh", self.seq]
        b, kcols, raw = prefix.prepare(rows, [self.key], order, self.n)
        run = prefix.running(b, kcols, order, {"_rn": (F.col("_row"), "sum", True), "_before": (F.col("_done"), "max", True)}, raw)
        run = prefix.cleanup(run, kcols).withColumn("_before", F.coalesce("_before", F.lit(0).cast("bigint")))
        windows = (run.where("_row = 1").withColumn("window_idx", F.col("_before") + F.expr(f"(_rn - 1) div {self.size}"))
                   .groupBy(self.key, "window_idx")
                   .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"),
                        F.array_sort(F.collect_list(F.struct(F.col("_fresh").alias("f"), seq.alias("s"), value.alias("v")))).alias("_rows")))     # at most ``size``
        whole = dict(batch.dtypes)[self.value] in _WHOLE
        avg = F.expr(f"_s div {self.size}") if whole else F.col("_s") / F.lit(self.size)
        out = windows.where(F.col("_n") == self.size).select(self.key, "window_idx", avg.alias("avg_value"), "first_seq", "last_seq")
        total = run.groupBy(self.key).agg((F.max("_before") + F.expr(f"coalesce(sum(_row), 0) div {self.size}")).alias("done"))
        part = (windows.where(F.col("_n") < self.size)
                .select(F.col(self.key).alias("_key"), F.transform("_rows", lambda r: F.struct(r["s"].alias("s"), r["v"].alias("v"))).alias("open")))
        kept = total.join(part, F.col(self.key).eqNullSafe(F.col("_key")), "left")      # a row a key on either side
        return out, kept.select(self.key, "done", F.coalesce("open", F.array().cast(kept.schema["open"].dataType)).alias("open"))


def count_window_avg(stream: DataFrame, path: str, checkpoint: str, key: str, seq: str, value: str, n: int = 2,
                     buckets: int = BUCKETS, n_buckets: int | None = None, available_now: bool = True):
    """Start the stream: the average of every ``n`` rows of a key, as in batch."""
    src = stream.select(*dict.fromkeys([key, seq, value]))
    return _start(CountWindowTable(path, key, seq, value, n, buckets, n_buckets), src, checkpoint, available_now)


# --------------------------------------------------------------------------- T1

class TimeoutTable(KeyedTableSink):
    """State: per key its count, last time and whether that was reported, and
    the rows ahead of the watermark."""

    timed = True

    def __init__(self, path: str, key: str, ts: str, seq: str, gap_us: int, delay_us: int, buckets: int, n_buckets: int | None):
        super().__init__(path, key, buckets)
        self.ts, self.seq, self.gap, self.delay_us, self.n = ts, seq, int(gap_us), int(delay_us), n_buckets

    def state_type(self, batch: DataFrame) -> T.StructType:
        return T.StructType([batch.schema[self.key], T.StructField("us", T.LongType()), T.StructField("s", batch.schema[self.seq].dataType),
                             T.StructField("count", T.LongType()), T.StructField("waits", T.BooleanType()), T.StructField("fired", T.BooleanType())])

    def due(self) -> Column:
        return F.when(F.col("waits"), F.col("us")).when(~F.col("fired"), F.col("us") + F.lit(self.gap))

    def advance(self, batch, state, wm):
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        new = batch.select(self.key, us.alias("us"), F.col(self.seq).alias("s"), F.lit(1).cast("bigint").alias("count"),
                           F.lit(True).alias("waits"), F.lit(False).alias("fired"))
        rows = state.unionByName(new)
        ready = ~F.col("waits") | (F.col("us") <= F.lit(wm)) if wm is not None else ~F.col("waits")
        final = rows.where(ready).withColumn("_fresh", F.col("waits").cast("int"))
        order = ["us", "_fresh", "s"]
        b, kcols, raw = prefix.prepare(final, [self.key], order, self.n)
        run = prefix.running(b, kcols, order, {"_count": (F.col("count"), "sum", True)}, raw)
        run = prefix.cleanup(prefix.next_match(run, kcols, order, F.lit(True), F.col("us"), "_next", raw, payload_is_order_key=True), kcols)
        over = F.col("us") + F.lit(self.gap)
        late = (F.col("_next") > over) | (F.col("_next").isNull() & ((over <= F.lit(wm)) if wm is not None else F.lit(False)))
        fires = ~F.col("fired") & late
        out = run.where(fires).select(self.key, F.col("_count").alias("count"), F.timestamp_micros("us").alias("last_ts"), F.timestamp_micros(over).alias("fire_ts"))
        tails = run.where("_next is null").select(self.key, "us", "s", F.col("_count").alias("count"), F.lit(False).alias("waits"),
                                                  (F.col("fired") | F.coalesce(late, F.lit(False))).alias("fired"))
        return out, tails.unionByName(rows.where(~ready))


def inactivity_timeout(stream: DataFrame, path: str, checkpoint: str, key: str, ts: str, seq: str, gap_us: int, delay_us: int = 0,
                       buckets: int = BUCKETS, n_buckets: int | None = None, available_now: bool = True):
    """Start the stream: ``(key, count, last_ts, fire_ts)`` once the watermark
    has passed a key's last row by ``gap_us``.  ``(ts, seq)`` tells a key's rows apart."""
    src = stream.select(*dict.fromkeys([key, ts, seq]))
    return _start(TimeoutTable(path, key, ts, seq, gap_us, delay_us, buckets, n_buckets), src, checkpoint, available_now)


# --------------------------------------------------------------------------- T2

class PatternTable(KeyedTableSink):
    """State: open starts, the rows their chains have reached, and the rows
    ahead of the watermark.  A row kept only for another start's chain starts
    nothing again."""

    timed = True

    def __init__(self, path: str, key: str, stages: Sequence[Column], ts: str, seq: str, id_col: str, delay_us: int,
                 within_us: int | None, buckets: int, n_buckets: int | None):
        super().__init__(path, key, buckets)
        self.stages, self.ts, self.seq, self.id_col, self.delay_us = list(stages), ts, seq, id_col, int(delay_us)
        self.within_us, self.n = within_us, n_buckets

    def state_type(self, batch: DataFrame) -> T.StructType:
        return T.StructType([batch.schema[self.key], T.StructField("us", T.LongType()), T.StructField("s", batch.schema[self.seq].dataType),
                             T.StructField("i", batch.schema[self.id_col].dataType), T.StructField("mask", T.IntegerType()), T.StructField("waits", T.BooleanType())])

    def due(self) -> Column:
        return F.when(F.col("waits"), F.col("us"))

    def advance(self, batch, state, wm):
        k = len(self.stages)
        mask = sum((F.when(F.coalesce(s, F.lit(False)), F.lit(1 << j)).otherwise(F.lit(0)) for j, s in enumerate(self.stages)), F.lit(0)).cast("int")
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        new = (batch.select(self.key, us.alias("us"), F.col(self.seq).alias("s"), F.col(self.id_col).alias("i"), mask.alias("mask"), F.lit(True).alias("waits"))
               .where("mask <> 0"))
        rows = state.unionByName(new)
        ready = ~F.col("waits") | (F.col("us") <= F.lit(wm)) if wm is not None else ~F.col("waits")
        final = rows.where(ready).withColumn("_at", F.timestamp_micros("us")).withColumn("_r", F.struct("us", "s", "i", "mask"))
        hits = [F.col("mask").bitwiseAND(F.lit(1 << j)) != 0 for j in range(k)]
        chains = sequence_match(final, hits, "_at", "s", "_r", key=self.key, n_buckets=self.n, within_us=self.within_us, partials=True)
        out = (chains.where("complete")
               .select(self.key, *[F.col(f"id{j}")["i"].alias(f"id{j}") for j in range(k)], "start_ts", "end_ts")
               .withColumn("ids", concat_ids(*[f"id{j}" for j in range(k)])))
        waiting = ~F.col("complete") & F.col(f"id{k - 1}").isNull()
        if self.within_us is not None and wm is not None:       # every later row is newer than the watermark
            waiting = waiting & (F.col("id0.us") + F.lit(self.within_us) > F.lit(wm))
        parts = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"id{j}").alias("r")) for j in range(k - 1)])
        kept = (chains.where(waiting).select(self.key, F.explode(parts).alias("p")).where("p.r is not null")
                .groupBy(self.key, F.col("p.r.us").alias("us"), F.col("p.r.s").alias("s"), F.col("p.r.i").alias("i"), F.col("p.r.mask").alias("mask"))
                .agg((F.min("p.j") == 0).alias("starts"))
                .select(self.key, "us", "s", "i", F.when(F.col("starts"), F.col("mask")).otherwise(F.col("mask").bitwiseAND(F.lit(-2))).alias("mask"), F.lit(False).alias("waits")))
        return out, kept.unionByName(rows.where(~ready))


def sequence_match_stream(stream: DataFrame, path: str, checkpoint: str, stages: Sequence[Column], ts: str, seq: str, id_col: str, key: str,
                          delay_us: int = 0, within_us: int | None = None, buckets: int = BUCKETS, n_buckets: int | None = None,
                          available_now: bool = True):
    """Start the stream: the matches of the ordered pattern within each key.
    ``(ts, seq)`` tells a key's rows apart; ``stages`` are read on the stream's rows."""
    return _start(PatternTable(path, key, stages, ts, seq, id_col, delay_us, within_us, buckets, n_buckets), stream, checkpoint, available_now)


# --------------------------------------------------- A8 with any associative reducer

class ReducerTable(KeyedTableSink):
    """State: the key's reduced state, in the reducer's own fields."""

    def __init__(self, path: str, key: str, seq: str, reducer: reducers.Reducer, name: str, buckets: int, n_buckets: int | None):
        super().__init__(path, key, buckets)
        self.seq, self.reducer, self.name, self.n = seq, reducer, name, n_buckets
        self.cols = [f"_f_{f}" for f in reducer.fields]

    def state_type(self, batch: DataFrame) -> T.StructType:
        return reducers.lift(batch, self.reducer).select(self.key, *self.cols).schema

    def advance(self, batch, state, wm):
        new = reducers.lift(batch, self.reducer).withColumn("_fresh", F.lit(1))
        rows = state.withColumn("_fresh", F.lit(0)).unionByName(new, allowMissingColumns=True)
        out = reducers.scan(rows, [self.key], ["_fresh", self.seq], list(self.reducer.fields), self.reducer.merge, self.n)
        kept = out.groupBy(self.key).agg(F.max_by(F.struct(*self.cols), F.struct("_fresh", self.seq)).alias("_s")).select(self.key, "_s.*")
        return out.where("_fresh = 1").select(*batch.columns, F.struct(*[F.col(f"_f_{f}").alias(f) for f in self.reducer.fields]).alias(self.name)), kept


def running_reduce_by(stream: DataFrame, path: str, checkpoint: str, key: str, seq: str, reducer: reducers.Reducer, name: str = "state",
                      buckets: int = BUCKETS, n_buckets: int | None = None, available_now: bool = True):
    """Start the stream: every row with its key's state so far, by any associative reducer."""
    return _start(ReducerTable(path, key, seq, reducer, name, buckets, n_buckets), stream, checkpoint, available_now)


# ------------------------------------------------- W2 with the late rows kept

class WindowTable(KeyedTableSink):
    """State: per open (window, key) its rows so far and their sum.  The buckets
    are by window start, so a closing window touches one."""

    timed, late = True, True

    def __init__(self, path: str, ts: str, size_us: int, value: str, keys: Sequence[str], delay_us: int, buckets: int):
        super().__init__(path, "window_start", buckets)
        self.ts, self.size_us, self.value, self.keys, self.delay_us = ts, int(size_us), value, list(keys), int(delay_us)

    def _end(self) -> Column:
        return F.unix_micros("window_start") + F.lit(self.size_us)

    def late_at(self, us: Column) -> Column:
        return self._end()          # as in Spark: a row is late when its window is closed

    def due(self) -> Column:
        return F.col("window_end_us")

    def _partial(self, batch: DataFrame) -> DataFrame:
        return (batch.withColumn("window_end_us", self._end())
                .groupBy("window_start", "window_end_us", *self.keys).agg(F.count(F.lit(1)).alias("n"), F.sum(self.value).alias("sum_value")))

    def state_type(self, batch: DataFrame) -> T.StructType:
        return self._partial(batch).schema

    def advance(self, batch, state, wm):
        kinds = dict(state.dtypes)
        both = (state.unionByName(self._partial(batch)).groupBy("window_start", "window_end_us", *self.keys)
                .agg(F.sum("n").alias("n"), F.sum("sum_value").cast(kinds["sum_value"]).alias("sum_value")))
        closed = F.col("window_end_us") <= F.lit(wm) if wm is not None else F.lit(False)
        out = both.where(closed).select("window_start", F.timestamp_micros("window_end_us").alias("window_end"), *self.keys, "n", "sum_value")
        return out, both.where(~closed)


def tumbling_sum(stream: DataFrame, path: str, checkpoint: str, ts: str, size: str, value: str, keys: Sequence[str] = (),
                 delay_us: int = 0, buckets: int = BUCKETS, available_now: bool = True):
    """Start the stream: ``(window_start, window_end, keys..., n, sum_value)`` of
    every closed window under ``<path>/rows``, and the rows that came when
    their window was closed, or without a time, under ``<path>/late``."""
    size_us = stream.sparkSession.sql(f"select unix_micros(timestamp_micros(0) + interval {size})").first()[0]       # one value
    us = F.unix_micros(F.col(ts).cast("timestamp"))         # F.window would leave rows without a time out
    start = F.timestamp_micros(us - F.pmod(us, F.lit(size_us)))
    src = stream.select(*dict.fromkeys([ts, value, *keys]), start.alias("window_start"))
    return _start(WindowTable(path, ts, size_us, value, keys, delay_us, buckets), src, checkpoint, available_now)
