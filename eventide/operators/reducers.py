"""Running reduce by any associative function.

A reducer names the fields of its state, each with a type and the Column that a
row contributes, and merges two states, earlier one first, for whole arrays of
rows at once.  It need not commute.  The rows run through the bucketed prefix
scan (:mod:`eventide.plans.prefix`): a scan inside every bucket, by doubling
steps over Arrow batches, one state a bucket carried over the buckets of keys
that span several, and a last merge, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.plans import prefix

State = dict[str, np.ndarray]
Merge = Callable[[State, State], State]


@dataclass
class Reducer:
    """``fields`` maps a name to ``(type, contribution of a row)``; contributions
    must not be NULL: give the neutral value where a row adds nothing."""

    fields: dict[str, tuple[str, Column]]
    merge: Merge


def _state(batch: pa.RecordBatch, names: Sequence[str]) -> State:
    out = {}
    for n in names:
        column = batch.column(batch.schema.get_field_index(n))
        if column.null_count:
            raise ValueError(f"the reducer's field {n[3:]} is NULL on some row: give it a neutral value")
        out[n[3:]] = column.to_numpy(zero_copy_only=False)
    return out


def _put(batch: pa.RecordBatch, state: State, extra: dict[str, pa.Array] = {}) -> pa.RecordBatch:
    """The batch with the state's values in the state's columns."""
    own = {f"_f_{n}": v for n, v in state.items()}
    arrays = [pa.array(own[f.name], f.type) if f.name in own else batch.column(i) for i, f in enumerate(batch.schema)]
    return pa.RecordBatch.from_arrays([*arrays, *extra.values()], names=[*batch.schema.names, *extra])


def scanned(state: State, group: np.ndarray, merge: Merge) -> State:
    """Inclusive scan of rows inside runs of equal ``group`` numbers: after step
    ``d`` each row holds the last ``2 d`` rows up to it."""
    step, n = 1, len(group)
    while step < n:
        at = step + np.flatnonzero(group[step:] == group[:-step])
        if not len(at):
            break
        merged = merge({k: v[at - step] for k, v in state.items()}, {k: v[at] for k, v in state.items()})
        state = {k: v.copy() for k, v in state.items()}
        for k in state:
            state[k][at] = merged[k]
        step *= 2
    return state


def scan(lifted: DataFrame, keys: Sequence[str], order: prefix.Order, fields: Sequence[str], merge: Merge,
         n_buckets: int | None = None) -> DataFrame:
    """``lifted`` with its ``_f_<field>`` columns reduced from the key's first row on."""
    b, kcols, _ = prefix.prepare(lifted, list(keys), order, n_buckets)
    cols, cut = [f"_f_{f}" for f in fields], [*kcols, prefix.BUCKET]
    total = [*order, prefix.TIE] if prefix.TIE in b.columns else list(order)
    rows = b.sortWithinPartitions(*cut, *prefix.sort_columns(total))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [batch.column(batch.schema.get_field_index(c)) for c in cut]
            new = np.zeros(batch.num_rows, bool)
            for p in parts:
                if len(p) > 1:
                    new[1:] |= pc.not_equal(p.slice(1), p.slice(0, len(p) - 1)).to_numpy(zero_copy_only=False)
            group = np.cumsum(new)
            state = scanned(_state(batch, cols), group, merge)
            pos = np.arange(len(group)) - np.flatnonzero(np.r_[True, new[1:]])[group]
            here = tuple(p[0].as_py() for p in parts)
            if before is not None and before[0] == here:        # the group went on from the last batch
                own = np.flatnonzero(group == 0)
                merged = merge({k: np.repeat(v, len(own)) for k, v in before[1].items()}, {k: v[own] for k, v in state.items()})
                state = {k: v.copy() for k, v in state.items()}
                for k in state:
                    state[k][own] = merged[k]
                pos[own] += before[2] + 1
            before = (tuple(p[len(p) - 1].as_py() for p in parts), {k: v[-1:] for k, v in state.items()}, int(pos[-1]))
            yield _put(batch, state, {"_pos": pa.array(pos, pa.int64())})

    local = rows.mapInArrow(inside, T.StructType([*rows.schema.fields, T.StructField("_pos", T.LongType())]))
    last = local.groupBy(*cut).agg(F.max_by(F.struct(*cols), "_pos").alias("_s"))
    spans = (last.withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy(*kcols))) if kcols else
             last.withColumn("_parts", F.lit(2))).where("_parts > 1").select(*cut, "_s.*")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by(prefix.BUCKET).combine_chunks()    # a row a bucket of one key
        batch = table.to_batches()[0]
        state = scanned(_state(batch, cols), np.zeros(batch.num_rows, np.int64), merge)
        yield _put(batch.slice(1), {k: v[:-1] for k, v in state.items()})

    over.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    carry = spans.groupBy(*kcols).applyInArrow(over, spans.schema)
    carry = carry.select(*cut, *[F.col(c).alias(f"_c{c}") for c in cols], F.lit(True).alias("_carried"))
    joined = local.join(carry, cut, "left")
    kept = [f for f in joined.schema.fields if f.name not in {"_carried", "_pos", *(f"_c{c}" for c in cols)}]

    def merged_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(batch.column(batch.schema.get_field_index("_carried")).is_valid().to_numpy(zero_copy_only=False))
            state = {k: v.copy() for k, v in _state(batch, cols).items()}
            if len(at):
                part = batch.take(pa.array(at))
                carried = _state(part.select([f"_c{c}" for c in cols]).rename_columns(cols), cols)
                out = merge(carried, {k: v[at] for k, v in state.items()})
                for k in state:
                    state[k][at] = out[k]
            done = _put(batch, state)
            yield done.select([f.name for f in kept])

    return prefix.cleanup(joined.mapInArrow(merged_in, T.StructType(kept)), kcols)


def lift(df: DataFrame, reducer: Reducer) -> DataFrame:
    return df.select("*", *[value.cast(kind).alias(f"_f_{name}") for name, (kind, value) in reducer.fields.items()])


def running_reduce(df: DataFrame, key: str | Sequence[str], seq: str, reducer: Reducer, name: str = "state",
                   n_buckets: int | None = None) -> DataFrame:
    """One output row per input row: the key's state so far, as a struct, rows in ``seq`` order."""
    keys = [key] if isinstance(key, str) else list(key)
    out = scan(lift(df, reducer), keys, [seq], list(reducer.fields), reducer.merge, n_buckets)
    return out.select(*df.columns, F.struct(*[F.col(f"_f_{f}").alias(f) for f in reducer.fields]).alias(name))
