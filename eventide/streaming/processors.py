"""Stateful streaming operators (A8, A9, T1, T2) as ``StatefulProcessor``s.

Each runs under ``groupBy(key).transformWithStateInPandas``: Spark shuffles
rows by key, keeps per-key state in the (RocksDB) state store, checkpoints
it with the query and restores it after a failure.  Row order inside a
micro-batch is undefined after the shuffle, so every handler sorts its rows
by (event time, arrival sequence) first; the work per key and batch is
vectorised with numpy where the semantics allow.

Timestamps travel as TIMESTAMP; inside the handlers they are integer
microseconds.  Timers are in milliseconds, as Spark's watermark is.
"""

from __future__ import annotations

import datetime
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from eventide.plans.prefix import zero_of


# The processors travel to the Python workers (and to the driver-side runner
# that reads their state schemas) by value, so a cluster needs no install of
# this package for them; numpy, pandas and pyspark are imported by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _arrays(rows: Iterator[pd.DataFrame], names: Sequence[str]) -> dict[str, np.ndarray]:
    """The batch's rows of one key as numpy columns (no pandas per-row work:
    per-key pandas operations cost ~10x the numpy equivalent)."""
    parts = list(rows)
    if len(parts) == 1:
        return {n: parts[0][n].to_numpy() for n in names}
    return {n: np.concatenate([p[n].to_numpy() for p in parts]) for n in names}


def _us(a: np.ndarray) -> np.ndarray:
    """Timestamps (naive UTC) to int64 microseconds."""
    return a.astype("datetime64[us]").astype("int64")


def _ts(us) -> np.ndarray:
    return np.asarray(us, dtype="int64").astype("datetime64[us]")


def _state(**types: str) -> StructType:
    """A state schema; built where the query is, since DDL is parsed by the JVM."""
    return StructType.fromDDL(", ".join(f"{k} {t}" for k, t in types.items()))


def _key_value(key) -> object:
    return key[0] if isinstance(key, tuple) else key


# Values reach the handlers without NULLs, beside a flag that tells them: a
# NULL in an integer column would turn it into floating point on the way.

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _sum_type(dtype: str) -> str:
    """Type of a sum, as Spark's batch ``sum`` has it."""
    if dtype in _WHOLE:
        return "bigint"
    if dtype in ("float", "double"):
        return "double"
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", dtype)
    if not m:
        raise TypeError(f"cannot sum a {dtype}: cast it to an integer, double or decimal type first")
    return f"decimal({min(38, int(m[1]) + 10)},{m[2]})"


def _split_nulls(stream: DataFrame, key: str, seq: str, value: str) -> tuple[DataFrame, str]:
    kind = _sum_type(dict(stream.dtypes)[value])
    return stream.select(*_filled(stream, seq, "seq"), key, F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind)).alias("amount"),
                         F.col(value).isNotNull().alias("given")), kind


def _filled(stream: DataFrame, col: str, name: str) -> list[Column]:
    """``has_<name>`` and ``<name>_value``, NULLs as the type's zero: sorted by the
    pair, NULLs come first, as in Spark's order."""
    return [F.col(col).isNotNull().alias(f"has_{name}"), F.coalesce(F.col(col), zero_of(dict(stream.dtypes)[col])).alias(f"{name}_value")]


def _order(a: dict[str, np.ndarray]) -> np.ndarray:
    """Stable order of a batch by ``(has_seq, seq)``."""
    o = np.argsort(a["seq_value"], kind="stable")
    return o[np.argsort(a["has_seq"][o].astype(bool), kind="stable")]


def _back(has: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Filled values with their NULLs, as objects: integers stay integers."""
    out = (values.astype("datetime64[us]") if values.dtype.kind == "M" else values).astype(object)
    out[~has.astype(bool)] = None
    return out


def _numbers(a: np.ndarray, kind: str) -> np.ndarray:
    return a if kind.startswith("decimal") else a.astype("int64" if kind == "bigint" else "float64")


def _scalar(x, kind: str):
    return x if kind.startswith("decimal") else (int(x) if kind == "bigint" else float(x))


# --------------------------------------------------------------------------- A8

class RunningSum(StatefulProcessor):
    """One output row per input row: the key's sum so far, in ``seq`` order,
    and whether any value was given so far."""

    def __init__(self, key: str, seq: str, kind: str):
        self.key_col, self.seq, self.kind = key, seq, kind
        self.state = _state(s=kind, n="bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        a = _arrays(rows, ["has_seq", "seq_value", "amount", "given"])
        o = _order(a)
        v, given = _numbers(a["amount"][o], self.kind), a["given"][o].astype(bool)
        cur = self.total.get()                          # None when the key is new
        base, count = cur if cur is not None else (_scalar(0, self.kind) if not self.kind.startswith("decimal") else v[0] - v[0], 0)
        run, n = base + np.cumsum(v), count + np.cumsum(given)
        self.total.update((_scalar(run[-1], self.kind), int(n[-1])))
        yield pd.DataFrame({self.seq: _back(a["has_seq"][o], a["seq_value"][o]), self.key_col: np.repeat(_key_value(key), len(o)),
                            "amount": v, "given": given, "total": run, "some": n > 0})

    def close(self) -> None:
        pass


def running_reduce(stream: DataFrame, key: str, seq: str, value: str,
                   name: str = "running_sum") -> DataFrame:
    """Running sum in the value's own type; NULL values do not contribute, and
    the sum is NULL until one does, as in the batch form."""
    types = dict(stream.dtypes)
    src, kind = _split_nulls(stream, key, seq, value)
    schema = f"{seq} {types[seq]}, {key} {types[key]}, amount {kind}, given boolean, total {kind}, some boolean"
    out = src.groupBy(key).transformWithStateInPandas(RunningSum(key, seq, kind), schema, "Append", "None")
    return out.select(seq, key, F.when(F.col("given"), F.col("amount")).cast(types[value]).alias(value),
                      F.when(F.col("some"), F.col("total")).alias(name))


# --------------------------------------------------------------------------- A9

class CountWindowAverage(StatefulProcessor):
    """Every ``n`` rows of a key: emit their sum and how many gave a value; an
    open window is kept in state (count so far, pending sum and values, first
    sequence number)."""

    def __init__(self, key: str, seq_type: str, n: int, kind: str):
        self.key_col, self.n, self.kind = key, n, kind
        self.state = _state(cnt="bigint", pend_s=kind, pend_n="bigint", pend_first=seq_type, pend_last=seq_type)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.n
        a = _arrays(rows, ["has_seq", "seq_value", "amount", "given"])
        o = _order(a)
        first, v = _back(a["has_seq"][o], a["seq_value"][o]), _numbers(a["amount"][o], self.kind)
        last, given = first, a["given"][o].astype("int64")
        cur = self.acc.get()
        cnt, pend_s, pend_n, pend_first, pend_last = cur if cur is not None else (0, None, 0, None, None)
        open_n = cnt % n
        weight = np.ones(len(o), dtype="int64")
        if open_n:                                      # rows of the window left open earlier
            v = np.concatenate([np.array([pend_s], dtype=v.dtype), v])
            given = np.concatenate([[pend_n], given])
            first, last = np.concatenate([_objects([pend_first]), first]), np.concatenate([_objects([pend_last]), last])
            weight = np.concatenate([[open_n], weight])
        pos = (cnt - open_n) + np.cumsum(weight)        # 1-based position of each row's end
        win = (pos - 1) // n
        starts = np.flatnonzero(np.r_[True, win[1:] != win[:-1]])
        s, c, g = np.add.reduceat(v, starts), np.add.reduceat(weight, starts), np.add.reduceat(given, starts)
        ends = np.r_[starts[1:], len(win)]
        # in order, NULLs first: the first and the last number given
        first = _objects([next((x for x in first[i:j] if x is not None), None) for i, j in zip(starts, ends)])
        last = _objects([next((x for x in last[i:j][::-1] if x is not None), None) for i, j in zip(starts, ends)])
        full = c == n
        new_cnt = int(cnt + len(o))
        if c[-1] < n:
            self.acc.update((new_cnt, _scalar(s[-1], self.kind), int(g[-1]), first[-1], last[-1]))
        else:
            self.acc.update((new_cnt, None, 0, None, None))
        if full.any():
            yield pd.DataFrame({
                self.key_col: np.repeat(_key_value(key), int(full.sum())),
                "window_idx": win[starts][full],
                "total": s[full],
                "given": g[full],
                "first_seq": first[full],
                "last_seq": last[full]})

    def close(self) -> None:
        pass


def _objects(values: Sequence) -> np.ndarray:
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


def count_window_avg(stream: DataFrame, key: str, seq: str, value: str, n: int = 2) -> DataFrame:
    """Average of every ``n`` rows, divided as in the batch form."""
    types = dict(stream.dtypes)
    src, kind = _split_nulls(stream, key, seq, value)
    schema = f"{key} {types[key]}, window_idx bigint, total {kind}, given bigint, first_seq {types[seq]}, last_seq {types[seq]}"
    out = src.groupBy(key).transformWithStateInPandas(CountWindowAverage(key, types[seq], n, kind), schema, "Append", "None")
    avg = F.expr(f"total div {n}") if types[value] in _WHOLE else F.col("total") / F.lit(n)
    return out.select(key, "window_idx", F.when(F.col("given") > 0, avg).alias("avg_value"), "first_seq", "last_seq")


# --------------------------------------------------------------------------- T1, T2: groups of keys

# Each call into a handler and its state costs a round trip to the JVM, some
# ten a key and batch.  T1 and T2 therefore run on groups of keys: a group's
# rows are buffered together, taken together when its one timer fires, and
# worked on by key with numpy.

KEY_GROUPS = 512        # part of the state's layout: a running query's checkpoint holds it
STATE_CHUNK = 10_000    # values an array in the state holds at most

# Key types that reach the handlers as another type: to it and back.
_CODED = {
    "timestamp": ("bigint", F.unix_micros, F.timestamp_micros),
    "timestamp_ntz": ("bigint", lambda c: F.unix_micros(c.cast("timestamp")), lambda c: F.timestamp_micros(c).cast("timestamp_ntz")),
    "date": ("int", F.unix_date, F.date_from_unix_date),
    "binary": ("string", F.hex, F.unhex),
}


def _key_groups(stream: DataFrame, key: str | None) -> tuple[DataFrame, str]:
    """The stream with ``key_group``, ``has_key`` and ``key_value``; the type of the last."""
    if key is None:
        return stream.withColumns({"key_group": F.lit(0), "has_key": F.lit(True), "key_value": F.lit(0)}), "int"
    kind = dict(stream.dtypes)[key]
    kind, coded = (_CODED[kind][0], _CODED[kind][1](F.col(key))) if kind in _CODED else (kind, F.col(key))
    return stream.withColumns({"key_group": F.pmod(F.xxhash64(key), F.lit(KEY_GROUPS)).cast("int"), "has_key": F.col(key).isNotNull(),
                               "key_value": F.coalesce(coded, zero_of(kind))}), kind


def _key_back(out: DataFrame, key: str, dtype: str) -> DataFrame:
    return out.withColumn(key, _CODED[dtype][2](F.col(key))) if dtype in _CODED else out


def _arrays_of(**types: str) -> StructType:
    return _state(**{k: f"array<{t}>" for k, t in types.items()})


def _listed(a: np.ndarray) -> list:
    return (a.astype("datetime64[us]") if a.dtype.kind == "M" else a).tolist()


def _typed(values: list, kind: str) -> np.ndarray:
    dtype = {"boolean": "bool", "float": "float64", "double": "float64"}.get(kind, "int64" if kind in _WHOLE else None)
    return np.array(values, dtype=dtype) if dtype else _objects(values)


def _codes(has: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number from 0 on for each key, NULL and NaN keys among them, and a place of each."""
    raw = np.where(has, pd.factorize(values)[0] + 2, 0)
    _, first, code = np.unique(raw, return_index=True, return_inverse=True)
    return code, first


class KeyGroup(StatefulProcessor):
    """Buffer of a group of keys, in arrays, with one timer: at the earliest
    time that any of its rows or keys waits for."""

    def __init__(self, ts: str, buffered: dict[str, str], kept: dict[str, str]):
        self.ts, self.buffered, self.kept_types = ts, list(buffered.items()), list(kept.items())
        self.buffer_state, self.kept_state, self.timer_state = _arrays_of(**buffered), _arrays_of(**kept), _state(ms="bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", self.buffer_state)
        self.kept = handle.getListState("kept", self.kept_state)
        self.timer = handle.getValueState("timer", self.timer_state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [n for n, _ in self.buffered if n != "ts_us"]
        a = self._taken(_arrays(rows, [self.ts, *names]))
        if len(a[self.ts]):
            a["ts_us"] = _us(a[self.ts])
            self.buf.appendList(self._chunks([_listed(a[n]) for n, _ in self.buffered]))
            self._wake(int(a["ts_us"].min()))
        return iter([])

    def _taken(self, a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return a

    def _wake(self, us: int) -> None:
        ms = -((-us) // 1000)       # ceil to whole ms
        at = self.timer.get()
        if at is not None and at[0] <= ms:
            return
        if at is not None:
            self.handle.deleteTimer(at[0])
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    @staticmethod
    def _chunks(columns: Sequence[list]) -> list[tuple]:
        return [tuple(c[i:i + STATE_CHUNK] for c in columns) for i in range(0, len(columns[0]), STATE_CHUNK)]

    @staticmethod
    def _read(state, types: Sequence[tuple[str, str]]) -> list[list]:
        columns: list[list] = [[] for _ in types]
        for row in state.get() if state.exists() else []:
            for c, part in zip(columns, row):
                c.extend(part)
        return columns

    @classmethod
    def _write(cls, state, columns: Sequence[list]) -> None:
        if columns[0]:
            state.put(cls._chunks(columns))
        else:
            state.clear()

    def close(self) -> None:
        pass


# --------------------------------------------------------------------------- T1

class InactivityTimeout(KeyGroup):
    """Per key a running count; emit ``(key, count, last, last + gap)`` when
    ``gap`` of event time passes without an update.  The count is never
    reset.  A gap of exactly ``gap`` is not a timeout.

    Rows are buffered until the watermark passes them and then taken in (event
    time, seq) order, so the result does not depend on how they arrive or fall
    into micro-batches, whatever the watermark's delay.
    """

    def __init__(self, key: str, ts: str, gap_us: int, key_type: str = "bigint", seq_type: str = "bigint"):
        self.key_col, self.gap = key, int(gap_us)
        # fired: the row counted last has been reported
        super().__init__(ts, {"has_key": "boolean", "key_value": key_type, "ts_us": "bigint", "has_seq": "boolean", "seq_value": seq_type},
                         {"has_key": "boolean", "key_value": key_type, "count": "bigint", "last_us": "bigint", "fired": "boolean"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        buf = self._read(self.buf, self.buffered)
        b_has, b_key, ts, has_seq, seq = (_typed(c, t) for c, (_, t) in zip(buf, self.buffered))
        k_has, k_key, *kept = (_typed(c, t) for c, (_, t) in zip(self._read(self.kept, self.kept_types), self.kept_types))
        has, keys = np.concatenate([k_has, b_has]), np.concatenate([k_key, b_key])
        code, first = _codes(has, keys)
        old, code, n = code[:len(k_has)], code[len(k_has):], len(first)
        has, keys = has[first], keys[first]
        known, fired, count, last = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, "int64"), np.zeros(n, "int64")
        known[old], count[old], last[old], fired[old] = True, *kept

        ready = ts <= wm_us
        o = np.flatnonzero(ready)
        for by in (seq, has_seq, ts, code):
            o = o[np.argsort(by[o], kind="stable")]
        if len(o):
            c, t = code[o], ts[o]
            at = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])       # each key's first row
            size, own = np.diff(np.r_[at, len(c)]), c[at]
            prev = np.r_[t[:1], t[:-1]]
            prev[at] = np.where(known[own], last[own], t[at])
            fire = t - prev > self.gap
            fire[at] &= known[own] & ~fired[own]
            counts = count[c] + np.arange(len(c)) - np.repeat(at, size)     # count when the previous row was last
            if fire.any():
                yield self._rows(has, keys, c[fire], counts[fire], prev[fire])
            count[own] += size
            last[own], fired[own], known[own] = t[at + size - 1], False, True
            self._write(self.buf, [[x for x, r in zip(col, ready.tolist()) if not r] for col in buf])
        upcoming = np.full(n, np.iinfo("int64").max)
        np.minimum.at(upcoming, code[~ready], ts[~ready])
        due = last + self.gap
        waits = known & ~fired & (due > wm_us)
        quiet = known & ~fired & (due <= wm_us) & (upcoming > due)
        if quiet.any():
            yield self._rows(has, keys, np.flatnonzero(quiet), count[quiet], last[quiet])
            fired |= quiet
        self._write(self.kept, [_listed(x[known]) for x in (has, keys, count, last, fired)])
        wake = np.concatenate([ts[~ready], due[waits]])
        if len(wake):
            self._wake(int(wake.min()))

    def _rows(self, has: np.ndarray, keys: np.ndarray, of: np.ndarray, count: np.ndarray, last: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({self.key_col: _back(has[of], keys[of]), "count": count.astype("int64"),
                             "last_ts": _ts(last), "fire_ts": _ts(last + self.gap)})


def inactivity_timeout(stream: DataFrame, key: str, ts: str, seq: str, gap_us: int) -> DataFrame:
    """Needs a watermark on ``ts``; emits append-only rows.  Rows behind the
    watermark when they arrive, or without event time, are dropped."""
    types = dict(stream.dtypes)
    src, kind = _key_groups(stream.where(F.col(ts).isNotNull()), key)
    schema = f"{key} {kind}, count bigint, last_ts timestamp, fire_ts timestamp"
    out = (src.select("key_group", "has_key", "key_value", ts, *_filled(stream, seq, "seq")).groupBy("key_group")
              .transformWithStateInPandas(InactivityTimeout(key, ts, gap_us, kind, types[seq]), schema, "Append", "EventTime"))
    return _key_back(out, key, types[key])


# --------------------------------------------------------------------------- T2

class SequencePattern(KeyGroup):
    """``stage0 followedBy stage1 followedBy ...`` in event-time order.

    Rows are buffered until the watermark passes them (a timer at the
    earliest buffered time), then replayed in (ts, seq) order key by key.  Open
    partial matches wait in state grouped by the stage they need next: all
    starts waiting for stage i advance together on the next stage-i row.
    """

    def __init__(self, key: str | None, ts: str, n_stages: int, within_us: int | None = None,
                 key_type: str = "bigint", seq_type: str = "bigint", id_type: str = "bigint"):
        self.key_col, self.k, self.within = key, n_stages, within_us
        super().__init__(ts, {"has_key": "boolean", "key_value": key_type, "ts_us": "bigint", "has_seq": "boolean", "seq_value": seq_type,
                              "has_id": "boolean", "id_value": id_type, "stage_mask": "bigint"},
                         {"has_key": "boolean", "key_value": key_type, "stage": "bigint", "start_us": "bigint", "ids": f"array<{id_type}>"})

    def _taken(self, a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Without the rows of no stage.  A filter on the stream would be moved
        before the watermark, which these rows advance."""
        keep = a["stage_mask"] != 0
        return {n: x[keep] for n, x in a.items()}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        buf, partial = self._read(self.buf, self.buffered), self._read(self.kept, self.kept_types)
        has = _typed(partial[0] + buf[0], "boolean")
        keys = _typed(partial[1] + buf[1], dict(self.buffered)["key_value"])
        code, first = _codes(has, keys)
        has, keys, code, ahead = has[first], keys[first], code.tolist(), len(partial[0])
        waiting: dict[int, list[list[tuple]]] = {}
        for c, stage, start_us, ids in zip(code, *partial[2:]):
            waiting.setdefault(c, [[] for _ in range(self.k)])[stage].append((start_us, list(ids)))
        done = []
        ready = sorted(r for r in zip(code[ahead:], *buf[2:]) if r[1] <= wm_us)
        for c, ts_us, _has_seq, _seq, has_id, rid, mask in ready:
            rid = rid if has_id else None
            own = waiting.setdefault(c, [[] for _ in range(self.k)])
            for i in range(self.k - 1, 0, -1):          # later stages first: one step per row
                if mask >> i & 1 and own[i]:
                    # the first stage-i row decides: a start it leaves too far
                    # behind can never match
                    moved = [(s, ids + [rid]) for s, ids in own[i]
                             if self.within is None or ts_us - s <= self.within]
                    own[i] = []
                    if i == self.k - 1:
                        done += [(c, s, ids, ts_us) for s, ids in moved]
                    else:
                        own[i + 1] += moved
            if mask & 1:
                own[1].append((ts_us, [rid]))
        # every later row is newer than the watermark: bounded matches whose
        # span already ended can be dropped, so state stays bounded
        alive = (lambda s: True) if self.within is None else (lambda s: s + self.within > wm_us)
        flat = [(c, i, s, ids) for c, own in waiting.items() for i in range(1, self.k) for s, ids in own[i] if alive(s)]
        of = [f[0] for f in flat]
        self._write(self.kept, [_listed(has[of]), _listed(keys[of]), *([f[j] for f in flat] for j in (1, 2, 3))])
        late = [t > wm_us for t in buf[2]]
        if ready:
            self._write(self.buf, [[x for x, r in zip(col, late) if r] for col in buf])
        if any(late):
            self._wake(min(t for t in buf[2] if t > wm_us))
        if done:
            out = {f"id{i}": _objects([d[2][i] for d in done]) for i in range(self.k)}
            if self.key_col is not None:
                of = [d[0] for d in done]
                out = {self.key_col: _back(has[of], keys[of]), **out}
            out["start_ts"] = _ts([d[1] for d in done])
            out["end_ts"] = _ts([d[3] for d in done])
            out["ids"] = _objects([None if None in d[2] else " ".join(str(x) for x in d[2]) + " " for d in done])
            yield pd.DataFrame(out)


def sequence_match(stream: DataFrame, stages: Sequence[Column], ts: str, seq: str, id_col: str,
                   key: str | None = None, within_us: int | None = None) -> DataFrame:
    """Streaming T2.  ``key=None`` runs the pattern unkeyed (one state group).

    Without ``within_us`` an open partial match waits in state until it
    completes; with it, partials older than the bound are dropped once the
    watermark passes their deadline.
    """
    k = len(stages)
    types = dict(stream.dtypes)
    # one bitmask column, computed JVM-side: bit i set when stage i matches
    mask = sum((F.when(F.coalesce(s, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0))
                for i, s in enumerate(stages)), F.lit(0)).cast("bigint").alias("stage_mask")
    # (column names reaching pandas must not start with "_")
    src, kind = _key_groups(stream.where(F.col(ts).isNotNull()), key)
    src = src.select("key_group", "has_key", "key_value", ts, *_filled(stream, seq, "seq"), *_filled(stream, id_col, "id"), mask)
    schema = ((f"{key} {kind}, " if key else "") + ", ".join(f"id{i} {types[id_col]}" for i in range(k))
              + ", start_ts timestamp, end_ts timestamp, ids string")
    out = (src.groupBy("key_group")
              .transformWithStateInPandas(SequencePattern(key, ts, k, within_us, kind, types[seq], types[id_col]),
                                          schema, "Append", "EventTime"))
    return _key_back(out, key, types[key]) if key else out


# --------------------------------------------------------------------------- W3

class HoldUntilClose(StatefulProcessor):
    """Rows of one window, kept until a timer at its end gives them out.

    Works on Rows, so that any type and NULLs come back as they went in.
    """

    def __init__(self, kept: StructType):
        self.kept, self.names = kept, kept.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.rows.appendList([tuple(r[n] for n in self.names) for r in rows])
        # the key's time is the window's last microsecond
        self.handle.registerTimer(_epoch_us(key[0]) // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for r in self.rows.get():
            yield Row(closes=key[0], **dict(zip(self.names, r)))
        self.rows.clear()

    def close(self) -> None:
        pass


def _epoch_us(t: datetime.datetime) -> int:
    """Rows bring times in the worker's own zone, without naming it."""
    return int(t.replace(microsecond=0).timestamp()) * 1_000_000 + t.microsecond
