"""Stream/batch parity: input split into time-ordered files read one per
micro-batch, rows shuffled inside files, a restart on the same checkpoint,
late rows, and the streaming counter and buffered sink."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import rows
from eventide.operators import keyed, patterns, timeout
from eventide.operators.metrics import counted_stream
from eventide.streaming import processors, windows
from eventide.streaming.buffered_sink import buffered_sink_stream
from eventide.streaming.runner import event_stream, start_to_parquet

SCHEMA = pa.schema([("k", pa.string()), ("ts", pa.timestamp("us")), ("seq", pa.int64()),
                    ("v", pa.int64()), ("e", pa.string())])
WITHIN = 200_000_000   # pattern span bound: 200 s
SPARK_SCHEMA = "k string, ts timestamp_ntz, seq bigint, v bigint, e string"


def _write_files(folder, chunks, shuffle=True):
    """Test fixture files, one per micro-batch, with increasing mtimes."""
    os.makedirs(folder, exist_ok=True)
    for i, chunk in enumerate(chunks):
        chunk = list(chunk)
        if shuffle:
            random.Random(i).shuffle(chunk)
        cols = list(zip(*chunk))
        table = pa.table({f.name: pa.array(c, f.type) for f, c in zip(SCHEMA, cols)}, schema=SCHEMA)
        path = f"{folder}/part-{i:04d}.parquet"
        pq.write_table(table, path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def _events(n_keys=3, n=60, seed=7):
    rnd = random.Random(seed)
    t = 1_704_067_200_000_000  # 2024-01-01 in microseconds
    out = []
    for i in range(n):
        t += rnd.choice([1, 2, 30, 61, 90]) * 1_000_000
        out.append((f"k{rnd.randrange(n_keys)}", t, i, rnd.randrange(-5, 9), rnd.choice("abcx")))
    return out


def _as_df(spark, data):
    import datetime as dt
    conv = [(k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), s, v, e) for k, t, s, v, e in data]
    return spark.createDataFrame(conv, SPARK_SCHEMA)


def _run(spark, src_dir, out_dir, build, mode="append"):
    stream = event_stream(spark, src_dir, spark.createDataFrame([], SPARK_SCHEMA).schema,
                          max_files_per_trigger=1)
    q = start_to_parquet(build(stream), f"{out_dir}/data", f"{out_dir}/chk", mode)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_stateful_parity_with_restart(spark, scratch):
    data = _events()
    sentinel = ("zz", data[-1][1] + 10**12, 10**6, 0, "x")   # far future, private key
    chunks = [data[0:20], data[20:40], data[40:] + [sentinel]]
    src, out = f"{scratch}/src", f"{scratch}/out"
    gap = 60_000_000
    builders = {
        "timeout": lambda s: processors.inactivity_timeout(s, "k", "ts", "seq", gap),
        "pattern": lambda s: processors.sequence_match(
            s, [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"], "ts", "seq", "seq", key="k"),
        "within": lambda s: processors.sequence_match(
            s, [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"], "ts", "seq", "seq", key="k",
            within_us=WITHIN),
        "running": lambda s: processors.running_reduce(s, "k", "seq", "v"),
        "count": lambda s: processors.count_window_avg(s, "k", "seq", "v", 2),
    }
    _write_files(src, chunks[:2])
    for name, b in builders.items():
        _run(spark, src, f"{out}/{name}", b)             # first run: two files
    _write_files(src, chunks, shuffle=True)               # third file arrives
    for name, b in builders.items():
        _run(spark, src, f"{out}/{name}", b)             # restart on the same checkpoint

    batch = _as_df(spark, data).withColumn("ts", F.col("ts"))
    got = spark.read.parquet(f"{out}/timeout/data").where("k != 'zz'")
    ref = timeout.inactivity_timeout(batch, "k", "ts", "seq", gap)
    assert rows(got.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz")), "k", "count", "last_ts") \
        == rows(ref, "k", "count", "last_ts")
    got = spark.read.parquet(f"{out}/pattern/data")
    ref = patterns.sequence_match(batch, [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"],
                                  "ts", "seq", "seq", key="k")
    assert rows(got, "k", "ids") == rows(ref, "k", "ids")
    got = spark.read.parquet(f"{out}/within/data")
    ref_w = patterns.sequence_match(batch, [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"],
                                    "ts", "seq", "seq", key="k", within_us=WITHIN)
    assert rows(got, "k", "ids") == rows(ref_w, "k", "ids")
    assert 0 < ref_w.count() < ref.count()               # the bound removes some matches
    got = spark.read.parquet(f"{out}/running/data").where("k != 'zz'")
    assert rows(got, "seq", "running_sum") == rows(keyed.running_reduce(batch, "k", "seq", "v"), "seq", "running_sum")
    got = spark.read.parquet(f"{out}/count/data").where("k != 'zz'")
    assert rows(got) == rows(keyed.count_window_avg(batch, "k", "seq", "v", 2))


def test_late_rows_are_dropped_and_counted(spark, scratch):
    t0 = 1_704_067_200_000_000
    s = 1_000_000
    chunks = [[("a", t0 + i * s, i, 1, "x") for i in range(1, 26)],   # 1..25 s
              [("a", t0 + 40 * s, 100, 1, "x")],
              [("a", t0 + 41 * s, 101, 1, "x")],
              [("a", t0 + 5 * s, 102, 1, "x")],                         # late: window [0,10) closed
              [("a", t0 + 100 * s, 103, 1, "x")]]
    src = f"{scratch}/src"
    _write_files(src, chunks, shuffle=False)
    q = _run(spark, src, f"{scratch}/out",
             lambda st: windows.tumbling_count(st, "ts", "10 seconds", key="k"))
    got = {r.window_start.second: r.n for r in spark.read.parquet(f"{scratch}/out/data").collect()}
    assert got[0] == 9 and got[10] == 10 and got[20] == 6    # the late row did not change [0,10)
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress)
    assert dropped >= 1


def test_stream_counter(spark, scratch):
    data = _events(n=30)
    src = f"{scratch}/src"
    _write_files(src, [data[:10], data[10:]])
    q = _run(spark, src, f"{scratch}/out", lambda st: counted_stream(st, "records"))
    seen = sum(p["observedMetrics"]["records"]["records"] for p in q.recentProgress
               if "records" in p.get("observedMetrics", {}))
    assert seen == 30


def test_stream_buffered_sink(spark, scratch):
    import datetime as dt
    src = f"{scratch}/src"
    os.makedirs(src)
    data = [("id", 12345, 1), ("salary", 1000, 2), ("phone_num", 732888888, 3), ("id", 45678, 4)]
    for i, part in enumerate([data[:3], data[3:]]):
        t = pa.table({"name": [r[0] for r in part], "v": [r[1] for r in part], "seq": [r[2] for r in part]})
        pq.write_table(t, f"{src}/p{i}.parquet")
        os.utime(f"{src}/p{i}.parquet", (1_700_000_000 + i,) * 2)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = buffered_sink_stream(stream, f"{scratch}/sink", f"{scratch}/chk", "name", "seq", 2)
    q.awaitTermination()
    assert q.exception() is None
    back = spark.read.json(f"{scratch}/sink")
    assert rows(back, "file_name", "seq") == [("id", 3), ("id", 4), ("salary", 1), ("salary", 2)]
    assert dt is not None


def _brute_pattern(data, stages=("a", "b", "c")):
    """Every start's chain of next rows, by (ts, seq): the definition."""
    order = sorted(data, key=lambda r: (r[1], r[2]))
    out = []
    for i, r in enumerate(order):
        if r[4] != stages[0]:
            continue
        chain, j = [r[2]], i
        for st in stages[1:]:
            j = next((x for x in range(j + 1, len(order)) if order[x][4] == st), None)
            if j is None:
                break
            chain.append(order[j][2])
        if len(chain) == len(stages):
            out.append("".join(f"{c} " for c in chain))
    return sorted(out)


def test_unkeyed_stream_pattern_carries_partials(spark, scratch):
    from eventide.streaming.global_pattern import global_pattern_stream
    data = _events(n=200, seed=11)
    sentinel = ("zz", data[-1][1] + 10**12, 10**6, 0, "x")
    late = ("k0", data[5][1] - 1, 10**6 + 1, 0, "c")       # behind the watermark when it arrives
    chunks = [data[0:70], data[70:155], data[155:] + [late, sentinel]]
    src, out = f"{scratch}/src", f"{scratch}/out"
    stages = [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"]

    def run():
        stream = event_stream(spark, src, spark.createDataFrame([], SPARK_SCHEMA).schema,
                              delay=None, max_files_per_trigger=1)
        q = global_pattern_stream(stream, f"{out}/sink", f"{out}/chk", stages, "ts", "seq", "seq",
                                  delay_us=100_000_000)
        q.awaitTermination()
        assert q.exception() is None

    _write_files(src, chunks[:2])
    run()                                                  # two files, partials carried
    _write_files(src, chunks)
    run()                                                  # restart, third file
    got = sorted(r.ids for r in spark.read.parquet(f"{out}/sink/matches").collect())
    want = _brute_pattern(data + [sentinel])
    assert got == want and len(want) > 10
    # some matches start in one file and end in a later one: partials were carried
    spans = [tuple(int(x) for x in m.split()) for m in want]
    assert any(a < 70 <= b for a, b, _ in spans) and any(a < 155 <= b for a, b, _ in spans)
    ref = patterns.sequence_match(_as_df(spark, data), stages, "ts", "seq", "seq")
    assert got == sorted(r.ids for r in ref.collect())
    # the late row is counted; two slots of state however many batches
    from eventide.streaming.global_pattern import dropped_rows
    assert dropped_rows(spark, f"{out}/sink") == 1
    state = f"{out}/sink/_pattern_state"
    assert sorted(os.listdir(f"{state}/kept")) == ["slot-0", "slot-1"]
    assert sorted(os.listdir(f"{state}/commits")) == ["slot=0", "slot=1"]


def test_unkeyed_pattern_with_repeated_ids_and_a_span_bound(spark, scratch):
    """Repeated ids do not keep finished starts; with a bound the state stays flat."""
    from eventide.streaming.global_pattern import global_pattern_stream
    data = [(k, t, i, 1, e) for k, t, i, _, e in _events(n=240, seed=21)]       # v, the id, is always 1
    sentinel = ("zz", data[-1][1] + 10**12, 10**6, 1, "x")
    chunks = [data[i:i + 40] for i in range(0, 240, 40)] + [[sentinel]]
    src = f"{scratch}/src"
    _write_files(src, chunks)
    stages = [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"]
    sizes = []
    stream = event_stream(spark, src, spark.createDataFrame([], SPARK_SCHEMA).schema, delay=None, max_files_per_trigger=1)
    q = global_pattern_stream(stream, f"{scratch}/sink", f"{scratch}/chk", stages, "ts", "seq", "v", delay_us=0, within_us=WITHIN)
    q.awaitTermination()
    assert q.exception() is None
    got = spark.read.parquet(f"{scratch}/sink/matches")
    ref = patterns.sequence_match(_as_df(spark, data), stages, "ts", "seq", "v", within_us=WITHIN)
    assert rows(got, "start_ts", "end_ts", "ids") == rows(ref, "start_ts", "end_ts", "ids") and ref.count() > 5
    for slot in (0, 1):
        sizes.append(spark.read.parquet(f"{scratch}/sink/_pattern_state/kept/slot-{slot}").count())
    assert max(sizes) < 40, sizes


def _overlapping(data, files, reach):
    """The rows dealt to files in event-time order, up to ``reach`` places out of place."""
    rnd = random.Random(9)
    late = sorted(range(len(data)), key=lambda i: i + rnd.random() * reach)
    size = -(-len(data) // files)
    return [[data[i] for i in late[lo:lo + size]] for lo in range(0, len(data), size)]


def test_out_of_order_rows_within_the_delay(spark, scratch):
    """Timeouts and patterns equal the batch forms whatever the arrival order,
    also with text ids, text sequence numbers apart."""
    data = _events(n=160, seed=5)
    sentinel = ("zz", data[-1][1] + 10**12, 10**6, 0, "x")
    src = f"{scratch}/src"
    _write_files(src, [*_overlapping(data, 5, 12), [sentinel]])
    stages = [F.col("e") == "a", F.col("e") == "b", F.col("e") == "c"]
    schema = spark.createDataFrame([], SPARK_SCHEMA).schema
    delay = "1500 seconds"

    def run(name, build):
        stream = event_stream(spark, src, schema, delay=delay, max_files_per_trigger=1)
        q = start_to_parquet(build(stream.withColumn("name", F.concat(F.lit("r"), "seq"))), f"{scratch}/{name}/data", f"{scratch}/{name}/chk")
        q.awaitTermination()
        assert q.exception() is None
        assert sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress) == 0
        return spark.read.parquet(f"{scratch}/{name}/data")

    batch = _as_df(spark, data).withColumn("name", F.concat(F.lit("r"), "seq"))
    got = run("timeout", lambda s: processors.inactivity_timeout(s, "k", "ts", "seq", 60_000_000)).where("k <> 'zz'")
    assert rows(got.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz")), "k", "count", "last_ts") == rows(
        timeout.inactivity_timeout(batch, "k", "ts", "seq", 60_000_000), "k", "count", "last_ts")
    got = run("pattern", lambda s: processors.sequence_match(s, stages, "ts", "seq", "name", key="k"))
    want = patterns.sequence_match(batch, stages, "ts", "seq", "name", key="k")
    assert rows(got, "k", "id0", "id1", "id2", "ids") == rows(want, "k", "id0", "id1", "id2", "ids") and want.count() > 5


def test_running_values_keep_their_type_and_nulls(spark, scratch):
    big = 9_007_199_254_740_993
    data = [("a", 1, 1, big, "x"), ("a", 2, 2, None, "x"), ("b", 3, 3, None, "x"), ("b", 4, 4, 5, "x"), ("a", 5, 5, 1, "x"), ("b", 6, 6, -4, "x")]
    src = f"{scratch}/src"
    _write_files(src, [data[:3], data[3:]], shuffle=False)
    batch = _as_df(spark, data)
    for name, dtype in (("long", "bigint"), ("money", "decimal(20,3)"), ("real", "double")):
        cast = lambda d, t=dtype: d.withColumn("v", (F.col("v") / F.lit(8)).cast(t) if t == "double" else F.col("v").cast(t))
        _run(spark, src, f"{scratch}/r{name}", lambda s: processors.running_reduce(cast(s), "k", "seq", "v"))
        got = spark.read.parquet(f"{scratch}/r{name}/data")
        ref = keyed.running_reduce(cast(batch), "k", "seq", "v")
        assert rows(got, "seq", "v", "running_sum") == rows(ref, "seq", "v", "running_sum")
        _run(spark, src, f"{scratch}/c{name}", lambda s: processors.count_window_avg(cast(s), "k", "seq", "v", 2))
        got = spark.read.parquet(f"{scratch}/c{name}/data")
        ref = keyed.count_window_avg(cast(batch), "k", "seq", "v", 2)
        assert rows(got, "k", "window_idx", "avg_value", "first_seq", "last_seq") == rows(ref, "k", "window_idx", "avg_value", "first_seq", "last_seq")


def test_null_ids_and_sequence_numbers(spark, scratch):
    """NULL ids match and spell no id list; NULL sequence numbers come first
    among ties; long ids beside them keep every digit."""
    big, s = 9_007_199_254_740_993, 1_704_067_200_000_000
    e = list("aabcxabbcacbcab")
    data = [("k", s + (i // 2) * 10_000_000, None if i % 4 == 3 else i + big, i, x) for i, x in enumerate(e)]
    sentinel = ("zz", s + 10**12, 1, 0, "x")
    src = f"{scratch}/src"
    _write_files(src, [data[:7], data[7:], [sentinel]])
    batch = _as_df(spark, data).withColumn("id", F.expr("nullif(seq, 9007199254740995)"))
    stages = [F.col("e") == x for x in "abc"]
    ident = lambda d: d.withColumn("id", F.expr("nullif(seq, 9007199254740995)"))
    for name, build, ref, cols in (
            ("t1", lambda d: processors.inactivity_timeout(d, "k", "ts", "seq", 9_000_000),
             timeout.inactivity_timeout(batch, "k", "ts", "seq", 9_000_000), ("k", "count")),
            ("t2", lambda d: processors.sequence_match(ident(d), stages, "ts", "seq", "id", key="k"),
             patterns.sequence_match(batch, stages, "ts", "seq", "id", key="k"), ("id0", "id1", "id2", "ids"))):
        _run(spark, src, f"{scratch}/{name}", build)
        got = rows(spark.read.parquet(f"{scratch}/{name}/data").where("k <> 'zz'"), *cols)
        assert got == rows(ref, *cols) and got
    # one batch: NULL sequence numbers are taken before all others
    _write_files(f"{scratch}/one", [[(k, t, None if i in (2, 5) else q, i, x) for i, (k, t, q, _, x) in enumerate(data)]])
    one = spark.read.parquet(f"{scratch}/one")
    assert one.where("seq is null").count() > 2
    _run(spark, f"{scratch}/one", f"{scratch}/a8", lambda d: processors.running_reduce(d.withColumn("v", F.lit(1)), "k", "seq", "v"))
    got = rows(spark.read.parquet(f"{scratch}/a8/data"), "seq", "running_sum")
    assert sorted(r[1] for r in got) == list(range(1, 16))
    assert {r[1] for r in got if r[0] is None} == set(range(1, one.where("seq is null").count() + 1))
    assert [r[0] for r in sorted(got, key=lambda r: r[1]) if r[0] is not None] == sorted(r[0] for r in got if r[0] is not None)
    _run(spark, f"{scratch}/one", f"{scratch}/a9", lambda d: processors.count_window_avg(d.withColumn("v", F.lit(2)), "k", "seq", "v", 3))
    ref = keyed.count_window_avg(one.withColumn("v", F.lit(2)), "k", "seq", "v", 3)
    cols = ("k", "window_idx", "avg_value", "first_seq", "last_seq")
    assert rows(spark.read.parquet(f"{scratch}/a9/data"), *cols) == rows(ref, *cols)


def _many_keys(n_keys, e):
    """Each key's rows lie a minute and more apart, dealt to three files; every tenth key is NULL."""
    s = 1_704_067_200_000_000
    return [(None if i % 10 == 0 else f"2024-01-{1 + i % 28:02d}" if i % 3 == 0 else f"k{i}", s + (j * 60 + i % 7) * 1_000_000, j * n_keys + i, j, x)
            for j, x in enumerate(e) for i in range(n_keys)]


def _grouped_run(spark, scratch, name, data, build):
    sentinel = ("zz", data[-1][1] + 10**12, 10**8, 0, "x")
    size = -(-len(data) // 3)
    _write_files(f"{scratch}/src", [data[:size], data[size:2 * size], data[2 * size:], [sentinel]])
    q = _run(spark, f"{scratch}/src", f"{scratch}/{name}", build)
    # state and timers are those of key groups: per key it was two rows and more
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 4 * processors.KEY_GROUPS
    return spark.read.parquet(f"{scratch}/{name}/data")


def test_timeout_state_is_by_key_group(spark, scratch):
    data = _many_keys(3000, "abc")
    ref = rows(timeout.inactivity_timeout(_as_df(spark, data), "k", "ts", "seq", 60_000_000), "k", "count", "last_ts")
    got = _grouped_run(spark, scratch, "t1", data, lambda d: processors.inactivity_timeout(d, "k", "ts", "seq", 60_000_000)).where("k is null or k <> 'zz'")
    assert rows(got.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz")), "k", "count", "last_ts") == ref and len(ref) > 1500


def test_pattern_state_is_by_key_group(spark, scratch):
    data = _many_keys(3000, "abc")
    stages = [F.col("e") == x for x in "abc"]
    ref = rows(patterns.sequence_match(_as_df(spark, data), stages, "ts", "seq", "seq", key="k"), "k", "id0", "id1", "id2", "ids")
    got = _grouped_run(spark, scratch, "t2", data, lambda d: processors.sequence_match(d, stages, "ts", "seq", "seq", key="k"))
    assert rows(got, "k", "id0", "id1", "id2", "ids") == ref and len(ref) == 3000


def test_key_groups_keep_key_types(spark, scratch):
    data = _many_keys(30, "abc")
    stages = [F.col("e") == x for x in "abc"]
    for dtype in ("date", "timestamp_ntz", "binary", "decimal(9,2)"):
        kind = (F.col("k").cast("binary") if dtype == "binary" else F.when(F.col("k").isNotNull(), (F.col("seq") % 5).cast(dtype))
                if dtype.startswith("decimal") else F.expr(f"try_cast(k as {dtype})"))
        cast = lambda d, c=kind: d.withColumn("k", c)
        build = lambda d: processors.sequence_match(cast(d), stages, "ts", "seq", "seq", key="k")
        got = _grouped_run(spark, f"{scratch}/{dtype[:12]}", "t2", data, build)
        assert dict(got.dtypes)["k"] == dtype
        text = lambda d: d.withColumn("k", F.col("k").cast("string"))
        want = text(cast(_as_df(spark, data)))
        assert rows(text(got), "k", "ids") == rows(patterns.sequence_match(want, stages, "ts", "seq", "seq", key="k"), "k", "ids")
        assert got.count() == len(data) // 3
