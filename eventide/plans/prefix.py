"""Bucketed prefix scans: ordered per-key (or global) running values without
putting a whole key, or the whole table, into one task.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to
one task, and a bare ``Window.orderBy(seq)`` sends the whole table to one task.
When one key holds a third of the rows that task is the job.  The helpers here
cut the table, in the order of (key, order columns), into buckets of about
equal row counts and work in three steps:

1. rows are windowed per ``(key, bucket)`` -- many tasks, bounded groups;
2. each ``(key, bucket)`` is summarised into one row (count, sum, max, first
   matching row ...), and a small window over the summaries of a key gives the
   carry from earlier (or later) buckets;
3. the carry is joined back on ``(key, bucket)`` and combined with the local
   value.  Only keys that span several buckets carry anything, so at most one
   row per bucket is joined back.

The cuts are quantiles of a sample of the order columns, drawn once when the
plan is built, compared in the columns' own types and directions, ties broken by
the later order columns and NULLs in Spark's default place.  So an outlier, a
handful of distinct values, many NULLs or a text column spread as evenly as
anything else.  Rows that tie on all order columns, should they fill more than a
bucket, are spread by a hash of the whole row (only rows equal in every column
stay together).  The plan holds the cuts as constants: recomputing after an
executor loss gives the same buckets.  A row's bucket is found by a compiled
binary search.  The rows are shuffled once, on ``(key, bucket)``, and the table
is read twice: for the rows, and map-side for the summaries (their columns only).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bkt"
SAMPLES_PER_BUCKET = 16     # more make bucket sizes more even
SAMPLE_SEED = 11
TIE = "_pfx_tie"

Order = Sequence[str | tuple[str, bool]]


def default_buckets(spark: SparkSession) -> int:
    """Enough buckets to spread the table over every core."""
    return max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def _spec(order: Order) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def zero_of(dtype: str) -> Column:
    """A non-NULL value of a type."""
    if dtype == "string":
        return F.lit("")
    if dtype == "boolean":
        return F.lit(False)
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return F.lit("1970-01-01").cast(dtype)
    return F.lit(0).cast(dtype)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cuts(df: DataFrame, spec: Sequence[tuple[str, bool]], n: int) -> list[str]:
    """``n - 1`` cut rows, as JSON, at the quantiles of a random sample of fixed
    size; one pass over the order columns, no count."""
    drawn = df.select(*[c for c, _ in spec]).orderBy(F.rand(SAMPLE_SEED)).limit(n * SAMPLES_PER_BUCKET)
    rows = [r[0] for r in drawn.orderBy(*sort_columns(spec)).select(F.to_json(F.struct(*[c for c, _ in spec]))).collect()]
    return [rows[i * len(rows) // n] for i in range(1, n)] if rows else []


def _tied(cuts: list[str]) -> bool:
    """Whether rows that tie on all order columns fill more than a bucket."""
    return any(a == b for a, b in zip(cuts, cuts[1:]))


def with_buckets(df: DataFrame, order: Order, n_buckets: int | None = None, name: str = BUCKET,
                 tie: str = TIE) -> DataFrame:
    """Add the bucket number: how many cuts lie at or before the row.

    The cuts are drawn when the plan is built, as the sample of a range
    exchange is drawn before its shuffle; the plan holds them as constants.
    Where rows that tie on all order columns fill more than a bucket, a hash of
    the whole row joins the order as column ``tie``: it must then be part of
    every sort that shall agree with the buckets.
    """
    n = n_buckets or default_buckets(df.sparkSession)
    if n <= 1:
        return df.withColumn(name, F.lit(0))
    spec = _spec(order)
    cuts = _cuts(df, spec, n)
    if _tied(cuts):
        df = df.withColumn(tie, F.xxhash64(*[_hashable(f) for f in df.schema.fields]))
        spec = [*spec, (tie, True)]
        cuts = _cuts(df, spec, n)
    return _located(df, spec, cuts, name)


def _hashable(field: T.StructField) -> Column:
    return F.to_json(F.struct(field.name)) if "map<" in field.dataType.simpleString() else F.col(field.name)


def _located(df: DataFrame, spec: Sequence[tuple[str, bool]], cuts: list[str], name: str) -> DataFrame:
    """Binary search with steps of falling powers of two, one projection a
    step: compiled, and of a size that grows with the number of steps only.

    Every step names the number found before it several times.  The bucket leaves
    through a one-element ``explode``: rules that trace a join key down to the
    scan (partition pruning, runtime filters) put each projection's expression
    in for its name, so without it the key would grow by that factor a step.
    """
    names = [c for c, _ in spec]
    kind = df.select(F.struct(*names).alias("r")).schema["r"].dataType
    held = F.from_json(F.lit(f"[{','.join(cuts)}]"), T.ArrayType(kind))        # folded into a constant
    up = all(asc for _, asc in spec)
    out = df.select("*", held.alias("_pfx_cuts"), F.lit(0).alias(name), *([F.struct(*names).alias("_pfx_row")] if up else []))
    passed = "_pfx_cut <= _pfx_row"
    if not up:      # the cut comes before the row or with it; NULLs first ascending, last descending
        passed = "true"
        for c, asc in reversed(spec):
            x, y = f"_pfx_cut.{_quoted(c)}", _quoted(c)
            less = (f"(({x} is null and {y} is not null) or coalesce({x} < {y}, false))" if asc else
                    f"(({x} is not null and {y} is null) or coalesce({x} > {y}, false))")
            passed = f"({less} or (({x} <=> {y}) and {passed}))"
        passed = f"_pfx_cut is not null and {passed}"
    at = _quoted(name)
    for k in reversed(range(len(cuts).bit_length())):
        out = out.withColumn("_pfx_cut", F.expr(f"get(_pfx_cuts, {at} + {(1 << k) - 1})"))
        out = out.withColumn(name, F.expr(f"{at} + case when {passed} then {1 << k} else 0 end"))
    return out.drop("_pfx_cuts", "_pfx_row", "_pfx_cut").withColumn(name, F.explode(F.array(at)))


def prepare(df: DataFrame, keys: Sequence[str], order: Order, n_buckets: int | None = None,
            drop_keys: bool = False) -> tuple[DataFrame, list[str], DataFrame]:
    """Add the bucket and NULL-safe key columns and hash-partition on them.

    Returns the partitioned frame, the partition key columns (without the
    bucket) and the same rows before the shuffle: first-pass summaries are
    aggregated from those map-side, so only partial aggregates cross the
    network for them.

    Keys are replaced by ``(coalesce(k, zero), k IS NULL)`` pairs so that later
    joins are plain equi-joins on exactly the partitioning columns: the data is
    shuffled once and every later step reuses that partitioning.
    """
    kcols: list[str] = []
    types = dict(df.dtypes)
    b = df
    for i, k in enumerate(keys):
        b = (b.withColumn(f"_k{i}", F.coalesce(F.col(k), zero_of(types[k])))
              .withColumn(f"_n{i}", F.col(k).isNull()))
        kcols += [f"_k{i}", f"_n{i}"]
    b = with_buckets(b, [*kcols, *order], n_buckets)
    if drop_keys:
        b = b.drop(*keys)
    return b.repartition(*kcols, BUCKET), kcols, b


def cleanup(df: DataFrame, kcols: Sequence[str]) -> DataFrame:
    return df.drop(*kcols, BUCKET, TIE)


def _with_tie(df: DataFrame, order: Order) -> Order:
    """The order the buckets were cut in: with the row hash, where ties needed it."""
    return [*order, TIE] if TIE in df.columns else order


def restore_keys(df: DataFrame, keys: Sequence[str], kcols: Sequence[str], types: dict) -> DataFrame:
    """Rebuild original key columns from the NULL-safe pairs of :func:`prepare`.

    Callers that drop the raw keys before the shuffle use this, so that every
    later consumer of the shuffled rows needs exactly the same columns and
    Spark reuses one exchange instead of shuffling the rows again.
    """
    for i, k in enumerate(keys):
        df = df.withColumn(k, F.when(F.col(f"_n{i}"), F.lit(None).cast(types[k]))
                              .otherwise(F.col(f"_k{i}")))
    return df


def _join_carry(df: DataFrame, carry: DataFrame, kcols: Sequence[str]) -> DataFrame:
    return df.join(carry, on=[*kcols, BUCKET], how="left")


def sort_columns(order: Order, reverse: bool = False) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc != reverse else F.col(c).desc_nulls_last() for c, asc in _spec(order)]


def _spanning(summary: DataFrame, kcols: Sequence[str], w, carry: Sequence[Column]) -> DataFrame:
    """The carries of buckets that have others before them (in ``w``) in their key."""
    return (summary.select(*kcols, BUCKET, F.count(F.lit(1)).over(w).alias("_others"), *carry)
            .where(F.col("_others") > 0).drop("_others"))


def running(df: DataFrame, kcols: Sequence[str], order: Order, specs: dict[str, tuple[Column, str, bool]],
            summary_from: DataFrame | None = None) -> DataFrame:
    """Running aggregates in ``order`` within the keys of :func:`prepare`.

    ``specs`` maps an output name to ``(value, op, inclusive)``, op one of
    ``sum``, ``count``, ``max``, ``min``.  ``inclusive=False`` covers only
    strictly earlier rows (NULL for the first row, 0 for count).
    ``summary_from`` holds the same rows before the shuffle, when available.
    """
    w_local = Window.partitionBy(*kcols, BUCKET).orderBy(*sort_columns(_with_tie(df, order)))
    local_cols, summary_aggs, carry_cols = [], [], []
    agg_fn = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
    for name, (val, op, inclusive) in specs.items():
        frame = w_local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        local_cols.append(agg_fn[op](val).over(frame).alias(f"_l_{name}"))
        summary_aggs.append(agg_fn[op](val).alias(f"_s_{name}"))
    local = df.select("*", *local_cols)

    summary = (df if summary_from is None else summary_from).groupBy(*kcols, BUCKET).agg(*summary_aggs)
    w_carry = Window.partitionBy(*kcols).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    for name, (_val, op, _inc) in specs.items():
        carry_op = {"count": F.sum}.get(op, agg_fn[op])
        carry_cols.append(carry_op(f"_s_{name}").over(w_carry).alias(f"_k_{name}"))
    out = _join_carry(local, _spanning(summary, kcols, w_carry, carry_cols), kcols)
    for name, (_val, op, _inc) in specs.items():
        lc, kc = F.col(f"_l_{name}"), F.col(f"_k_{name}")
        if op == "count":
            expr = F.coalesce(kc, F.lit(0)) + F.coalesce(lc, F.lit(0))
        elif op == "sum":  # SQL semantics: NULL when no earlier value exists
            expr = F.when(lc.isNull() & kc.isNull(), lc).otherwise(
                F.coalesce(kc, F.lit(0)) + F.coalesce(lc, F.lit(0)))
        elif op == "max":
            expr = F.greatest(kc, lc)
        else:
            expr = F.least(kc, lc)
        out = out.withColumn(name, expr)
    drop = [f"_l_{n}" for n in specs] + [f"_k_{n}" for n in specs]
    return out.drop(*drop)


def next_match(df: DataFrame, kcols: Sequence[str], order: Order, cond: Column, payload: Column, name: str,
               summary_from: DataFrame | None = None, payload_is_order_key: bool = False) -> DataFrame:
    """For every row, ``payload`` of the first strictly later row (in
    ``order`` within the keys) for which ``cond`` holds, else NULL.

    Inside a bucket this is a running ``last(ignorenulls)`` over the reversed
    order (linear, one sort); across buckets the first match of each later
    bucket is carried back through the summaries.  When ``payload`` is the
    first order column itself, the summary is a plain ``min`` (hash
    aggregate) instead of a ``min`` over a struct (sort aggregate).
    """
    order = _with_tie(df, order)
    w_rev = (Window.partitionBy(*kcols, BUCKET).orderBy(*sort_columns(order, reverse=True))
             .rowsBetween(Window.unboundedPreceding, -1))
    hit = F.when(cond, payload)
    local = df.withColumn("_nm_local", F.last(hit, ignorenulls=True).over(w_rev))

    if payload_is_order_key:
        first = F.struct(F.min(F.when(cond, payload)).alias("_p"))
    else:
        first = F.min(F.when(cond, F.struct(*[F.col(o) for o in order], payload.alias("_p"))))
    summary = (df if summary_from is None else summary_from).groupBy(*kcols, BUCKET).agg(first.alias("_first"))
    w_carry = (Window.partitionBy(*kcols).orderBy(F.col(BUCKET).desc())
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = F.last(F.col("_first._p"), ignorenulls=True).over(w_carry).alias("_nm_carry")
    out = _join_carry(local, _spanning(summary, kcols, w_carry, [carry]), kcols)
    return (out.withColumn(name, F.coalesce("_nm_local", "_nm_carry"))
               .drop("_nm_local", "_nm_carry"))
