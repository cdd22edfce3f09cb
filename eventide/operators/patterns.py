"""Ordered event pattern, batch form.

``begin(stage0).followedBy(stage1).followedBy(stage2)...`` with relaxed
contiguity: from every row matching the first stage, take the next row (by
event time, then arrival) matching the next stage, and so on.  No after-match
skipping, so several starts may share later rows; each start yields at most
one match.

Evaluated last stage first: every row learns the next row of stage k+1 and
what that row itself leads to.  Each pass is a running ``last(ignorenulls)``
over the reversed order inside ``(key, bucket)`` plus a carry over bucket
summaries, so all passes share one shuffle of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalars import concat_ids
from eventide.plans import prefix


def sequence_match(df: DataFrame, stages: Sequence[Column], ts: str, seq: str, id_col: str,
                   key: str | Sequence[str] | None = None,
                   n_buckets: int | None = None, within_us: int | None = None,
                   partials: bool = False) -> DataFrame:
    """Matches as rows ``(key..., id_0 .. id_k, ts_0, ts_k, ids)``.

    ``within_us`` bounds a match's span (last stage time minus first).  The
    chain of first matching rows is unique per start, so a start whose chain
    ends too late has no match at all.  With ``partials`` every start row is
    returned with the chain found so far (later ids NULL) and a ``complete``
    flag; the streaming form carries the open ones.
    """
    keys = [] if key is None else ([key] if isinstance(key, str) else list(key))
    k = len(stages)
    types = dict(df.dtypes)
    mask = sum((F.when(F.coalesce(s, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0))
                for i, s in enumerate(stages)), F.lit(0)).cast("int")
    base = df.select(*keys, *dict.fromkeys([ts, seq, id_col]), mask.alias("_mask"))
    # keys travel as the NULL-safe pairs only: every pass then reads the same
    # shuffled columns, and Spark reuses the single exchange
    order = list(dict.fromkeys([ts, seq]))
    cur, kcols, raw = prefix.prepare(base, keys, order, n_buckets, drop_keys=True)

    def stage(i: int):
        return (F.col("_mask").bitwiseAND(F.lit(1 << i))) != 0

    # _nx{i}: for every row, the next row of stage i and its own chain onward
    for i in range(k - 1, 0, -1):
        fields = [F.col(id_col).alias(f"id{i}"), F.col(ts).alias(f"ts{i}")]
        if i < k - 1:
            fields.append(F.col(f"_nx{i + 1}").alias("next"))
        payload = F.struct(*fields)
        # the last stage needs nothing computed earlier: summarise it map-side
        src = raw if i == k - 1 else None
        cur = prefix.next_match(cur, kcols, order, stage(i), payload, f"_nx{i}", src)
    # the first row of each later stage is taken; if it does not continue,
    # no later row of that stage can (it would be later still)
    ids, path, complete = [F.col(id_col).alias("id0")], "_nx1", stage(0)
    for i in range(1, k):
        complete = complete & F.col(path).isNotNull()
        ids.append(F.col(f"{path}.id{i}").alias(f"id{i}"))
        last_ts = F.col(f"{path}.ts{i}")
        path = f"{path}.next"
    if within_us is not None:
        span = F.unix_micros(last_ts.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
        complete = complete & (span <= F.lit(int(within_us)))
    if partials:
        out = prefix.restore_keys(cur.where(stage(0)), keys, kcols, types)
        return out.select(*keys, *ids, F.col(ts).alias("start_ts"), last_ts.alias("end_ts"),
                          F.coalesce(complete, F.lit(False)).alias("complete"))
    out = prefix.restore_keys(cur.where(complete), keys, kcols, types)
    return (out.select(*keys, *ids, F.col(ts).alias("start_ts"), last_ts.alias("end_ts"))
               .withColumn("ids", concat_ids(*[f"id{i}" for i in range(k)])))
