"""Inactivity timeout, batch form.

Per key a running count; a key "times out" after a row when no later row of
the key arrives within ``gap`` of it.  The count is never reset.  A gap of
exactly ``gap`` is not a timeout.  The last row of every key always fires.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.plans import prefix


def inactivity_timeout(df: DataFrame, key: str | Sequence[str], ts: str, seq: str,
                       gap_us: int, n_buckets: int | None = None) -> DataFrame:
    """Rows ``(key..., count, last_ts, fire_ts)`` as the timers would emit them."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [ts, seq]
    b, kcols, raw = prefix.prepare(df.select(*keys, ts, seq), keys, order, n_buckets)
    counted = prefix.running(b, kcols, order, {"count": (F.lit(1), "count", True)}, raw)
    nxt = prefix.next_match(counted, kcols, order, F.lit(True), F.col(ts), "_next_ts", raw,
                            payload_is_order_key=True)
    gap = F.make_dt_interval(secs=F.lit(gap_us / 1e6).cast("decimal(18,6)"))
    fires = F.col("_next_ts").isNull() | (F.col("_next_ts") > F.col(ts) + gap)
    return (nxt.where(fires)
               .select(*keys, F.col("count").cast("bigint").alias("count"),
                       F.col(ts).alias("last_ts"), (F.col(ts) + gap).alias("fire_ts")))
