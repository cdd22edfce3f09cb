"""Keyed running reduce and count windows, batch forms.

Both need the order of rows inside a key.  They run on the bucketed prefix
scan, so a key holding a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.plans import prefix


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def running_reduce(df: DataFrame, key: str | Sequence[str], seq: str, value: str,
                   name: str = "running_sum", n_buckets: int | None = None, op: str = "sum") -> DataFrame:
    """One output row per input row: ``value`` reduced so far in its key.

    ``op`` is sum, count, max or min, in the value's own type; NULL values do
    not contribute.
    """
    b, kcols, raw = prefix.prepare(df, _keys(key), [seq], n_buckets)
    out = prefix.running(b, kcols, [seq], {name: (F.col(value), op, True)}, raw)
    return prefix.cleanup(out, kcols)


def row_numbers(df: DataFrame, key: str | Sequence[str], order: prefix.Order, name: str = "rn",
                n_buckets: int | None = None) -> DataFrame:
    """1-based position of each row within its key; ``order`` is a total order
    of columns of any type, ``(column, False)`` for descending."""
    b, kcols, raw = prefix.prepare(df, _keys(key), order, n_buckets)
    out = prefix.running(b, kcols, order, {name: (F.lit(1), "count", True)}, raw)
    return prefix.cleanup(out, kcols)


def count_window_avg(df: DataFrame, key: str | Sequence[str], seq: str, value: str, n: int = 2,
                     n_buckets: int | None = None) -> DataFrame:
    """Every ``n`` rows of a key, emit ``sum div n`` and start over.

    An integer sum is divided as Java divides, truncating toward zero, a NULL
    value counting as a row without a contribution; other types divide in
    their own type.  An incomplete last window is not emitted.
    """
    keys = _keys(key)
    rn = row_numbers(df, keys, [seq], "_rn", n_buckets=n_buckets)
    whole = dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    avg = F.expr(f"_s div {n}") if whole else F.col("_s") / F.lit(n)
    grp = ((F.col("_rn") - 1) / F.lit(n)).cast("bigint")  # rn >= 1, so floor == trunc
    return (rn.groupBy(*keys, grp.alias("window_idx"))
              .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"),
                   F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))
              .where(F.col("_n") == n)
              .select(*keys, "window_idx", avg.alias("avg_value"),
                      "first_seq", "last_seq"))
