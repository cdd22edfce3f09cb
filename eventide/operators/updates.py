"""Conditional updates and backfill between two stores.

Updates produce a new version of the data (a new DataFrame to write); they
never edit files in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_update(df: DataFrame, where: Column, column: str, value) -> DataFrame:
    """Set ``column`` to ``value`` (NULL allowed) on rows where ``where`` holds."""
    dtype = dict(df.dtypes)[column]
    new = F.lit(value).cast(dtype)
    return df.withColumn(column, F.when(F.coalesce(where, F.lit(False)), new).otherwise(F.col(column)))


def rename_value(df: DataFrame, column: str, old, new) -> DataFrame:
    """Replace one value of a field by another on all rows."""
    return conditional_update(df, F.col(column) == F.lit(old), column, new)


def backfill(dst: DataFrame, src: DataFrame, key: str | Sequence[str],
             columns: Sequence[str] | None = None) -> DataFrame:
    """Fill ``dst`` from ``src`` by key (T10): the union of both key sets; for
    each column the source value wins where it is not NULL.

    A full outer join, made of a left join and the source rows that match
    nothing: AQE splits the rows of a hot key of ``dst`` in the first, and in the
    second only the distinct keys of ``dst`` are on the other side.  Rows with a
    NULL key match nothing; they are kept aside, unshuffled, so that they do not
    meet in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns) if columns is not None else [c for c in dst.columns if c not in keys]
    d = dst.select(*keys, *[F.col(c).alias(f"_d_{c}") for c in cols])
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols])
    lone = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    j = d.where(~lone).join(s.where(~lone), keys, "left")
    alone = s.where(~lone).join(d.where(~lone).select(*keys).distinct(), keys, "left_anti")
    j = j.unionByName(alone, allowMissingColumns=True)
    out = j.select(*keys, *[F.coalesce(f"_s_{c}", f"_d_{c}").alias(c) for c in cols])
    for side, name in ((d, "_d_"), (s, "_s_")):
        out = out.unionByName(side.where(lone).select(*keys, *[F.col(f"{name}{c}").alias(c) for c in cols]))
    return out
