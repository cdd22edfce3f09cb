"""Sort, top hits and paging (L1-L3).

Every ordering here is total: callers give tie-breaking columns, because the
result order of a search request (relevance or index order) is undefined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.plans import prefix


def sort_by(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by ``[(column, ascending), ...]`` (L1): a range-partitioned sort."""
    return df.orderBy(*prefix.sort_columns(order))


def top_hits(df: DataFrame, order: Sequence[tuple[str, bool]], size: int = 10) -> DataFrame:
    """First ``size`` rows in a total order (L2): ``TakeOrderedAndProject``."""
    return df.orderBy(*prefix.sort_columns(order)).limit(size)


def paginate(df: DataFrame, order: Sequence[tuple[str, bool]], page_size: int,
             n_buckets: int | None = None) -> DataFrame:
    """Number every row and its page in a total order (L3).

    ``rn`` is 1-based, ``page = (rn - 1) div page_size``.  The global row
    number comes from the bucketed prefix scan (bucket counts carried
    forward), not from a single-partition window; columns may be of any type.  Readers take one page with
    a filter on ``page``; a full export should write the table instead.
    """
    b, kcols, raw = prefix.prepare(df, [], order, n_buckets)
    out = prefix.running(b, kcols, order, {"rn": (F.lit(1), "count", True)}, raw)
    return prefix.cleanup(out.withColumn("page", F.expr(f"(rn - 1) div {int(page_size)}")), kcols)


def page(df: DataFrame, order: Sequence[tuple[str, bool]], page_size: int, number: int) -> DataFrame:
    """One page of a paged result."""
    return paginate(df, order, page_size).where(F.col("page") == number)
