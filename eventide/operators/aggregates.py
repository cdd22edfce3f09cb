"""Search-style aggregations.

All of them are partial/final hash aggregates: each task pre-aggregates its
rows and only one row per group crosses the shuffle, so a hot term costs one
row per task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def terms(df: DataFrame, field: str, size: int = 10, count_name: str = "doc_count") -> DataFrame:
    """Row count per value, top ``size`` by count, ties by value (A1).

    Missing values are not a term.  ``orderBy + limit`` plans as
    ``TakeOrderedAndProject``: each task keeps its own top ``size`` only.
    """
    return (df.where(F.col(field).isNotNull())
              .groupBy(field).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.col(count_name).desc(), F.col(field).asc())
              .limit(size))


def avg_or_zero(df: DataFrame, field: str, name: str = "avg_value") -> DataFrame:
    """Global average as a double; an empty input gives 0.0 instead of NULL (A2).

    The sum is in the field's own type: exact, and so independent of the order
    of addition, where the caller passes an integer or DECIMAL field.
    """
    return df.agg(F.coalesce(_average(F.sum(field), F.count(field)), F.lit(0.0)).alias(name))


def _average(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n.cast("double"))


def avg_epoch_ms(df: DataFrame, ts: str, prefix: str = "avg") -> DataFrame:
    """Average of a time field, truncated to whole milliseconds (A3).

    The sum is exact (DECIMAL), so the result does not depend on the order in
    which partial sums are combined.
    """
    ms = F.unix_millis(F.col(ts).cast("timestamp")).cast("decimal(20,0)")
    out = df.agg(F.sum(ms).alias("_s"), F.count(ms).alias("_n"))
    avg_ms = F.when(F.col("_n") > 0, F.expr("_s div _n"))
    return out.select(avg_ms.cast("bigint").alias(f"{prefix}_ms"),
                      F.timestamp_millis(avg_ms.cast("bigint")).cast("timestamp_ntz")
                       .alias(f"{prefix}_ts"))


def _per_value(df: DataFrame, field: str) -> DataFrame:
    """One row per distinct value (NULL included) with its row count.

    Partial counts are combined map-side, so a value holding a third of the
    rows crosses the shuffle as one row per task; the global step then reads
    one row per distinct value instead of the Expand that a distinct aggregate
    next to ``count(*)`` would plan.
    """
    return df.groupBy(field).agg(F.count(F.lit(1)).alias("_n"))


def _total() -> Column:
    return F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total")


def cardinality(df: DataFrame, field: str, exact: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-NULL values plus the total row count (A4, A5).

    The approximate form runs HyperLogLog++ over the rows themselves: a task
    sends one sketch of fixed size, whatever the number of distinct values.
    The exact form counts the distinct groups.
    """
    if not exact:
        return df.agg(F.approx_count_distinct(field, rsd).alias("cardinality"), F.count(F.lit(1)).alias("total"))
    return _per_value(df, field).agg(F.count(field).alias("cardinality"), _total())


def cardinality_check(df: DataFrame, field: str, rsd: float = 0.01, tolerance: float = 0.05) -> DataFrame:
    """The exact distinct count, and whether the approximate one is within
    ``tolerance`` of it."""
    exact = cardinality(df, field, exact=True)
    approx = cardinality(df, field, rsd=rsd).select("cardinality").scalar()
    return exact.select((F.abs(approx - F.col("cardinality")) <= F.lit(tolerance) * F.col("cardinality")).alias("within_5pct"),
                        "cardinality", "total")


def _bucket_index(ts: Column, width_us: int, offset_us: int = 0) -> Column:
    us = F.unix_micros(ts.cast("timestamp")) - F.lit(int(offset_us)).cast("bigint")
    width = F.lit(int(width_us)).cast("bigint")
    return F.call_function("div", us - F.pmod(us, width), width)     # floor, in integers


def _bucket_start(idx: Column, width_us: int, offset_us: int = 0) -> Column:
    return F.timestamp_micros(idx * F.lit(width_us) + F.lit(offset_us)).cast("timestamp_ntz")


def date_histogram(df: DataFrame, ts: str, width_us: int, fill: bool = True,
                   offset_us: int = 0, chunk_buckets: int = 1_000_000,
                   count_name: str = "doc_count") -> DataFrame:
    """Row count per fixed-width time bucket.

    With ``fill`` every bucket between the first and the last non-empty one
    is returned, empty ones with 0.  The bucket series is generated in two
    levels: the range is cut into chunks of at most ``chunk_buckets``
    buckets, the chunks are spread over the shuffle partitions, and each
    chunk is exploded where it lands.  However fine the width, no task
    generates more than one chunk's worth of buckets per chunk it owns.
    """
    idx = _bucket_index(F.col(ts), width_us, offset_us)
    counts = (df.where(F.col(ts).isNotNull())
                .groupBy(idx.alias("_idx")).agg(F.count(F.lit(1)).alias(count_name)))
    if not fill:
        return counts.select(_bucket_start(F.col("_idx"), width_us, offset_us).alias("bucket_start"),
                             count_name)
    per = int(chunk_buckets)
    bounds = counts.agg(F.min("_idx").alias("_lo"), F.max("_idx").alias("_hi"))
    n_chunks = F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.lit(per)).cast("bigint")
    ranges = (bounds.where(F.col("_lo").isNotNull())
                    .select("_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1))
                                            .alias("_c"))
                    .repartition("_c"))
    first = F.col("_lo") + F.col("_c") * F.lit(per)
    series = ranges.select(F.explode(F.sequence(
        first, F.least(F.col("_hi"), first + F.lit(per - 1)))).alias("_idx"))
    return (series.join(counts, "_idx", "left")
                  .select(_bucket_start(F.col("_idx"), width_us, offset_us).alias("bucket_start"),
                          F.coalesce(F.col(count_name), F.lit(0)).cast("bigint").alias(count_name)))


def histogram_top_terms(df: DataFrame, ts: str, width_us: int, field: str, size: int = 5,
                        include: Iterable | None = None, count_name: str = "doc_count") -> DataFrame:
    """Per time bucket, the ``size`` most frequent values of ``field``.

    ``include`` restricts the candidate values; counts of the kept values
    are unaffected by the restriction.  Ties go to the smaller value.  The
    rank filter plans as a ``WindowGroupLimit`` before the shuffle.
    """
    base = df.where(F.col(ts).isNotNull() & F.col(field).isNotNull())
    if include is not None:
        base = base.where(F.col(field).isin(list(include)))
    idx = _bucket_index(F.col(ts), width_us)
    counts = base.groupBy(idx.alias("_idx"), F.col(field)).agg(F.count(F.lit(1)).alias(count_name))
    w = Window.partitionBy("_idx").orderBy(F.col(count_name).desc(), F.col(field).asc())
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint"))
                  .where(F.col("rank") <= size)
                  .select(_bucket_start(F.col("_idx"), width_us).alias("bucket_start"),
                          field, count_name, "rank"))


def terms_and_avg(df: DataFrame, field: str, value: str, count_name: str = "doc_count",
                  avg_name: str = "avg_value") -> DataFrame:
    """Per-term counts and averages plus the overall row, in one scan (A10).

    The rows are grouped by term once; the overall row is rolled up from the
    terms' sums, so no row is expanded.  The result is not limited by any page
    size.  Sums are in the value's own type, as in :func:`avg_or_zero`.
    """
    per_term = df.groupBy(field).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"), F.count(value).alias("_c"))
    return (per_term.groupingSets([[F.col(field)], []], F.col(field))
            .agg(F.grouping_id().alias("_g"), F.sum("_n").alias(count_name),
                 _average(F.sum("_s"), F.sum("_c")).alias(avg_name))
            .select(field, (F.col("_g") == 1).alias("is_total"), count_name, avg_name)
            .where((F.col(count_name) > 0)))
