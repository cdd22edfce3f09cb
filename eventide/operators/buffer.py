"""Buffered sink, batch form.

Rows are cut, in arrival order, into buffers of ``n``; a full buffer is
written as one file named after the key of its last row, replacing whatever
was written under that name before.  A partial last buffer is not flushed
unless asked.  The surviving content is: per name, its latest buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.keyed import row_numbers


def buffers(df: DataFrame, name_col: str, seq: str, n: int, emit_partial: bool = False,
            n_buckets: int | None = None) -> DataFrame:
    """Every row with its buffer number, buffer size and the buffer's file name."""
    b, per_buf = _buffered(df, name_col, seq, n, emit_partial, n_buckets)
    return b.join(per_buf, "buffer_idx")


def _buffered(df: DataFrame, name_col: str, seq: str, n: int, emit_partial: bool,
              n_buckets: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows with their buffer number, and one row per buffer that is written."""
    rn = row_numbers(df, [], [seq], "_rn", n_buckets=n_buckets)
    b = rn.withColumn("buffer_idx", F.expr(f"(_rn - 1) div {int(n)}")).drop("_rn")
    per_buf = (b.groupBy("buffer_idx")
                .agg(F.max_by(name_col, seq).alias("file_name"), F.count(F.lit(1)).alias("buffer_rows")))
    return b, per_buf if emit_partial else per_buf.where(F.col("buffer_rows") == n)


def latest_buffers(df: DataFrame, name_col: str, seq: str, n: int, emit_partial: bool = False,
                   n_buckets: int | None = None) -> DataFrame:
    """Rows of the buffer that is last written under each file name."""
    b, per_buf = _buffered(df, name_col, seq, n, emit_partial, n_buckets)
    # the surviving buffers are picked from the summaries, one per name, before
    # the rows are touched; joining on the buffer number, at most ``n`` rows
    # each, never gathers one name's rows in a task
    last = (per_buf.groupBy("file_name").agg(F.max(F.struct("buffer_idx", "buffer_rows")).alias("_b"))
            .select("_b.buffer_idx", "file_name", "_b.buffer_rows"))
    return b.join(last, "buffer_idx")


def latest_buffer_summary(df: DataFrame, name_col: str, seq: str, n: int,
                          n_buckets: int | None = None) -> DataFrame:
    """One row per file name: which buffer survives and its row range."""
    rn = row_numbers(df, [], [seq], "_rn", n_buckets=n_buckets)
    b = rn.withColumn("buffer_idx", F.expr(f"(_rn - 1) div {int(n)}"))
    per_buf = (b.groupBy("buffer_idx")
                .agg(F.max_by(name_col, seq).alias("file_name"), F.count(F.lit(1)).alias("buffer_rows"),
                     F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))
                .where(F.col("buffer_rows") == n))
    # latest buffer per name as a partial/final aggregate: a name owning most
    # buffers is combined map-side instead of sorted in one window task
    latest = per_buf.groupBy("file_name").agg(
        F.max(F.struct("buffer_idx", "buffer_rows", "first_seq", "last_seq")).alias("_l"))
    return latest.select("file_name", "_l.buffer_idx", "_l.buffer_rows", "_l.first_seq", "_l.last_seq")


def write_latest(df: DataFrame, path: str, name_col: str, seq: str, n: int, fmt: str = "json") -> None:
    """Write each name's latest buffer under ``path/file_name=<name>/``.

    Dynamic partition overwrite replaces only the names present in this run.
    """
    out = latest_buffers(df, name_col, seq, n)
    (out.drop("buffer_rows").write
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite").partitionBy("file_name").format(fmt).save(path))
