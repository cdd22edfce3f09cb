"""Table scans.

Every scan is ``spark.read.parquet`` with an explicit column list and
predicates, so pruning and pushdown happen in the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# The driver table names.
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def wildcard_scan(spark: SparkSession, pattern: str, doc_type: str | None = None,
                  type_col: str = "type", merge_schema: bool = False,
                  with_dataset: bool = True) -> DataFrame:
    """Scan every dataset matching a path glob, like an index wildcard.

    ``_dataset`` (when ``with_dataset``) is the path component of the row's
    file that the last component of the glob matches, without a ``.parquet``
    ending: a folder of part files or a single file.  ``doc_type`` of ``None``
    or ``"*"`` means every type; otherwise rows of that type only.
    ``merge_schema`` opens every footer; datasets of different columns need it.
    """
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(pattern)
    if with_dataset:
        depth = len([x for x in re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "", pattern).split("/") if x])
        plain = F.regexp_replace(F.col("_metadata.file_path"), r"^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "")
        part = F.element_at(F.split(plain, "/+"), depth)
        df = df.withColumn("_dataset", F.regexp_replace(F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), r"\.parquet$", ""))
    if doc_type not in (None, "*"):
        df = df.where(F.col(type_col) == F.lit(doc_type))
    return df


def write_time_partitioned(df: DataFrame, path: str, ts: str, grain: str = "day") -> None:
    """Write with a date partition column so later range scans prune files."""
    fmt = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}[grain]
    (df.withColumn("dt", F.date_format(F.col(ts), fmt))
       .write.mode("overwrite").partitionBy("dt").parquet(path))


def time_range_scan(spark: SparkSession, path: str, ts: str, start, end,
                    grain: str = "day") -> DataFrame:
    """Rows with ``start <= ts < end`` from a date-partitioned dataset.

    The ``dt`` predicate prunes partitions (``PartitionFilters``); the ``ts``
    predicate is pushed into the Parquet reader.  Half-open on purpose.
    """
    fmt = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}[grain]
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return (spark.read.parquet(path)
            .where((F.col("dt") >= F.date_format(lo, fmt)) & (F.col("dt") <= F.date_format(hi, fmt)))
            .where((F.col(ts) >= lo) & (F.col(ts) < hi)))


def time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Half-open time range on an unpartitioned table (pushed filter only)."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def full_scan(df: DataFrame, where: Column | None = None) -> DataFrame:
    """All matching rows (S7).  Count with ``.count()``; write to keep them."""
    return df if where is None else df.where(where)


def iterate_rows(df: DataFrame) -> Iterator[Row]:
    """Rows to the driver one partition at a time (bounded driver memory)."""
    return df.toLocalIterator(prefetchPartitions=False)
