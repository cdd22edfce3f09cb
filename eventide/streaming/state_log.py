"""Versioned state for ``foreachBatch`` sinks.

A sink carries rows from one micro-batch to the next in two slots used in
turn: a batch reads the slot of the last commit and overwrites the other, then
writes its commit marker there too.  A crash at any point leaves the last
committed slot whole, and the state never holds more than two versions.  Only
DataFrame reads and writes are used, so it works on any shared store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession


def last_commit(spark: SparkSession, state: str, schema: str) -> Row | None:
    """The latest commit marker with its ``slot``, or ``None`` before the first.

    A slot whose marker was never finished is passed over; any other read error
    is raised, so that a storage fault cannot restart a sink from empty state.
    """
    found = []
    for slot in (0, 1):
        try:
            found += spark.read.schema(f"{schema}, slot int").parquet(f"{state}/commits/slot={slot}").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return max(found, key=lambda r: r["batch_id"], default=None)


def next_slot(last: Row | None) -> int:
    return 0 if last is None else 1 - int(last["slot"])


def kept_path(state: str, slot: int) -> str:
    return f"{state}/kept/slot-{slot}"


def keep(rows: DataFrame, state: str, slot: int) -> None:
    rows.write.mode("overwrite").parquet(kept_path(state, slot))


def commit(spark: SparkSession, state: str, slot: int, values: tuple, schema: str) -> None:
    """Write the marker of the batch whose rows were kept in ``slot``."""
    (spark.createDataFrame([(*values, slot)], f"{schema}, slot int").coalesce(1)
     .write.mode("overwrite").parquet(f"{state}/commits/slot={slot}"))
