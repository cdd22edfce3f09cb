"""Sinks (T5-T8).

Results are written by the executors, never gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as a JSON text line, ``line STRING`` (T7 ``data`` part)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("line"))


def bundle(df: DataFrame, path: str) -> int:
    """``{data: [...], total: N}`` as a folder: ``data/`` JSON lines and a
    one-row ``total/`` (T7).  The count is taken in the same job through an
    observation; no document passes through the driver."""
    from eventide.operators.metrics import counted

    observed, obs = counted(df, "total")
    observed.write.mode("overwrite").json(f"{path}/data")
    total = int(obs.get["total"])
    df.sparkSession.range(1).select(F.lit(total).alias("total")).write.mode("overwrite").json(f"{path}/total")
    return total


def write_text_overwrite(df: DataFrame, path: str, column: str) -> None:
    """Text sink that replaces the previous output (T6).  All rows are kept;
    the caller picks 'the last one' with a query, not by overwriting."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
