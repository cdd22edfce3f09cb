"""Named record counters (T4).

``Dataset.observe`` aggregates the metric inside the same job that processes
the rows (no second pass); batch results land in an ``Observation``,
streaming ones in ``StreamingQueryProgress.observedMetrics``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """Attach a row counter named ``name``; read it after an action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def counted_stream(df: DataFrame, name: str = "records") -> DataFrame:
    """Streaming counter: per micro-batch value under ``observedMetrics[name]``."""
    return df.observe(name, F.count(F.lit(1)).alias(name))
