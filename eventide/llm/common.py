"""Helpers shared by the training-data operators: tables written to the shared
folder, connected components by star contraction, running offsets."""

from __future__ import annotations

import inspect
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import scratch_path


def ship_by_value() -> None:
    """Pickle the calling module by value, so that its functions reach Python
    workers that cannot import this repository."""
    name = inspect.currentframe().f_back.f_globals["__name__"]
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship_by_value()


class Shared:
    """A broadcast value of the caller's own classes.  Spark pickles broadcasts
    by reference to modules the workers may not have, so the value travels as
    bytes that hold its classes too."""

    def __init__(self, spark: SparkSession, value: Any):
        self.packed, self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"packed": self.packed, "held": None}

    @property
    def value(self) -> Any:
        if self.held is None:
            self.held = cloudpickle.loads(self.packed.value)
        return self.held


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """``make()``, once per Python worker process: kept between its tasks, in
    a module of its own since this one is shipped with every task."""
    state = sys.modules.setdefault("_eventide_worker", types.ModuleType("_eventide_worker"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of few rows (views, not copies): Python objects
    are made for one piece at a time, however large Spark's batches are."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage
    and survives the loss of executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest member index) of each of ``n`` nodes under
    the links ``a[i]-b[i]``; hooks roots and halves paths until stable."""
    lab = np.arange(n)
    if not len(a):
        return lab
    while True:
        ra, rb = lab[a], lab[b]
        live = ra != rb
        if not live.any():
            return lab
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(lab, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up


def _signature(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of links between long ids: ``(node, component)``
    for every node that has a link, component = its smallest reachable id.

    Alternating large-star and small-star contraction.  A round aggregates the
    smallest neighbour per node and joins it back; both sides of that join are
    plain exchanges, so AQE splits the rows of a hot node.  Each round is
    written to the shared folder.
    """
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where("u <> v").distinct(), "edges")
    sig = _signature(e)
    while sig[0]:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "low")
        large = materialize(sym.join(low, "u").where("v > u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "small")
        last, sig = sig, _signature(e)
        if sig == last:
            break
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def offsets_by_order(df: DataFrame, order: list[Column], size: str, out: str) -> DataFrame:
    """Exclusive running sum of ``size`` (a non-null long) over all rows in
    ``order``, without a one-task window: rows are dealt into ordered ranges,
    summed inside their range and written once; only the ranges' totals, one
    row each, are accumulated.  ``order`` must be a total order.
    """
    at = df.columns.index(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            end = total + np.cumsum(b.column(at).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(end - b.column(at).to_numpy(zero_copy_only=False), pa.int64())],
                                             [*b.schema.names, "_local"])
            total = int(end[-1]) if len(end) else total

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                        .mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_local", T.LongType())]))
                        .withColumn("_part", F.spark_partition_id()), "dealt")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(dealt.groupBy("_part").agg(F.sum(size).alias("_total"))
                       .select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("long").alias("_base")), "base")
    return dealt.join(base, "_part").withColumn(out, F.col("_base") + F.col("_local")).drop("_base", "_local", "_part")
