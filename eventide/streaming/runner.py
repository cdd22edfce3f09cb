"""Stream sources and a run-to-completion helper.

Sources are file streams with an explicit schema (no inference on streams).
``run_available`` drains what is there with ``Trigger.AvailableNow`` into a
Parquet sink under the shared checkpoint root, so results stay on the
executors' storage and a restart resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventide.session import scratch_path


# Files a micro-batch takes at most: bounds what one batch reads and one key's
# handler call sees, however much is available.
FILES_PER_TRIGGER = 64


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def event_stream(spark: SparkSession, path: str, schema: StructType, ts: str = "ts",
                 delay: str | None = "0 seconds",
                 max_files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Event stream with ``ts`` as TIMESTAMP and, when ``delay`` is given, a
    watermark.  TIMESTAMP_NTZ is cast first: watermarks refuse it."""
    df = file_stream(spark, path, schema, max_files_per_trigger=max_files_per_trigger)
    if ts not in df.columns:
        return df
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay) if delay is not None else df


def table_stream(spark: SparkSession, sf_dir: str, name: str, columns=None, **kw) -> DataFrame:
    """A driver table read as a stream (all current files, then new ones)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if columns:
        schema = StructType([f for f in schema.fields if f.name in columns])
    # a stream source reads a single file only through a glob: this one matches that name alone
    return event_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parque[t]", schema, **kw)


def start_to_parquet(df: DataFrame, out: str, checkpoint: str, output_mode: str = "append",
                     available_now: bool = True, query_name: str | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def run_available(df: DataFrame, name: str, output_mode: str = "append",
                  out: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available; return the
    written result as a batch DataFrame."""
    spark = df.sparkSession
    out = out or scratch_path(spark, name)
    q = start_to_parquet(df, f"{out}/data", f"{out}/_checkpoint", output_mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(f"{out}/data")
