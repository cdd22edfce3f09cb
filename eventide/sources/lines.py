"""Text-line sources.

Lines are parsed with Column expressions; bad lines are kept aside in a
quarantine column instead of failing the job, unless ``failfast`` is asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def parse_json_lines(df: DataFrame, schema: StructType | str, line: str = "line",
                     keep_corrupt: bool = True) -> DataFrame:
    """Parse a string column of JSON objects into columns.

    Fields that do not parse are NULL; with ``keep_corrupt`` a line that is not
    an object of the schema's types has its raw text in ``_corrupt``.  Missing
    and additional fields are no fault.
    """
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    full = StructType([*fields.fields, StructField("_corrupt", StringType())])
    out = df.withColumn("_j", F.from_json(F.col(line), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    extra = [F.col("_j._corrupt").alias("_corrupt")] if keep_corrupt else []
    return out.select(*[c for c in df.columns if c != line], *[F.col("_j")[f.name].alias(f.name) for f in fields.fields], *extra)


def split_key_value(df: DataFrame, line: str = "line", value_type: str = "bigint",
                    sep: str = " ", failfast: bool = False) -> DataFrame:
    """``"<key> <value>"`` lines to ``(key, value, bad)``.

    The first two tokens count, whatever follows them.  The second is read
    with ``try_cast``: a missing or non-numeric token gives ``value = NULL``
    and ``bad = true``, or with ``failfast`` fails the job when it is read.
    """
    parts = F.split(F.col(line), sep)
    key = F.get(parts, 0)
    raw = F.get(parts, 1)
    value = raw if value_type == "string" else raw.try_cast(value_type)
    bad = value.isNull() | (F.size(parts) < 2) | (key == F.lit(""))
    bad = F.coalesce(bad, F.lit(True))
    if failfast:    # inside the values themselves, so that no plan can drop the check
        fail = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(F.col(line), F.lit("NULL"))))
        key, value = F.when(bad, fail).otherwise(key), F.when(bad, fail).otherwise(value)
    return df.select("*", key.alias("key"), value.alias("value"), bad.alias("bad"))


def good_rows(df: DataFrame, count_bad: str | Observation | None = None) -> DataFrame:
    """The well-formed lines; with ``count_bad`` the others are counted as
    ``bad_lines`` under that observation (a name for streams)."""
    if count_bad is not None:
        df = df.observe(count_bad, F.count_if("bad").alias("bad_lines"))
    return df.where(~F.col("bad")).drop("bad")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch text lines as ``line STRING``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Unbounded text lines from files arriving in a folder.

    A socket is never opened; a deployment points this at a message bus.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumnRenamed("value", "line")


def ingestion_time() -> Column:
    """Processing time, only for sources that carry no event time."""
    return F.current_timestamp()
