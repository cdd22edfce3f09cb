"""Scalar helpers: JSON fields, epoch milliseconds, id strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_json(col: Column | str, schema: StructType | str) -> Column:
    """Parse a JSON text column with an explicit schema."""
    return F.from_json(_c(col), schema)


def json_number(col: Column | str, path: str) -> Column:
    """A JSON field that may hold a number or a string of digits, as BIGINT.

    Non-numeric text gives NULL instead of failing the job.
    """
    return F.get_json_object(_c(col), path).try_cast("bigint")


def from_epoch_ms(col: Column | str) -> Column:
    """Epoch milliseconds to TIMESTAMP (session time zone is UTC)."""
    return F.timestamp_millis(_c(col))


def epoch_ms(col: Column | str) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ to epoch milliseconds."""
    return F.unix_millis(_c(col).cast("timestamp"))


def display_time(ms: Column | str, small: int = 50_000) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss.SSS`` text (P5).

    Values up to ``small`` are not epoch times but counters or offsets: they
    are shown as the number itself.
    """
    m = _c(ms)
    return (F.when(m <= F.lit(small), m.cast("string"))
             .otherwise(F.date_format(F.timestamp_millis(m), "yyyy-MM-dd HH:mm:ss.SSS")))


def concat_ids(*cols: Column | str) -> Column:
    """Ids joined by single spaces with a trailing space, e.g. ``"1 5 4 "``."""
    parts = []
    for c in cols:
        parts += [_c(c).cast("string"), F.lit(" ")]
    return F.concat(*parts)
