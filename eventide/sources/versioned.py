"""Tables updated by rewriting the files an update touches, no others.

A table is a folder of Parquet files and of manifests; a manifest names the
files of one version.  An update finds the files that hold rows to change by
``_metadata.file_path``, writes their new contents beside them, and then the
manifest of the next version.  Until that is written readers see the version
before, whole; files of an update that was lost are never named.  Old versions
stay readable.  One writer at a time; files and manifests are written by Spark
alone, so any shared store will do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.updates import conditional_update

_MANIFEST = "file string, types string, version int"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """The versions whose manifest is there."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests").select("version").distinct().collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r.version for r in rows)

    def _manifest(self, version: int | None) -> tuple[int, list[str], T.StructType]:
        found = self.versions()
        if not found or version is not None and version not in found:
            raise ValueError(f"no version {'' if version is None else version} of {self.path}")
        version = found[-1] if version is None else version
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests").where(F.col("version") == version).collect()     # a row a file
        return version, sorted(r.file for r in rows if r.file), T.StructType.fromJson(json.loads(rows[0].types))

    def _write(self, df: DataFrame) -> list[str]:
        """New files with the rows of ``df``; their names."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return self._files(self.spark.read.schema(df.schema).parquet(folder))

    @staticmethod
    def _files(df: DataFrame) -> list[str]:
        return [r[0] for r in df.select("_metadata.file_path").distinct().collect()]       # a name a file

    def _commit(self, version: int, files: list[str], schema: T.StructType) -> int:
        rows = self.spark.createDataFrame([(f, schema.json()) for f in files or [None]], "file string, types string")
        while True:
            try:
                rows.coalesce(1).write.parquet(f"{self.path}/manifests/version={version}")
                return version
            except AnalysisException as e:      # the folder of a manifest that was never finished
                if e.getCondition() != "PATH_ALREADY_EXISTS" or version in self.versions():
                    raise
                version += 1

    def create(self, df: DataFrame) -> int:
        """Version 0.  Rows dealt by what updates select on (``repartitionByRange``)
        leave few files to touch."""
        if self.versions():
            raise ValueError(f"{self.path} is a table already")
        return self._commit(0, self._write(df), df.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default."""
        _, files, schema = self._manifest(version)
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def update(self, where: Column, column: str, value) -> int:
        """Set ``column`` to ``value`` on the rows ``where`` holds; returns the
        new version, or the current one if there is no such row."""
        version, files, schema = self._manifest(None)
        touched = self._files(self.read(version).where(where)) if files else []
        if not touched:
            return version
        new = self._write(conditional_update(self.spark.read.schema(schema).parquet(*touched), where, column, value))
        return self._commit(version + 1, sorted({*files} - {*touched} | {*new}), schema)

    def append(self, df: DataFrame) -> int:
        """Add rows; no file is touched."""
        version, files, schema = self._manifest(None)
        return self._commit(version + 1, sorted([*files, *self._write(df.select(schema.fieldNames()))]), schema)

    def delete(self, where: Column) -> int:
        """Drop the rows ``where`` holds."""
        version, files, schema = self._manifest(None)
        touched = self._files(self.read(version).where(where)) if files else []
        if not touched:
            return version
        kept = self.spark.read.schema(schema).parquet(*touched).where(~F.coalesce(where, F.lit(False)))
        return self._commit(version + 1, sorted({*files} - {*touched} | {*self._write(kept)}), schema)
