"""Pointers to what is valid: small tables of which the last complete one counts.

Each is written as a folder of its own, named by a number one above the highest there is, and counts once it has its success
mark.  What it points to is written before it and never overwritten, so readers, and runs that break off, see one state or
the other; no clock decides which came later.
"""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Generations:
    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _names(self) -> list[str]:
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(f.getPath().getParent().getName() for f in found or [])

    def latest(self) -> list:
        """The rows of the last generation; none if there is none."""
        names = self._names()
        return self.spark.read.schema(self.schema).json(f"{self.folder}/{names[-1]}").collect() if names else []

    def publish(self, rows: list[tuple]) -> None:
        names = self._names()
        number = int(names[-1].split("-")[0]) + 1 if names else 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.json(f"{self.folder}/{number:012d}-{uuid.uuid4().hex}")
