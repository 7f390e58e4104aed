"""Versioned resume state: a version counts once its marker is written, after its tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..schema import COMPLETED, FAILURES

MARKER = "COMPLETE"
KEPT = 2  # complete versions; older ones are deleted after a save
# Errors that say a table of a marked version is damaged, not that the store cannot be reached.
DAMAGED = ("PATH_NOT_FOUND", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "UNABLE_TO_INFER_SCHEMA")


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _child(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")


class StateStore:
    """Completed queries with their items, and failure counts, under one folder.

    Readers take the newest complete version, so a job that dies half-way leaves the old one in
    force. The one before it is kept too: a new version may be computed from it. Works on any
    file system Hadoop knows.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        """Numbers of the complete versions, newest first."""
        fs, root = _files(self.spark, self.path)
        if not fs.exists(root):
            return []
        return sorted((
            int(entry.getPath().getName()[2:]) for entry in fs.listStatus(root)
            if entry.getPath().getName().startswith("v=")
            and fs.exists(_child(self.spark, entry.getPath().toString(), MARKER))), reverse=True)

    def version(self) -> int:
        return max(self._versions(), default=0)

    def load(self) -> tuple[DataFrame, DataFrame]:
        """Completed and failures; empty tables if there is no state or it cannot be read."""
        version = self.version()
        return (self._table(version, "completed", COMPLETED),
                self._table(version, "failures", FAILURES))

    def _table(self, version: int, name: str, schema) -> DataFrame:
        """A table of a version. A damaged one (missing, unreadable footer, no schema) is empty as a
        whole, never in part, and the job asks again what it held; any other error, such as a store
        that cannot be reached, is raised, so that no job starts over from an empty state by mistake."""
        empty = self.spark.createDataFrame([], schema)
        if version == 0:
            return empty
        path = f"{self.path}/v={version}/{name}"
        try:
            found = self.spark.read.parquet(path).schema
        except PySparkException as error:
            if (error.getCondition() or "").split(".")[0] in DAMAGED:
                return empty
            raise
        except Py4JJavaError as error:  # a failed footer read comes as a failed job
            if any(condition in str(error.java_exception) for condition in DAMAGED):
                return empty
            raise
        return self.spark.read.schema(schema).parquet(path) if set(
            schema.names) <= set(found.names) else empty

    def note(self) -> str:
        """What the newest version was saved with."""
        version = self.version()
        line = self.spark.read.text(f"{self.path}/v={version}/{MARKER}").first() if version else None
        return line[0] if line else ""

    def save(self, completed: DataFrame, failures: DataFrame, note: str = "") -> int:
        """Write the next version; its marker, which holds ``note``, comes last. Then delete what
        is older than the last two."""
        version = self.version() + 1
        target = f"{self.path}/v={version}"
        completed.select("query", "items").write.mode("overwrite").parquet(f"{target}/completed")
        failures.select("query", "n").write.mode("overwrite").parquet(f"{target}/failures")
        fs, _ = _files(self.spark, self.path)
        marker = fs.create(_child(self.spark, target, MARKER), True)
        marker.writeBytes(note)
        marker.close()
        for old in self._versions()[KEPT:]:
            fs.delete(_child(self.spark, self.path, f"v={old}"), True)
        return version

    def clear(self) -> int:
        """Start over: an empty version becomes the newest."""
        empty = self.spark.createDataFrame([], COMPLETED), self.spark.createDataFrame([], FAILURES)
        return self.save(*empty)
