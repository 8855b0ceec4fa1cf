"""A commit log for folders that only plain file operations reach.

A commit is a one-row Parquet dataset under ``_commits/<number>``, written by a
Spark job; it counts once its ``_SUCCESS`` marker is there. Whatever a crash
leaves behind (data without a commit, a commit without its marker) is never
read. Numbers are taken by creating the folder, so of two writers that race for
one number the second fails instead of overwriting the first.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class CommitLog:
    """Numbered commits of text fields, oldest first."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/_commits"

    def _valid(self) -> list[str]:
        return [n for n in folder_names(self.spark, self.path) if exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def _read(self, name: str) -> dict[str, str | None]:
        return self.spark.read.parquet(f"{self.path}/{name}").first().asDict()

    def last(self) -> dict[str, str | None] | None:
        names = self._valid()
        return self._read(names[-1]) if names else None

    def all(self) -> list[dict[str, str | None]]:
        return [self._read(n) for n in self._valid()]

    def commit(self, **fields: str | None) -> int:
        names = folder_names(self.spark, self.path)
        number = int(names[-1]) + 1 if names else 1
        schema = ", ".join(f"`{k}` string" for k in fields)
        self.spark.createDataFrame([tuple(fields.values())], schema).coalesce(1).write.parquet(f"{self.path}/{number:012d}")
        return number
