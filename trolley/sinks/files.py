"""Files as Spark's own file systems see them: names and sizes, removal, and small published facts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> dict[str, int]:
    """Names below a folder with their sizes; none if there is no folder."""
    if not exists(spark, path):
        return {}
    found = _system(spark, path).listStatus(_path(spark, path))
    return {status.getPath().getName(): status.getLen() for status in found}


def size_of(spark: SparkSession, path: str) -> int:
    return _system(spark, path).getFileStatus(_path(spark, path)).getLen()


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove files and folders; those gone already do not matter."""
    for path in paths:
        _system(spark, path).delete(_path(spark, path), True)


@dataclass(frozen=True)
class Commits:
    """Numbered one-row facts below a folder; the one with the highest number holds.

    A commit appears as a whole: readers ask for the marker that Spark leaves when the row is
    written. A number can be taken once, so of two writers one fails. All but the last ``keep``
    are removed in passing.
    """

    path: str
    schema: T.StructType
    keep: int = 8

    def numbers(self, spark: SparkSession) -> list[int]:
        """Of all commits that are complete."""
        named = sorted(int(name) for name in children(spark, self.path) if name.isdecimal())
        return [n for n in named if exists(spark, f"{self.path}/{n}/_SUCCESS")]

    def read(self, spark: SparkSession, number: int) -> Row:
        return spark.read.schema(self.schema).parquet(f"{self.path}/{number}").first()

    def latest(self, spark: SparkSession) -> tuple[int, Row | None]:
        numbers = self.numbers(spark)
        return (numbers[-1], self.read(spark, numbers[-1])) if numbers else (0, None)

    def publish(self, spark: SparkSession, number: int, row: Row | tuple) -> None:
        folder = f"{self.path}/{number}"
        if exists(spark, folder) and not exists(spark, f"{folder}/_SUCCESS"):
            remove(spark, [folder])  # of a writer that did not get to its end
        spark.createDataFrame([tuple(row)], self.schema).coalesce(1).write.mode("error").parquet(folder)
        old = self.numbers(spark)[: -self.keep]
        remove(spark, [f"{self.path}/{n}" for n in old])
