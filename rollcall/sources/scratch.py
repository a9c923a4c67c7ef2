"""Folders that the cluster shares, and tables that are published together in them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder below the warehouse where it is unset: both are shared by a cluster's nodes."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return base.rstrip("/") + "/rollcall"


def scratch(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: ``df`` as a table in the shared folder."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """Listing and marker files on Spark's file systems, without a job."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm  # noqa: SLF001
        self.path = self._at(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def statuses(self) -> list:
        return list(self.fs.listStatus(self.path)) if self.fs.exists(self.path) else []

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.statuses())

    def delete(self) -> None:
        """The folder or file and all below it; nothing happens where there is none."""
        self.fs.delete(self.path, True)

    def mark(self, name: str) -> None:
        """Create an empty file; an error if it is there."""
        self.fs.create(self._at(f"{self.path}/{name}"), False).close()


def source_state(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the names, sizes and times of a folder's files: changes when the source does."""
    h = hashlib.sha256(sf_dir.encode())
    todo = [sf_dir]
    while todo:
        for s in sorted(Files(spark, todo.pop()).statuses(), key=lambda s: s.getPath().getName()):
            h.update(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}".encode())
            if s.isDirectory():
                todo.append(str(s.getPath()))
    return h.hexdigest()[:24]


@cache
def code_state() -> str:
    """A digest of the code that builds tables: what other code has built is not taken for its own."""
    h = hashlib.sha256()
    for part in ("functions", "operators", "plans", "sources"):
        for f in sorted((Path(__file__).resolve().parents[1] / part).glob("*.py")):
            h.update(f.read_bytes())
    return h.hexdigest()[:12]


class VersionedTables:
    """Tables that a batch publishes together: files of a new version, then one marker that names them.

    A reader that took :meth:`snapshot` sees one version of every table, whatever is published meanwhile.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _marks(self) -> list[tuple[int, str, list[str]]]:
        """Version, folder and table names of each publication, in order."""
        parts = (m.split("-", 2) for m in Files(self.spark, f"{self.path}/published").names())
        return [(int(v), f"v{int(v)}-{token}", names.split("+")) for v, token, names in parts]

    def version(self) -> int:
        """The highest number that was given out; one whose publication failed after that stays unused."""
        return max(map(int, Files(self.spark, f"{self.path}/numbers").names()), default=0)

    def publish(self, tables: dict[str, DataFrame | Callable[[Callable[[str], DataFrame]], DataFrame]], by: dict[str, list[str]] | None = None) -> int:
        """``by`` names the columns that a table's folders are partitioned by.

        A table may be a function of a reader of those before it, as they were written by this publication.

        Each publication has folders of its own; of two that began with the same version the second one is refused.
        """
        v, token = self.version() + 1, uuid.uuid4().hex
        for name, table in tables.items():
            cols = (by or {}).get(name, [])
            df = table(lambda n: self.spark.read.parquet(f"{self.path}/{n}/v{v}-{token}")) if callable(table) else table
            out = df.hint("rebalance", *cols) if cols else df
            out.write.partitionBy(*cols).parquet(f"{self.path}/{name}/v{v}-{token}")
        Files(self.spark, f"{self.path}/numbers").mark(f"{v:012d}")  # only one gets the number
        Files(self.spark, f"{self.path}/published").mark(f"{v:012d}-{token}-{'+'.join(tables)}")
        return v

    def snapshot(self) -> dict[str, str]:
        """The path of each table's newest published version."""
        return {name: f"{self.path}/{name}/{folder}" for _, folder, names in self._marks() for name in names}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.snapshot()[name])
