"""Helpers shared by the corpus operators: words, scratch tables, packed arrays, numbering."""

from __future__ import annotations

import json
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a maximal run of characters other than ASCII white space. ``bytes.split()`` splits at
#: exactly these characters and ``bytes.lower()`` lowers exactly A-Z, so Python tasks agree with it.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"

def scratch_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors: ``spark.checkpoint.dir``, or one below the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return named.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems have something at ``path``."""
    return _file_system(spark, path, "exists")


def bucketed(df: DataFrame, key: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets of ``key``, sorted in each: what joins it by this key moves to it, and it stays where it is."""
    spark, path = df.sparkSession, path or new_path(df.sparkSession, "buckets")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"buckets_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return _named(spark, name)


def open_buckets(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """A table that :func:`bucketed` has written."""
    name = f"buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return _named(spark, name)


def _named(spark: SparkSession, name: str) -> DataFrame:
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    return out


def discard(df: DataFrame) -> None:
    """Delete the scratch table of a frame of :func:`materialize` that nothing will read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _file_system(df.sparkSession, folder, "delete", True)


def _file_system(spark: SparkSession, path: str, method: str, *args):
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc  # noqa: SLF001
    at = jvm.org.apache.hadoop.fs.Path(path)
    return getattr(at.getFileSystem(jsc.hadoopConfiguration()), method)(at, *args)


class Conflict(RuntimeError):
    """Another writer has published the version that this one was about to."""


class Manifest:
    """The versions of a stored index: a JSON file for each, the newest of which tells what is live, so a reader sees an old or a new state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/manifest"

    def _at(self, version: int) -> str:
        return f"{self.path}/{version:012d}.json"

    def read(self) -> tuple[int, dict]:
        """Version and state; 0 and nothing where there is none."""
        if not exists(self.spark, self.path):
            return 0, {}
        names = sorted((f.getPath().getName() for f in _file_system(self.spark, self.path, "listStatus")), reverse=True)
        io = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils  # noqa: SLF001
        for version in (int(n[:12]) for n in names if n.endswith(".json")):
            file = _file_system(self.spark, self._at(version), "open")
            try:
                return version, json.loads(io.toString(file, "UTF-8"))
            except json.JSONDecodeError:
                continue  # its writer hasn't finished, or never will
            finally:
                file.close()
        return 0, {}

    def publish(self, state: dict, after: int) -> int:
        """Make ``state`` the version that follows ``after``; refused if somebody else has done so meanwhile."""
        if self.read()[0] != after:
            raise Conflict(f"version {after + 1} of {self.path} exists")
        try:
            file = _file_system(self.spark, self._at(after + 1), "create", False)
        except Exception as e:  # the file system's own refusal of a file that exists
            raise Conflict(f"version {after + 1} of {self.path} exists") from e
        file.write(bytearray(json.dumps(state).encode()))
        file.close()
        return after + 1


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = tempfile.mkdtemp(prefix="rollcall-code-")  # stays: executors fetch it when they start
    package = Path(__file__).resolve().parents[1]
    copy = Path(top, "code", package.name)
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(str(Path(top, package.name)), "zip", copy.parent))
    _shipped.add(app)


def new_path(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that nothing uses yet."""
    return f"{scratch_dir(spark)}/rollcall/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as Parquet and read it again."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches, rows: int = 1000):
    """Arrow batches in slices of so many rows: whole texts are larger rows than the session's batches suit."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def utf8(text: str | Column) -> Column:
    """The text's UTF-8 bytes, empty for null: Python tasks get bytes without decoding."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit("")).cast("binary")


def text_hash(text: str | Column) -> Column:
    """A 64-bit hash of the text, null as empty: tells rows apart that share an id."""
    c = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(c, F.lit("")))


def pack(a: np.ndarray) -> bytes:
    """Numbers as compressed byte planes (all first bytes, then all second bytes, ...)."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(b: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TYPES = {"long": T.LongType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}


def schema(columns: str) -> T.StructType:
    """``"name type, name array<type>"`` as a schema; unlike Spark's parser it also works inside tasks."""
    fields = []
    for name, kind in (c.split() for c in columns.split(", ")):
        array = kind.startswith("array<")
        of = _TYPES[kind[6:-1] if array else kind]
        fields.append(T.StructField(name, T.ArrayType(of) if array else of))
    return T.StructType(fields)
