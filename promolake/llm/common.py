"""Shared plumbing of the training-data operators: tables in the shared folder, row streams."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text that a Python worker holds as numpy arrays at once.
CHUNK_BYTES = 2_000_000
#: Bytes of an Arrow batch: Spark's own bound of 64 MB would be held several times by each worker and its executor.
BATCH_BYTES = 2_000_000
#: Rows of a small side that may be broadcast; beyond it a shuffle join is used.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset (tests), a new local folder, which becomes it."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_promolake_dir", None)
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = sc._promolake_dir = "file://" + tempfile.mkdtemp(prefix="promolake-")
    return at.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bounded_batches(spark: SparkSession) -> None:
    """Sets spark.sql.execution.arrow.maxBytesPerBatch of the session to BATCH_BYTES where it is larger.

    Batches then hold a few MB of text whatever the length of the texts; a row of more bytes makes a batch by itself.
    All operators do this, as the bound can only be set for a session; it changes no result."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """Within it, the shuffle files of a query go as soon as the query ends, not when the driver happens to collect garbage.

    For steps whose results stand in tables; a result that is read lazily should be built outside."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Shelf:
    """Tables that one run of an operator writes to the shared folder.

    Writing cuts the lineage: a lost executor costs the tasks of one step, not the run.  Tables that no later
    step needs are dropped early; the rest goes when the application ends, as lazy results may read them."""

    def __init__(self, spark: SparkSession, name: str):
        bounded_batches(spark)
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._close)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._shelf_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if getattr(t, "_shelf_path", None):
                _delete(self.spark, t._shelf_path)

    def _close(self) -> None:
        try:
            _delete(self.spark, self.root)
        except Exception:  # noqa: BLE001 - the application may have stopped its JVM already
            pass


def utf8(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def parts(texts, most: int = CHUNK_BYTES):
    """Start, end and UTF-8 bytes of consecutive rows of an Arrow string column, about `most` bytes together."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, j in chunks(sizes.tolist(), most):
        yield i, j, utf8(texts.slice(i, j - i))


def chunks(sizes: list[int], most: int = CHUNK_BYTES):
    """Ranges of consecutive rows with about `most` bytes together, one row at least."""
    at, total = 0, 0
    for k, n in enumerate(sizes):
        if k > at and total + n > most:
            yield at, k
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, as Python workers live through many tasks of different operators."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


class Rows:
    """The columns of a table under inner names, so that nothing in them can clash with an operator's own columns.

    `df` has columns c0, c1, ...; `names` are the given ones without those that a result of the operator replaces (names
    that differ in case only are the same)."""

    def __init__(self, df: DataFrame, *results: str):
        taken = {r.lower() for r in results}
        self.all = df.columns
        self.names = [c for c in df.columns if c.lower() not in taken]
        self.df = df.toDF(*[f"c{k}" for k in range(len(self.all))]).select(*[f"c{k}" for k, c in enumerate(self.all) if c.lower() not in taken])

    def at(self, name: str) -> str:
        """The inner name of a column."""
        same = [k for k, c in enumerate(self.all) if c == name] or [k for k, c in enumerate(self.all) if c.lower() == name.lower()]
        if not same or f"c{same[0]}" not in self.df.columns:
            raise ValueError(f"no column {name} in {self.all}")
        return f"c{same[0]}"

    def only(self, *names: str) -> DataFrame:
        """The table with these columns under their names and the others under inner ones."""
        return self.df.withColumnsRenamed({self.at(n): n for n in names})

    def back(self, df: DataFrame, *more: str) -> DataFrame:
        """df (all inner columns, some perhaps under their names by `only`, then others) under the given names."""
        inner = [c if c in df.columns else next(n for n in df.columns if not n.startswith("c") and n.lower() == self.all[int(c[1:])].lower()) for c in self.df.columns]
        return df.select(*inner, *more).toDF(*self.names, *more)


def arrow_schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def small_enough(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most `most` rows; it reads no more than it needs for that."""
    return df.limit(most + 1).count() <= most


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long with the same bits."""
    return x.view(np.int64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def factorize(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """codes and distinct values, by hashing."""
    return pd.factorize(values)
