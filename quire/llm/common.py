"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, wherever a contract counts words: bytes that are no ASCII white space.
#: ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []
_scope = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir; one of our own where unset, on one machine only."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quire-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed when the driver's Python ends, or with the ``passing`` around it."""
    path = f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex}"
    getattr(_scope, "written", _written).append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def passing() -> Iterator[None]:
    """What this thread writes inside is removed at the end: for work whose result is written elsewhere by then."""
    outer = getattr(_scope, "written", None)
    _scope.written = inner = []
    try:
        yield
    finally:
        if outer is None:
            del _scope.written
        else:
            _scope.written = outer
        for spark, path in inner:
            remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts the lineage: an executor that is lost takes nothing of it along.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared folder; for small tables within loops."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


@atexit.register
def _remove() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text (null: the empty text), modulo ``n``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def as_bytes(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def leave_small(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives what it freed back to the system: Spark keeps workers for other tasks and stages."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim:
            trim(0)

    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


MEMO_BYTES, ENTRY_BYTES = 24 << 20, 110  # of a table; of an entry's place in it


class Memo(dict):
    """A dict that computes what it lacks and starts anew when its entries hold ``budget`` bytes."""

    def __init__(self, compute, budget: int = MEMO_BYTES):
        super().__init__()
        self.compute, self.budget, self.used = compute, budget, 0

    def __missing__(self, key):
        if self.used >= self.budget:
            self.clear()
            self.used = 0
        value = self[key] = self.compute(key)
        self.used += getsizeof(key) + getsizeof(value) + ENTRY_BYTES
        return value
