"""What the operators of this subpackage have in common."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java form of the contract's white space; words are the maximal runs of anything else.
SPACE = "[\\x20\\x09-\\x0D]+"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where none is named and the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="colloquy-checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000, size: int = 4 << 20) -> Iterator[None]:
    """What runs meanwhile hands Python batches of few rows and about ``size`` bytes; a longer row is a batch of its own. By
    Spark's settings a batch has 10,000 rows, whose texts lie several times over in an executor and its Python worker."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in bounds}
    try:
        for k, v in bounds.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task and would hold it beside later ones."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


class Scratch:
    """Tables of one operator run in the shared folder; what has been superseded is deleted at once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.at: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, label: str) -> DataFrame:
        path = shared_path(self.spark, label)
        schema = df.schema
        with small_batches(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        self.at[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more; others than those written here are left alone."""
        for df in tables:
            _, path = self.at.pop(id(df), (None, None))
            if path:
                place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def release(self) -> None:
        """Let executors delete the shuffle files of finished queries, which stay until the driver collects garbage."""
        gc.collect()
        self.spark._jvm.System.gc()


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns in use, so that others may have any name or content."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 buffer and int64 offsets (n + 1) of a pyarrow string column; null counts as empty."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each row (n + 1 entries).

    Rows are adjacent in ``raw``, so a row boundary ends a word as white space does.
    """
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds), vectorised."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Polynomial fingerprints modulo 2^64 of ranges of a sequence, from prefix sums."""

    def __init__(self, base: int):
        self.base = np.uint64(base | 1)
        self.inverse = np.uint64(pow(base | 1, -1, 1 << 64))
        self._up = np.ones(1, np.uint64)
        self._down = np.ones(1, np.uint64)

    @staticmethod
    def _powers(of: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, of, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def _reserve(self, n: int) -> None:
        if len(self._up) < n:
            self._up, self._down = self._powers(self.base, n), self._powers(self.inverse, n)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._reserve(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._up[: len(values)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self._down[starts]


_TABLES = [mix(np.arange(256, dtype=np.uint64) + np.uint64(1), s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_ROLL_BYTES = [Roller(0xD1342543DE82EF95), Roller(0xAF251AF3B0F025B5)]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit fingerprint of each word; ``which`` (0 or 1) names one of two independent ones."""
    roll = _ROLL_BYTES[which]
    return mix(roll.of(roll.prefix(_TABLES[which][raw]), starts, ends) + (ends - starts).astype(np.uint64), 0x632BE59BD9B4E019 + which)
