"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.session import checkpoint_dir

#: The ASCII white space that separates words: U+0020 and U+0009 to U+000D. ``bytes.split()``
#: and ``bytes.translate(None, SPACE)`` use exactly this set on UTF-8.
SPACE = b" \t\n\x0b\x0c\r"

_MASK = (1 << 64) - 1


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The plain Parquet scan of one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Intermediate tables of one run, in the folder that ``spark.checkpoint.dir`` names.

    A written table cuts the lineage: a lost executor loses nothing that a later stage
    needs, and both sides of a later join start from an exchange that AQE can split.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later stage reads (all without names)."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [f"{self.root}/{n}" for n in names] or [self.root]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def text_bytes(col="text"):
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b""))


def text_length(col="text"):
    return F.coalesce(F.length(F.col(col).cast("string")), F.lit(0)).cast("long")


def text_version(col="text"):
    """A hash of the whole text: with the id, it tells rows that repeat an id apart."""
    return F.xxhash64(text_bytes(col))


def doc_bucket(modulus: int, col="doc_id"):
    """``crc32`` of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def byte_slices(batch, columns: list[int], limit: int = 1 << 19):
    """Slices of a record batch whose binary ``columns`` hold at most ``limit`` bytes together (one row at least)."""
    ends = np.r_[0, np.cumsum(sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64) for c in columns))]
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + limit, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def release_memory() -> None:
    """Hands memory that was freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run):
    """``run`` (iterator to iterator), followed by ``release_memory``.

    Spark keeps a Python worker for later tasks: without this, each holds the most that any of its tasks took.
    """
    def steps(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return steps


class WordIds(dict):
    """word -> 64-bit id (keyed BLAKE2b), remembered for the first ``limit`` words of a task."""

    def __init__(self, salt: bytes = b"", limit: int = 300_000):
        super().__init__()
        self.salt, self.limit = salt, limit

    def __missing__(self, word: bytes) -> int:
        v = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.salt).digest(), "little")
        if len(self) < self.limit:
            self[word] = v
        return v

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (murmur-style), element-wise and wrapping."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(ids: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash (modulo 2**64) of every ``width`` consecutive ids, by doubling.

    ``ids`` are already uniform 64-bit values, so the low bits are as good as the high ones
    once ``mix64`` has been applied.
    """
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power = None, 0, ids
    step = 1                                  # power[i] is the hash of ids[i : i + step]
    while True:
        if width & step:
            if out is None:
                out, done = power[:], step
            else:                             # append the step ids that follow the done ones
                mul = np.uint64(pow(base, step, 1 << 64))
                m = len(power) - done
                out, done = out[:m] * mul + power[done:], done + step
        if step * 2 > width:
            break
        mul = np.uint64(pow(base, step, 1 << 64))
        power = power[:-step] * mul + power[step:]
        step *= 2
    return mix64(out[:n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
