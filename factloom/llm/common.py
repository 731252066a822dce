"""Shared helpers: reading tables, cutting lineage, word and shingle hashes over Arrow batches.

Words are runs of bytes other than 0x20 and 0x09-0x0D; `bytes.split()` splits at exactly these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom import shared

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xBF58476D1CE4E5B9)
_D = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """As the library's materialize(); afterwards Spark may delete the shuffle files of the plan that has ended.

    It does so for plans that the driver has collected, hence the collection of the driver's own (small) heap; executors
    are not paused. Sessions without a JVM of their own (Connect) leave this to the server.
    """
    out = shared.materialize(df)
    if (jvm := _jvm(df.sparkSession)) is not None:
        jvm.System.gc()
    return out


def _jvm(spark: SparkSession):
    return getattr(getattr(spark, "_sc", None), "_jvm", None)


def release(df: DataFrame) -> None:
    """Delete a table of materialize() that nothing needs any more; without a JVM of our own it stays."""
    if (jvm := _jvm(df.sparkSession)) is not None:
        path = jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
        if path is not None:
            path.getFileSystem(df.sparkSession._sc._jsc.hadoopConfiguration()).delete(path, True)


def binary_column(batch: pa.RecordBatch, name: str) -> list:
    """A string or binary column as bytes; null gives None."""
    return batch.column(batch.schema.names.index(name)).cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """bytes word -> 64-bit hash, memoised; emptied when it has grown past `most` words."""

    def __init__(self, most: int = 500_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C
    h = (h ^ (h >> np.uint64(27))) * _D
    return h ^ (h >> np.uint64(31))


def gram_hashes(h: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all runs of n words, by doubling: h[i:i+n] as a polynomial modulo 2**64, then mixed."""
    if len(h) < n:
        return h[:0]
    parts, step, width, power, m = [], h, 1, base, n
    while m:
        if m & 1:
            parts.append((width, step, np.uint64(power)))
        m >>= 1
        if m:
            step = step[: len(step) - width] * np.uint64(power) + step[width:]
            power, width = power * power % 2**64, width * 2
    out, done = None, 0
    size = len(h) - n + 1
    for width, step, powers in reversed(parts):
        part = step[done : done + size]
        out = part if out is None else out * powers + part
        done += width
    return mix(out)


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of n-word shingles, sorted; with fewer words the whole sequence is one; no words, none."""
    if not len(h):
        return h
    return np.unique(gram_hashes(h, min(n, len(h))))


def crc_mod(column: str, n: int):
    """crc32(column as text) mod n; null stays null."""
    return F.crc32(F.col(column).cast("string")) % n
