"""What the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, in every operator that counts or compares words.
WORD = r"[^\x20\x09-\x0D]+"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def release() -> None:
    """Give freed memory back to the system: a worker is reused, and what it holds counts beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call, and no need of it
        return


def frugal(run: Callable) -> Callable:
    """A function over batches whose worker gives its memory back at the end, however it ends."""

    @wraps(run)
    def kept_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return kept_small


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs of the given starts and sizes, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def spark_hash(values: np.ndarray) -> np.ndarray:
    """Spark's hash of 64-bit integers (32-bit Murmur3 with its seed), by which it deals rows into buckets."""

    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    with np.errstate(over="ignore"):
        h = np.full(len(values), 42, np.uint32)
        for word in (values & 0xFFFFFFFF, (values >> 32) & 0xFFFFFFFF):
            k = rotated(word.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
            h = rotated(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(8)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return (h ^ (h >> np.uint32(16))).view(np.int32)


def block_numbers(task: int, buckets: int) -> Iterator[int]:
    """Numbers for a task's blocks that all fall into one bucket, so that the task writes one file; other tasks' differ."""
    at, step = 0, max(4096, 4 * buckets)
    while True:
        numbers = (task << 32) + np.arange(at, at + step, dtype=np.int64)
        yield from numbers[spark_hash(numbers) % buckets == task % buckets].tolist()
        at += step


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns only, under names of our own, so columns that clash or go unused never get in the way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN
        x = (x ^ (x >> np.uint64(30))) * _MIX_A
        x = (x ^ (x >> np.uint64(27))) * _MIX_B
        return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(salt))


class WordHashes(dict):
    """Word -> 64-bit hash, computed once per distinct word; emptied when it holds ``bound`` words or 16 MB of them."""

    def __init__(self, bound: int = 200_000):
        super().__init__()
        self.bound, self.held = bound, 0

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound or self.held > 1 << 24:
            self.clear()
            self.held = 0
        self.held += len(word)
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def lower_words(raw: bytes | None) -> list[bytes]:
    """Lower-case A-Z and split at the six white-space bytes; bytes.lower and bytes.split touch ASCII only."""
    return (raw or b"").lower().split()


def word_shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words make one shingle, none make none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, dtype=np.uint64)
        for j in range(width):
            out = mix64(out * np.uint64(0xFF51AFD7ED558CCD) + hashes[j : n - width + 1 + j])
    return np.unique(out)
