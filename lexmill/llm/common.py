"""Word hashes, whole-text batches and small guards that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import new_path, ship

# Rows of a batch between the JVM and Python. Whole texts are long: ten thousand of them, Spark's default, take some
# hundred megabytes on both sides of each task.
ROWS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000
# A worker forgets its remembered words beyond this number, so its memory is bounded.
REMEMBERED = 100_000

_MEMORIES: list[dict] = []  # what this worker remembers from one task to the next
_LAST = [""]  # the module whose task it ran last


def worker_memory(known: dict) -> dict:
    """``known``, emptied when the worker turns to the tasks of another module: workers outlive the stages."""
    _MEMORIES.append(known)
    return known


def begin(module: str) -> None:
    if _LAST[0] != module:
        for known in _MEMORIES:
            known.clear()
        _LAST[0] = module


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered within bounds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = worker_memory(WordHashes())


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits (splitmix finaliser, fixed constants)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, in text order; a shorter text is one shingle, none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out = mix(out + hashes[j:n - width + 1 + j])
    return out


def plain_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that Python objects of few rows exist at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def binary_list(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], type=pa.binary())


def keyed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that extra or clashing columns cannot interfere."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow holds of earlier ones goes back to the system, and does not stay with an idle worker."""
    try:
        for batch in batches:
            yield batch
            del batch
            pa.default_memory_pool().release_unused()
    finally:
        pa.default_memory_pool().release_unused()


def _forgetting(function: Callable) -> Callable:
    module = function.__module__

    def rows(batches):
        begin(module)
        yield from function(given_back(batches))

    return rows


def map_rows(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with a function of this package; the session's batches are made smaller if they are larger than that.

    A worker keeps no more than the memory of one module's tasks.
    """
    ship(df.sparkSession)
    name, rows = ROWS_AT_ONCE
    if not 0 < int(df.sparkSession.conf.get(name)) <= rows:
        df.sparkSession.conf.set(name, rows)
    return df.mapInArrow(_forgetting(function), schema)


def release(spark: SparkSession) -> None:
    """Let the driver drop what it no longer refers to, so that Spark deletes the shuffle files behind staged tables."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of one operator's run in the shared folder, deleted together once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        jvm, jsc = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)
        self.paths = []
