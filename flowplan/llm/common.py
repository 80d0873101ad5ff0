"""Helpers shared by the operators: written tables, Arrow batches, words and 64-bit hashes."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Deleted or split on wherever a contract says ``[\x20\x09-\x0D]``.
SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new name in the folder that ``spark.checkpoint.dir`` names; only local sessions may lack one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that nothing before it is computed twice or lost."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    module = sys.modules.setdefault("_llm_worker_store", types.ModuleType("_llm_worker_store"))
    return module.__dict__.setdefault(name, {})


def give_back_memory(keep: str = "") -> None:
    """Drop what other operators left in this Python worker, all stores but ``keep``, and return free memory to the system."""
    stores = vars(sys.modules.get("_llm_worker_store", types.ModuleType("none")))
    for name in [n for n in stores if not n.startswith("__") and n != keep]:
        del stores[name]
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # the C library may lack it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, one row at least; the worker's store ``keep`` stays."""
    give_back_memory(keep)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
        block = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    give_back_memory(keep)  # the worker may now wait for long


def texts_of(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return pa.compute.fill_null(array.cast(pa.binary()), b"").to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """64-bit hashes of words, remembered up to ``limit`` distinct words."""

    def __init__(self, limit: int = 400_000):
        from xxhash import xxh3_64_intdigest

        class Table(dict):
            def __missing__(self, word):
                value = xxh3_64_intdigest(word)
                if len(self) < limit:
                    self[word] = value
                return value

        self.table = Table()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        get = self.table.__getitem__
        return np.fromiter(map(get, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """A hash of every run of ``width`` neighbours in ``hashes``; none if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + n]
        out ^= out >> np.uint64(29)
    return mix(out)
