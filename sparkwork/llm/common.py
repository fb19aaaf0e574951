"""Helpers shared by the operators: scratch tables, worker-side caches, ASCII word splitting."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (lineage ends at files all executors see)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores before it while a column of the tables has that name in some case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, for models and vocabularies that several tasks use."""
    return sys.__dict__.setdefault("_sparkwork_llm_cache", {})


def worker_cache_of(owner: str) -> dict:
    """The worker's cache, emptied if another kind of task used it: a reused worker holds one operator's data at a time."""
    cache = worker_cache()
    if cache.get("owner") != owner:
        cache.clear()
        cache["owner"] = owner
        give_back()
    return cache


def give_back() -> None:
    """Return freed memory of the worker to the system: what an operator held would else count beside the next one's."""
    gc.collect()
    trim()


def trim() -> None:
    """Return the allocators' free pages; many small objects of a batch leave some between those that stay."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if release:
        release(0)


def doc_bucket(col, n: int):
    """``crc32(doc_id as text) mod n``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


#: byte -> byte: A-Z lower-cased, every other ASCII byte that is no letter or digit -> space, all of UTF-8's
#: non-ASCII bytes kept; splitting on spaces then gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lowered text
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    """The words of a UTF-8 text, in order."""
    return raw.translate(WORD_BYTES).split()


GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_words(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three 64-bit words of each span of bytes that tell it from every other: first, last, length.

    Of a span of 16 bytes at most they hold all bytes; of a longer one the first two are a 128-bit BLAKE2 digest.
    """
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))  # from every byte on
    n = to - at
    first = eights[at]
    short = np.flatnonzero(n < 8)
    first[short] &= MASKS[n[short]]
    last = np.where(n > 8, eights[np.maximum(to - 8, 0)], np.uint64(0))
    long = np.flatnonzero(n > 16)
    if len(long):
        raw = data.tobytes()
        digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(at[long].tolist(), to[long].tolist(), strict=True)]
        first[long], last[long] = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2).T
    return first, last, n.astype(np.uint64)


def hashed_words(words: tuple[np.ndarray, np.ndarray, np.ndarray], salt: int = 0) -> np.ndarray:
    """A 64-bit name of what ``span_words`` gives; names of another ``salt`` are independent of these."""
    first, last, n = words
    out = mixed(first + np.uint64((2 * salt + 1) * int(GOLDEN) & (1 << 64) - 1))
    return mixed(mixed(out * GOLDEN + last) * GOLDEN + n)


def span_hashes(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """A 64-bit name of each span of bytes; equal spans have equal names wherever they stand."""
    return hashed_words(span_words(data, at, to))
