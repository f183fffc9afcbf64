"""Packed exchange of 64-bit hashes: tasks send byte blocks per hash bucket instead of one row
per hash, so a shuffle of hundreds of millions of hashes costs a few bytes each and no JVM row.

``key = bucket bits + low 32 bits`` of the hash (for 64-bit values the bits of the bucket come
from the upper half). The number of buckets follows the number of hashes, so a bucket of evenly
spread hashes holds about ``ENTRIES``; a bucket with more, because of a hash that very many rows
share, is dealt out over as many salts as its counted hashes ask for.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
LOW = U64(0xFFFFFFFF)
#: Hashes gathered before a block is sent (4 MB of hashes; sorting takes several copies).
BLOCK = 1 << 19


#: Hashes of a group, about.
ENTRIES = 1 << 20


def bucket_count(spark: SparkSession, hashes: int = 0) -> int:
    """Power of two, at least four per shuffle partition and one per ``ENTRIES`` hashes."""
    return 1 << (max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-hashes // ENTRIES)) - 1).bit_length()


def salts_of(total: str) -> str:
    """SQL: salts of a bucket that holds ``total`` hashes."""
    return f"greatest(1, int(ceil({total} / {ENTRIES})))"


def bucket_salts(totals: DataFrame, buckets: int) -> np.ndarray:
    """Salts of every bucket from ``(bucket, total)``: one number a bucket to the driver."""
    out = np.ones(buckets, dtype=np.int64)
    many = totals.select("bucket", F.expr(salts_of("total")).alias("n")).where("n > 1").toArrow()
    out[many["bucket"].to_numpy()] = many["n"].to_numpy()
    return out


def split_by_bucket(keys: np.ndarray, buckets: int, *more: np.ndarray) -> Iterator[tuple]:
    """Yield ``(bucket, part of keys, parts of more...)`` for every bucket with rows."""
    b = ((keys >> U64(32)) & U64(buckets - 1)).astype(np.uint32 if buckets > 65536 else np.uint16)
    order = np.argsort(b, kind="stable")
    b, keys, more = b[order], keys[order], [m[order] for m in more]
    cuts = np.flatnonzero(np.diff(b)) + 1
    for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(b))):
        if hi > lo:
            yield (int(b[lo]), keys[lo:hi], *[m[lo:hi] for m in more])


def low32(keys: np.ndarray) -> bytes:
    return (keys & LOW).astype(np.uint32).tobytes()


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All blocks of a binary column as one array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


def token_key(bucket: int, low: np.ndarray) -> np.ndarray:
    """The (bucket, low 32 bits) key as one long."""
    return (np.int64(bucket) << 32) | low.astype(np.int64)


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def rows(schema: pa.Schema, values: list[tuple]) -> pa.RecordBatch:
    """A batch from row tuples (possibly none)."""
    return batch(schema, list(zip(*values)) if values else [[] for _ in schema])


#: Rows of an Arrow batch between the JVM and Python workers; texts may be long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS`` unless it is lower already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc
    if trim is not None:
        trim(0)


def lean(task: Callable) -> Callable:
    """A ``mapInArrow`` function that hands freed memory back to the system when its task ends;
    Python workers are reused and would hold on to it."""
    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()
    return run
