"""Packed fixed-width records that Spark shuffles by a hash part.

Millions of small records per task would each cost a row; instead a task sends
one binary row per part for each run of documents.  Byte planes are stored one
after the other, so that slowly changing columns compress in the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from patchloom.llm import kernels

#: After a part of this size a worker gives freed memory back.
TIDY_BYTES = 4 << 20
SCHEMA = "part int, kind int, data binary"


def part_count(spark: SparkSession) -> int:
    """Several parts for each shuffle partition, so that hashing them spreads evenly."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def pack(records: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(records).view(np.uint8).reshape(len(records), -1)
    return np.ascontiguousarray(raw.T).tobytes()


def unpack(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    out = np.empty(sum(len(b) for b in blobs) // dtype.itemsize, dtype)
    at = 0
    for b in blobs:
        n = len(b) // dtype.itemsize
        out[at : at + n] = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n)
        at += n
    return out


def deal(kind: int, keys: np.ndarray, records: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Rows of ``SCHEMA``: the records of each part."""
    part = part_of(keys, parts)
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    part, records = part[order], records[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(part)], strict=True):
        if hi > lo:
            yield int(part[lo]), kind, pack(records[lo:hi])


def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], ["part", "kind", "data"])


def by_part(blobs: DataFrame, function, schema: str) -> DataFrame:
    """Apply ``function(dict of kind -> list of blobs) -> pa.Table`` to each part."""

    def run(table: pa.Table) -> pa.Table:
        kinds, data = table.column("kind").to_pylist(), table.column("data")
        got: dict[int, list[bytes]] = {}
        for kind, blob in zip(kinds, data, strict=True):
            got.setdefault(kind, []).append(blob.as_buffer())
        out = function(got)
        if table.nbytes > TIDY_BYTES:
            got.clear()
            kernels.release()
        return out

    return blobs.groupBy("part").applyInArrow(run, schema)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in columns that are sorted together."""
    n = len(keys[0])
    if n == 0:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
