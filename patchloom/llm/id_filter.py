"""A bit map of document ids of bounded size, to leave most documents out of a shuffle.

The map has at most ``PRIMES[-1]`` bits (8 MB), however many ids there are.  A
document whose bit is set may still be none of them, so it only saves work and
never decides a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIMES = (4194301, 16777213, 67108859)


class IdFilter:
    def __init__(self, bits: Broadcast, prime: int) -> None:
        self.bits, self.prime = bits, prime

    @classmethod
    def of(cls, ids: DataFrame) -> IdFilter:
        """The filter of ``ids (doc)``; the table should be cheap to read twice."""
        n = ids.count()
        prime = next((p for p in PRIMES if p >= 32 * n), PRIMES[-1])
        words = ids.groupBy(F.expr(f"pmod(doc, {prime}) div 64").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(doc, {prime}) % 64 AS int)))").alias("bits"))
        out = np.zeros(prime // 64 + 1, np.int64)
        table = words.toArrow()
        out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
        return cls(ids.sparkSession.sparkContext.broadcast(out.view(np.uint8)), prime)

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        bit = ids % self.prime
        return (self.bits.value[bit >> 3] >> (bit & 7) & 1).astype(bool)

    def keep(self, batch: pa.RecordBatch, held: bool = True) -> pa.RecordBatch:
        """The rows whose first column may (or, with ``held`` false, can't) be one of the ids."""
        may = self.may_hold(batch.column(0).to_numpy(zero_copy_only=False))
        return batch.filter(pa.array(may if held else ~may))
