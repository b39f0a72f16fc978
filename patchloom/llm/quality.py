"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every hashed token has a sparse ternary index vector that follows from its
hash.  A token's context vector is the sum of the index vectors of its
neighbours, over all documents; tokens share ``BUCKETS`` rows, so the table has
one size whatever the corpus is.  A document's tokens are pooled into the mean
of their vectors.  The network is trained by numpy on a bounded sample of
labelled documents, part of which sets the temperature of its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm import kernels
from patchloom.llm.labelled import SAMPLE_ROWS, held_out, training_rows
from patchloom.llm.session import free_name, prepare, schema_of, with_names

BITS, DIMENSIONS, NON_ZERO = 13, 48, 4
BUCKETS = 1 << BITS
BLOCK = 128
HIDDEN, EPOCHS, RATE, DECAY = 32, 150, 5e-3, 1e-4
FAN_IN = 256
TEXT_BYTES = 1 << 20

WORDS = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORDS[_b] = _b
WORDS[0x41:0x5B] = np.arange(0x61, 0x7B)
SIGNS = np.zeros(256, np.uint8)
for _b in range(0x21, 0x7F):
    if not WORDS[_b]:
        SIGNS[_b] = _b
SIGNS[0x0A] = 0x0A


def _index_table() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    bits = kernels.mix(np.arange(BUCKETS * NON_ZERO, dtype=np.uint64) + np.uint64(77)).reshape(BUCKETS, NON_ZERO)
    return (bits % np.uint64(DIMENSIONS)).astype(np.int64), np.where(bits >> np.uint64(63), 1.0, -1.0)


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and runs of signs of a text buffer, in order, and their row offsets."""
    parts = []
    for table in (WORDS, SIGNS):
        norm = table[data]
        starts, ends, _ = kernels.word_spans(norm, offsets)
        parts.append((starts, kernels.word_hashes(norm, starts, ends) >> np.uint64(64 - BITS)))
    starts = np.concatenate([parts[0][0], parts[1][0]])
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    return np.concatenate([parts[0][1], parts[1][1]]).astype(np.int64)[order], np.searchsorted(starts, offsets)


def _chunks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = kernels.text_buffer(batch.column(at))
    for lo, hi in kernels.doc_chunks(offsets, TEXT_BYTES):
        yield buckets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _count_contexts(salts: int):
    """A partition's context sums, as one row per block of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, sign = _index_table()
        sums = np.zeros(BUCKETS * DIMENSIONS)
        for batch in batches:
            for token, row_at in _chunks(batch, 0):
                same = np.ones(max(0, len(token) - 1), bool)
                inner = row_at[1:-1]
                same[inner[(inner > 0) & (inner < len(token))] - 1] = False
                left, right = token[:-1][same], token[1:][same]
                for own, other in ((left, right), (right, left)):
                    for k in range(NON_ZERO):
                        sums += np.bincount(own * DIMENSIONS + place[other, k], weights=sign[other, k], minlength=len(sums))
        salt = TaskContext.get().partitionId() % salts
        rows = sums.reshape(-1, BLOCK * DIMENSIONS).astype("<f8")
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), salt), pa.int32()), pa.array(np.arange(len(rows)), pa.int32()), pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary())], ["salt", "block", "sums"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x.as_buffer(), "<f4").astype(float) for x in table.column("sums")], axis=0)
    return table.slice(0, 1).set_column(table.schema.get_field_index("sums"), "sums", pa.array([total.astype("<f4").tobytes()], pa.binary()))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of context vectors over all rows of ``docs (text)``, each of unit length."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    salts = max(1, -(-texts.rdd.getNumPartitions() // FAN_IN))
    schema = "salt int, block int, sums binary"
    sums = texts.mapInArrow(_count_contexts(salts), schema).groupBy("salt", "block").applyInArrow(_add, schema).groupBy("block").applyInArrow(_add, schema)
    table = np.zeros((BUCKETS // BLOCK, BLOCK * DIMENSIONS))
    for row in sums.collect():
        table[row["block"]] = np.frombuffer(row["sums"], "<f4")
    table = table.reshape(BUCKETS, DIMENSIONS)
    table = np.sign(table) * np.log1p(np.abs(table))
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(token: np.ndarray, row_at: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Per row: the mean vector, the mean size of its steps from token to token, and the log of its length."""
    n = np.diff(row_at)
    out = np.zeros((len(n), 2 * DIMENSIONS + 2), np.float32)
    full = np.flatnonzero(n)
    if len(full):
        own = vectors[token]
        step = np.zeros_like(own)
        step[1:] = np.abs(own[1:] - own[:-1])
        step[row_at[full]] = 0
        first = row_at[:-1][full]
        out[full, :DIMENSIONS] = np.add.reduceat(own, first) / n[full, None]
        out[full, DIMENSIONS:-2] = np.add.reduceat(step, first) / n[full, None]
    out[:, -2] = np.log1p(n)
    out[:, -1] = n == 0
    return out


def _pool(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([np.empty((0, 2 * DIMENSIONS + 2), np.float32), *(pooled(t, r, vectors) for t, r in _chunks(batch, 0))])
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1)], ["x", "label"])

    return run


class Network:
    """Two dense layers with a tanh between, trained by Adam; ``temperature`` divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        draw = np.random.Generator(np.random.PCG64(7))
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.temperature = 1.0
        width = x.shape[1]
        self.parts = [draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        fit = draw.random(len(x)) < 0.8 if len(x) >= 50 else np.ones(len(x), bool)
        self._train((x[fit] - self.mean) / self.scale, y[fit], draw)
        held = ~fit if (~fit).any() else fit
        self.temperature = self._calibrate(self._logit(x[held]), y[held])

    def _hidden(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.parts[0] + self.parts[1])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return self._hidden((x - self.mean) / self.scale) @ self.parts[2] + self.parts[3][0]

    def _train(self, z: np.ndarray, y: np.ndarray, draw: np.random.Generator) -> None:
        first, second, step = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts], 0
        for _ in range(EPOCHS):
            order = draw.permutation(len(z))
            for lo in range(0, len(z), 256):
                some = order[lo : lo + 256]
                hidden = self._hidden(z[some])
                error = (1 / (1 + np.exp(-np.clip(hidden @ self.parts[2] + self.parts[3][0], -30, 30))) - y[some]) / len(some)
                back = np.outer(error, self.parts[2]) * (1 - hidden**2)
                slopes = [z[some].T @ back + DECAY * self.parts[0], back.sum(0), hidden.T @ error + DECAY * self.parts[2], np.array([error.sum()])]
                step += 1
                for p, g, a, b in zip(self.parts, slopes, first, second, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _calibrate(logit: np.ndarray, y: np.ndarray) -> float:
        """The temperature of least log loss on a grid."""
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.mean(np.logaddexp(0, np.where(y > 0, -logit, logit) / t)) for t in grid]
        return float(grid[int(np.argmin(loss))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._logit(x) / self.temperature, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, rows: int = SAMPLE_ROWS) -> Network | None:
    """The network for ``labels.quality``; none without labels of both kinds."""
    sample = training_rows(docs, labels, "quality", rows).mapInArrow(_pool(vectors), "x binary, label int").toPandas().sort_values(["x", "label"], ignore_index=True)
    if sample["label"].nunique() < 2:
        return None
    return Network(np.stack([np.frombuffer(b, np.float32) for b in sample["x"]]).astype(float), sample["label"].to_numpy().astype(float))


def _score(vectors: np.ndarray, network: Network | None, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.empty(0)]
            for token, row_at in _chunks(batch, text_at):
                got.append(network.probability(pooled(token, row_at, vectors).astype(float)) if network else np.full(len(row_at) - 1, 0.5))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got))], [*batch.schema.names, "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, column: str = "quality") -> DataFrame:
    """The rows of ``docs``, all columns, and the probability as ``column``, with underscores after it if ``docs`` has that name.

    Word vectors come from all rows; the network learns from at most ``rows``
    labelled rows outside the held-out fold.  Null and empty texts have no
    tokens and share one score.  Without labels of both kinds every score is a
    half.  Repeated rows score alike; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    vectors = word_vectors(docs)
    network = fit(docs, labels, vectors, rows)
    name = free_name(docs.columns, column)
    plain = lambda d: d.mapInArrow(_score(vectors, network, d.columns.index("text")), f"{schema_of(d)}, score double")
    return with_names(docs, ["text"], plain).toDF(*docs.columns, name)


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row.

    Nulls, empty and very long texts, repeated rows, missing labels and an empty
    table are as in ``scored``; a null ``doc_id`` is held out; other columns are
    not read.
    """
    found = scored(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels, rows, "score")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
