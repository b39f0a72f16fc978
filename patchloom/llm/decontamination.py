"""Benchmark decontamination by a broadcast set of normalised n-grams.

Windows of ``WINDOW`` consecutive benchmark words are hashed; every window of a
document's words is looked up by hash, hits are verified word by word, and the
covered words are removed, or the documents that have any.

A benchmark of up to ``BLOCK_BYTES`` is broadcast whole, as arrays of a few
times its size.  A larger one is broadcast as a bit map of its windows' hashes,
of ``MOST_BITS`` bits at most; document windows that may be in it are joined
with the benchmark's windows.  Either way documents are scanned once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm import kernels
from patchloom.llm.session import cut_lineage, prepare, schema_of, with_names

WINDOW = 10
BLOCK_BYTES = 8 << 20
TEXT_BYTES = 2 << 20
#: Bits of the map of hashes: at least LEAST_BITS and at most MOST_BITS as powers of two.
LEAST_BITS, MOST_BITS = 16, 28
MAP_PART = 1 << 18
#: Hits whose bytes are compared at once, and sets of items whose names a task keeps.
AT_ONCE, KEPT_SETS = 1 << 15, 4096

#: Bytes of words after lower-casing A-Z; anything else separates.
WORD_BYTES = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORD_BYTES[_b] = _b
WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


class Words(NamedTuple):
    """The words of a text buffer: normalised bytes, starts, ends, word offsets of rows and hashes."""

    norm: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row_at: np.ndarray
    hashes: np.ndarray

    def text(self, at: int, k: int) -> bytes:
        """The normalised text of k words."""
        return b" ".join(self.norm[s:e].tobytes() for s, e in zip(self.starts[at : at + k].tolist(), self.ends[at : at + k].tolist(), strict=True))


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    norm = WORD_BYTES[data]
    starts, ends, row_at = kernels.word_spans(norm, offsets)
    return Words(norm, starts, ends, row_at, kernels.word_hashes(norm, starts, ends))


def own_windows(words: Words, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By number of words: the first words, rows and hashes of the windows of each row; a row of fewer words is one window."""
    n = np.diff(words.row_at)
    for k in np.unique(np.minimum(n, window)).tolist():
        if k == 0:
            continue
        hashes = kernels.window_hashes(words.hashes, k)
        at = np.flatnonzero(kernels.within_rows(words.row_at, k, len(hashes)))
        row = np.searchsorted(words.row_at, at, "right") - 1
        mine = n[row] == k if k < window else n[row] >= window
        yield k, at[mine], row[mine], hashes[at[mine]]


class Lookup:
    """The distinct windows of one length as arrays: hashes in order, the place of each one's first word, and its list of items.

    Windows that the same items have share one list, as those of a common
    opening do, so a hit costs the same however many items have it.
    """

    def __init__(self, words: Words, k: int, at: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> None:
        order = np.lexsort((row, hashes))
        hashes, row, at = hashes[order], row[order].astype(np.int32), at[order]
        # A hash that several windows have is several windows only if their words differ.
        new = np.append(True, hashes[1:] != hashes[:-1])
        for i in np.flatnonzero(~new).tolist():
            new[i] = words.text(int(at[i]), k) != words.text(int(at[i - 1]), k)
        first = np.flatnonzero(new)
        self.words, self.k, self.hashes, self.at = words, k, hashes[first], at[first].astype(np.int64)
        self.lists: list[np.ndarray] = []
        self.list_of = np.empty(len(first), np.int32)
        known: dict[bytes, int] = {}
        for i, (lo, hi) in enumerate(zip(first.tolist(), [*first[1:].tolist(), len(row)], strict=True)):
            own = np.unique(row[lo:hi]) if hi - lo > 1 else row[lo:hi]
            self.list_of[i] = known.setdefault(own.tobytes(), len(known))
            if len(known) > len(self.lists):
                self.lists.append(own)
        self.shift = kernels.U64(64 - min(max(LEAST_BITS, int(len(self.hashes)).bit_length() + 3), 24))
        self.bits = np.zeros(1 << int(64 - int(self.shift)), bool)
        self.bits[self.hashes >> self.shift] = True

    def _same(self, words: Words, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether document windows have the very words of the benchmark's, byte for byte."""
        own, out = self.at[place], np.ones(len(at), bool)
        for j in range(self.k):
            size = words.ends[at + j] - words.starts[at + j]
            out &= size == self.words.ends[own + j] - self.words.starts[own + j]
        for j in range(self.k):
            left = np.flatnonzero(out)
            size = words.ends[at[left] + j] - words.starts[at[left] + j]
            total = np.append(0, np.cumsum(size))
            step = np.arange(total[-1]) - np.repeat(total[:-1], size)
            equal = words.norm[np.repeat(words.starts[at[left] + j], size) + step] == self.words.norm[np.repeat(self.words.starts[own[left] + j], size) + step]
            if len(left):
                out[left] = np.logical_and.reduceat(equal, total[:-1])
        return out

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First words of the document windows that the benchmark has, and their lists of items."""
        found = kernels.window_hashes(words.hashes, self.k)
        at = np.flatnonzero(self.bits[found >> self.shift])
        at = at[at + self.k <= words.row_at[np.searchsorted(words.row_at, at, "right")]]
        place = np.searchsorted(self.hashes, found[at])
        hits, lists = [], []
        while len(at):
            here = self.hashes[np.minimum(place, len(self.hashes) - 1)] == found[at]
            here &= place < len(self.hashes)
            at, place = at[here], place[here]
            same = np.concatenate([self._same(words, at[i : i + AT_ONCE], place[i : i + AT_ONCE]) for i in range(0, len(at), AT_ONCE)] or [np.empty(0, bool)])
            hits.append(at[same])
            lists.append(self.list_of[place[same]])
            # Another window of the same hash may be the one.
            at, place = at[~same], place[~same] + 1
        if not hits:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        at, own = np.concatenate(hits), np.concatenate(lists)
        order = np.argsort(at, kind="stable")
        return at[order], own[order]


def lookups(items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[list[str], list[Lookup]]:
    """The names of the items and a table of their windows for each number of words."""
    data, offsets = kernels.text_buffer(pa.array([t for _, t in items], pa.string()))
    words = words_of(data, offsets)
    return [i for i, _ in items], [Lookup(words, *own) for own in own_windows(words, window)]


def united(spans) -> list[dict]:
    """Spans in order of start, overlapping and touching ones made one."""
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if out and x["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(x["end"], out[-1]["end"])
        else:
            out.append({"start": x["start"], "end": x["end"]})
    return out


def _chunks(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, int, Words]]:
    data, offsets = kernels.text_buffer(batch.column(text_at))
    for lo, hi in kernels.doc_chunks(offsets, TEXT_BYTES):
        yield lo, hi, words_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


SPANS = "array<struct<start:bigint,end:bigint>>"
FOUND = f"n_words bigint, spans {SPANS}, items array<string>"


def _hits(words: Words, tables: list[Lookup]) -> tuple[list[list[dict]], list[frozenset]]:
    """Per row its united hit spans, and the lists of items found, as (table, list)."""
    n = len(words.row_at) - 1
    spans: list[list[dict]] = [[] for _ in range(n)]
    lists: list[set] = [set() for _ in range(n)]
    for t, table in enumerate(tables):
        at, own = table.hits(words)
        if not len(at):
            continue
        row = np.searchsorted(words.row_at, at, "right") - 1
        for r, o in np.unique(np.stack([row, own]), axis=1).T.tolist():
            lists[r].add((t, o))
        # Windows whose starts are no more than their length apart are one span.
        cut = np.append(True, (row[1:] != row[:-1]) | (at[1:] > at[:-1] + table.k))
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(at)) - 1
        base = words.row_at[row[first]]
        for r, lo, hi in zip(row[first].tolist(), (at[first] - base).tolist(), (at[last] - base + table.k).tolist(), strict=True):
            spans[r].append({"start": lo, "end": hi})
    return [united(x) for x in spans], [frozenset(x) for x in lists]


class Names:
    """The sorted names of the items of sets of lists, and their digests; sets met before are kept."""

    def __init__(self, names: list[str], tables: list[Lookup]) -> None:
        self.names, self.tables = names, tables
        self.known: dict[frozenset, list[str]] = {}
        self.digests: dict[frozenset, tuple[int, str]] = {}

    def of(self, lists: frozenset) -> list[str]:
        if lists not in self.known:
            if len(self.known) >= KEPT_SETS:
                self.known.clear()
            rows = np.unique(np.concatenate([self.tables[t].lists[o] for t, o in lists])) if lists else []
            self.known[lists] = sorted({self.names[i] for i in rows})
        return self.known[lists]

    def digest(self, lists: frozenset) -> tuple[int, str]:
        if lists not in self.digests:
            if len(self.digests) >= KEPT_SETS:
                self.digests.clear()
            own = self.of(lists)
            self.digests[lists] = (len(own), hashlib.sha256(",".join(own).encode()).hexdigest())
        return self.digests[lists]


SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tables = shared.value
        known = Names(names, tables)
        for batch in batches:
            for lo, hi, words in _chunks(batch, text_at):
                spans, lists = _hits(words, tables)
                items = pa.array([known.of(x) for x in lists], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(np.diff(words.row_at)), pa.array(spans, SPAN_LIST), items], [*batch.schema.names, "n_words", "spans", "items"])

    return run


REPORT = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _report(shared):
    """The columns of ``REPORT`` for (doc_id, text); lists of items stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tables = shared.value
        known = Names(names, tables)
        for batch in batches:
            for lo, hi, words in _chunks(batch, 1):
                spans, lists = _hits(words, tables)
                hit = [sum(x["end"] - x["start"] for x in own) for own in spans]
                found = [known.digest(x) for x in lists]
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(words.row_at)), pa.array(hit, pa.int64()), pa.array([n for n, _ in found], pa.int64()), pa.array([d for _, d in found], pa.string()), pa.array([n > 0 for n in hit])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).filter("item IS NOT NULL")


def _benchmark_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, words in _chunks(batch, 1):
                for k, at, row, hashes in own_windows(words, window):
                    texts = [words.text(a, k) for a in at.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(hashes.view(np.int64)), pa.array(texts, pa.binary()), batch.column(0).take(pa.array(row + lo))], ["k", "hash", "words", "item"])

    return run


def _bit_map(windows: DataFrame, bits: int) -> np.ndarray:
    """A map of the hashes' first ``bits`` bits, put together from parts of ``MAP_PART`` bits."""

    def fill(table: pa.Table) -> pa.Table:
        out = np.zeros(MAP_PART, bool)
        out[table.column("bit").to_numpy() % MAP_PART] = True
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})

    bit = F.shiftrightunsigned("hash", 64 - bits)
    placed = windows.select(bit.alias("bit")).distinct().withColumn("part", (F.col("bit") / MAP_PART).cast("int"))
    out = np.zeros((max(1, (1 << bits) // MAP_PART), MAP_PART // 8), np.uint8)
    for row in placed.groupBy("part").applyInArrow(fill, "part int, bits binary").toLocalIterator():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _possible(shared, ks: list[int], bits: int, text_at: int):
    """Adds ``n_words`` and ``may``, the windows that may be the benchmark's."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("k", pa.int32()), ("words", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shift = shared.value, kernels.U64(64 - bits)
        for batch in batches:
            for lo, hi, words in _chunks(batch, text_at):
                may: list[list[dict]] = [[] for _ in range(hi - lo)]
                for k in ks:
                    found = kernels.window_hashes(words.hashes, k) >> shift
                    at = np.flatnonzero(table[found >> kernels.U64(3)] >> (kernels.U64(7) - (found & kernels.U64(7))).astype(np.uint8) & 1)
                    row = np.searchsorted(words.row_at, at, "right") - 1
                    for a, r in zip(at.tolist(), row.tolist(), strict=True):
                        if a + k <= words.row_at[r + 1]:
                            may[r].append({"start": a - int(words.row_at[r]), "k": k, "words": words.text(a, k)})
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(np.diff(words.row_at)), pa.array(may, kind)], [*batch.schema.names, "n_words", "may"])

    return run


def _joined(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``docs`` with the columns of ``FOUND``, by a join of windows; rows of equal id and text are one document's."""
    windows = cut_lineage(items.mapInArrow(_benchmark_windows(window), "k int, hash bigint, words binary, item string").distinct())
    ks = sorted(r["k"] for r in windows.select("k").distinct().collect())
    bits = min(max(LEAST_BITS + 2, int(windows.count()).bit_length() + 3), MOST_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(_bit_map(windows, bits))
    key: Column = F.struct(F.col("doc_id").cast("string").alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"))
    keyed = docs.withColumn("key", key)
    may = keyed.select("key", "text").mapInArrow(_possible(shared, ks, bits, 1), "key struct<id:string,text:string>, text string, n_words bigint, may array<struct<start:bigint,k:int,words:binary>>").drop("text")
    may = cut_lineage(may.dropDuplicates(["key"]))
    each = may.select("key", F.explode("may").alias("m")).select("key", "m.start", "m.k", "m.words")
    hits = each.join(windows.select("k", "words", "item"), ["k", "words"])
    found = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("k")).alias("end")))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    ready = may.select(F.col("key").alias("own"), "n_words").join(found.withColumnRenamed("key", "own"), "own", "left")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    out = keyed.join(ready, keyed["key"].eqNullSafe(ready["own"])).select(*docs.columns, "n_words", none("spans", SPANS), none("items", "array<string>"))
    return out.mapInArrow(_united, out.schema)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("spans")
        yield batch.set_column(at, batch.schema.field(at), pa.array([united(x) for x in batch.column(at).to_pylist()], SPAN_LIST))


def _broadcast(items: DataFrame, window: int, block_bytes: int):
    """The benchmark's windows for all tasks, or None if its texts are larger than ``block_bytes``."""
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    if int(size) > block_bytes:
        return None
    return items.sparkSession.sparkContext.broadcast(lookups([(r["item"], r["text"]) for r in items.collect()], window))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``docs`` and ``n_words``, ``spans``, the hit word spans, and ``items``, those found.

    A null or empty text has no words; a text of any length is searched whole;
    an empty benchmark hits nothing, nor does an item without words or id.
    Repeated rows each get the result; an empty table stays empty.  Spans are
    united, so none overlap or touch.
    """
    prepare(docs.sparkSession)
    items = _items(benchmark)
    shared = _broadcast(items, window, block_bytes)
    if shared is None:
        return _joined(docs, items, window)
    return docs.mapInArrow(_scan(shared, docs.columns.index("text")), f"{schema_of(docs)}, {FOUND}")


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        hit = [sum(x["end"] - x["start"] for x in spans) for spans in frame["spans"]]
        digest = [hashlib.sha256(",".join(items).encode()).hexdigest() for items in frame["items"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "n_words": frame["n_words"], "n_hit": hit, "n_items": [len(x) for x in frame["items"]], "items_sha256": digest, "contaminated": [n > 0 for n in hit]})


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: words, hit words, items with occurring windows, their digest, and whether any word was hit.

    Edge cases are those of ``find_hits``: no words give zeros and the digest of
    an empty list.
    """
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    prepare(docs.sparkSession)
    items = _items(benchmark)
    shared = _broadcast(items, window, block_bytes)
    if shared is not None:
        return own.mapInArrow(_report(shared), f"doc_id {id_type}, {REPORT}")
    return _joined(own, items, window).select("doc_id", "n_words", "spans", "items").mapInPandas(_finish, f"doc_id {id_type}, {REPORT}")


def _strip(text_at: int, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(text_at).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if text is not None and spans:
                    raw = np.frombuffer(text.encode(), np.uint8)
                    starts, ends, _ = kernels.word_spans(WORD_BYTES[raw], np.array([0, len(raw)]))
                    keep = np.ones(len(raw), bool)
                    for x in spans:
                        keep[starts[x["start"]] : ends[x["end"] - 1]] = False
                    text = raw[keep].tobytes().decode()
                out.append(text)
            columns = batch.columns[:kept]
            columns[text_at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:kept])

    return run


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, with all their columns whatever their names, their texts without hit words and what lies between them.

    A null text stays null; other edge cases are those of ``find_hits``.
    """

    def clean(d: DataFrame) -> DataFrame:
        d = d.withColumn("text", F.col("text").cast("string"))
        return find_hits(d, benchmark, window, block_bytes).mapInArrow(_strip(d.columns.index("text"), len(d.columns)), d.schema)

    return with_names(docs, ["doc_id", "text"], clean)


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, with all their columns whatever their names, whose text has no benchmark window.

    So a null or empty text stays, repeated rows stay or go together, and an empty
    table or benchmark changes nothing; other edge cases as in ``find_hits``.
    """
    clean = lambda d: find_hits(d, benchmark, window, block_bytes).filter(F.size("items") == 0).select(*d.columns)
    return with_names(docs, ["doc_id", "text"], clean)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
v AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS t FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least({WINDOW}, len(w)) AS k FROM b WHERE len(w) > 0))),
o AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS t FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM v) WHERE len(w) >= k)),
h AS (SELECT r, i, k, item FROM o JOIN v USING (k, t)),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
f AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN f USING (r)
"""
