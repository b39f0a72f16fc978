"""Ranked lexical search by MaxScore over shards of an inverted index.

A document scores, for each term of a query, w * ((1000000000 * tf) div (1000 *
tf + 20 * m)), where w falls with the number of documents that hold the term
and m grows with the document's length (``weight``, ``length_term``).

1. Shards of ``SHARD_BYTES`` of documents are indexed for the terms of the
   queries, and counted; the counts of all shards meet in Spark.
2. A shard's postings then have exact contributions, so each term has an upper
   bound there.  For a query with the threshold t of its ``k``-th best document
   so far, the terms of the least bounds that sum to less than t are
   non-essential: a document with no other term can't qualify.  The postings of
   the other, essential terms give the candidates; the non-essential lists are
   probed from the greatest bound down, for those documents only that can still
   reach t with what is left.
3. The best of each task's shards meet in one ranking for each query.  Tasks
   start from thresholds that a share of the shards has shown to be reached, so
   that they send little beside what is in the end ranked.

Queries are broadcast in blocks of about ``QUERY_BYTES``, so their number is not
limited; each block's terms are indexed in a pass of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchloom.llm import kernels
from patchloom.llm.session import cut_lineage, prepare

U64 = np.uint64
TOP = 50
SHARD_BYTES = 8 << 20
QUERY_BYTES = 4 << 20
#: One of so many shards shows thresholds for all.
SEED = 16

#: Bytes of terms: digits, letters with A-Z lower-cased, and all beyond ASCII; anything else separates.
TERM_BYTES = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    TERM_BYTES[_b] = _b
TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)

_OPTIONS = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))


def weight(documents: int, holding: int) -> int:
    """How much a term counts."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_term(terms: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents of so many terms; products beyond 64 bits are taken in Python's integers."""
    if len(terms) and int(terms.max()) * 50 * documents >= 1 << 63:
        return np.array([100 - 50 + (50 * int(n) * documents) // total for n in terms], np.int64)
    return 100 - 50 + (50 * terms * documents) // max(total, 1)


class Queries(NamedTuple):
    """Distinct term hashes in order, and of each query the places of its terms."""

    hashes: np.ndarray
    terms: list[np.ndarray]


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all terms of a column and the n + 1 offsets of its rows."""
    data, offsets = kernels.text_buffer(texts)
    norm = TERM_BYTES[data]
    starts, ends, at = kernels.word_spans(norm, offsets)
    return kernels.word_hashes(norm, starts, ends), at


def queries_of(texts: list[list[str | None]]) -> Queries:
    """The queries of a block; each has the terms of all its texts, once each."""
    own = []
    for query in texts:
        hashes, _ = _terms(pa.array(query, pa.string()))
        own.append(np.unique(hashes))
    hashes = np.unique(np.concatenate(own)) if own else np.empty(0, np.uint64)
    return Queries(hashes, [np.searchsorted(hashes, x) for x in own])


def _sealed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_OPTIONS) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


INDEX = "shard bigint, documents bigint, terms bigint, df array<struct<term:int,docs:bigint>>, ids binary, postings binary"


def _index(shared):
    """One row a shard: its counts, its documents (id, n) and its postings (term, doc, tf) in order of term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known: np.ndarray = shared.value.hashes
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            hashes, at = _terms(table.column(1))
            n = np.diff(at)
            place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[place] == hashes) if len(known) else np.empty(0, np.int64)
            doc = np.searchsorted(at, hit, "right") - 1
            both, tf = np.unique(place[hit] * len(n) + doc, return_counts=True)
            term, doc = both // max(len(n), 1), both % max(len(n), 1)
            holds, docs = np.unique(term, return_counts=True)
            df = pa.ListArray.from_arrays(pa.array([0, len(holds)], pa.int32()), pa.StructArray.from_arrays([pa.array(holds.astype(np.int32)), pa.array(docs)], ["term", "docs"]))
            ids = _sealed(pa.table({"id": table.column(0), "n": n}))
            postings = _sealed(pa.table({"term": term.astype(np.int32), "doc": doc.astype(np.int32), "tf": tf.astype(np.int32)}))
            out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()), df, pa.array([ids], pa.binary()), pa.array([postings], pa.binary())], ["shard", "documents", "terms", "df", "ids", "postings"])
            number += 1
            return out

        for batch in batches:
            _, offsets = kernels.text_buffer(batch.column(1))
            for lo, hi in kernels.doc_chunks(offsets, SHARD_BYTES):
                held.append(batch.slice(lo, hi - lo))
                size += int(offsets[hi] - offsets[lo])
                if size >= SHARD_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        kernels.release()

    return run


class Shard:
    """The postings of a shard with their contributions to scores."""

    def __init__(self, ids: pa.Table, postings: pa.Table, weights: np.ndarray, documents: int, total: int) -> None:
        self.ids = ids.column("id").combine_chunks()
        term, self.doc, tf = (postings.column(c).to_numpy() for c in ("term", "doc", "tf"))
        m = length_term(ids.column("n").to_numpy(), documents, total)
        tf = tf.astype(np.int64)
        self.adds = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc]))
        self.at = np.searchsorted(term, np.arange(len(weights) + 1))
        here = np.flatnonzero(np.diff(self.at))
        self.bound = np.zeros(len(weights), np.int64)
        if len(here):
            self.bound[here] = np.maximum.reduceat(self.adds, self.at[here])

    def search(self, terms: np.ndarray, threshold: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that reach ``threshold`` (1 at least), all that may be among the best ``k``."""
        terms = terms[self.bound[terms] > 0]
        terms = terms[np.argsort(self.bound[terms], kind="stable")]
        upto = np.cumsum(self.bound[terms])
        threshold = max(threshold, 1)
        essential = int(np.searchsorted(upto, threshold))
        if essential == len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        score = np.zeros(len(self.ids), np.int64)
        for t in terms[essential:].tolist():
            lo, hi = self.at[t], self.at[t + 1]
            score[self.doc[lo:hi]] += self.adds[lo:hi]
        docs = np.flatnonzero(score)
        for i in range(essential - 1, -1, -1):
            if len(docs) > k:
                # What k documents have already is a threshold, too.
                threshold = max(threshold, int(np.partition(score[docs], len(docs) - k)[len(docs) - k]))
            docs = docs[score[docs] + upto[i] >= threshold]
            lo, hi = self.at[terms[i]], self.at[terms[i] + 1]
            if len(docs) * 16 < hi - lo:
                place = np.minimum(np.searchsorted(self.doc[lo:hi], docs), hi - lo - 1) + lo
                has = self.doc[place] == docs
                score[docs[has]] += self.adds[place[has]]
            else:
                own = np.zeros(len(self.ids), np.int64)
                own[self.doc[lo:hi]] = self.adds[lo:hi]
                score[docs] += own[docs]
        docs = docs[score[docs] >= threshold]
        return docs, score[docs]


class Numbers(NamedTuple):
    """What all shards search with: queries, weights of terms, documents, all terms, thresholds of queries."""

    queries: Queries
    weights: np.ndarray
    documents: int
    total: int
    thresholds: np.ndarray


def _best(ids: pa.Array, scores: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
    """The first k by falling score, then id, null first."""
    order = pc.sort_indices(pa.table({"score": scores, "id": ids}), sort_keys=[("score", "descending"), ("id", "ascending")], null_placement="at_start")[:k]
    return ids.take(order), scores[order.to_numpy()]


def _search(shared, k: int):
    """(query, doc_id, score): the best of the shards of a task for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Numbers = shared.value
        best: dict[int, tuple[pa.Array, np.ndarray]] = {}
        thresholds = x.thresholds.copy()
        id_type = None
        for batch in batches:
            for ids, postings in zip(batch.column("ids"), batch.column("postings"), strict=True):
                ids = pa.ipc.open_stream(ids.as_buffer()).read_all()
                id_type = ids.column("id").type
                shard = Shard(ids, pa.ipc.open_stream(postings.as_buffer()).read_all().combine_chunks(), x.weights, x.documents, x.total)
                for q, terms in enumerate(x.queries.terms):
                    docs, scores = shard.search(terms, int(thresholds[q]), k)
                    if not len(docs):
                        continue
                    found = shard.ids.take(pa.array(docs))
                    if q in best:
                        found, scores = pa.concat_arrays([best[q][0], found]), np.concatenate([best[q][1], scores])
                    best[q] = _best(found, scores, k)
                    if len(best[q][1]) == k:
                        thresholds[q] = max(thresholds[q], int(best[q][1][-1]))
        for lo in range(0, len(best), 256):
            some = list(best.items())[lo : lo + 256]
            query = np.repeat([q for q, _ in some], [len(s) for _, (_, s) in some]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.concat_arrays([i.cast(id_type) for _, (i, _) in some]), pa.array(np.concatenate([s for _, (_, s) in some]))], ["query", "doc_id", "score"])
        kernels.release()

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` of a block of queries."""
    spark = docs.sparkSession
    context = spark.sparkContext
    id_type = docs.schema["doc_id"].dataType.simpleString()
    queries = queries_of([r["texts"] for r in items])
    index = cut_lineage(docs.mapInArrow(_index(context.broadcast(queries)), INDEX))
    sums = index.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(len(queries.hashes), np.int64)
    # One row for each term of the block's queries, whose size is bounded.
    for row in index.select(F.inline("df")).groupBy("term").agg(F.sum("docs").alias("docs")).toLocalIterator():
        weights[row["term"]] = weight(sums["documents"], row["docs"])
    numbers = Numbers(queries, weights, int(sums["documents"]), int(sums["terms"]), np.zeros(len(items), np.int64))
    found = lambda index, numbers: index.select("ids", "postings").mapInArrow(_search(context.broadcast(numbers), k), f"query int, doc_id {id_type}, score bigint")
    seed = _ranked(found(index.filter(F.pmod(F.xxhash64("shard"), F.lit(SEED)) == 0), numbers), k).filter(F.col("rank") == k).select("query", "score")
    for row in seed.collect():
        numbers.thresholds[row["query"]] = row["score"]
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], f"query int, item_id {_id_type(items)}")
    return _ranked(found(index, numbers), k).join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _id_type(items: list) -> str:
    return "string" if any(isinstance(r["item_id"], str) for r in items) else "bigint"


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents for each benchmark item, by falling score, then id.

    A null or empty text has no terms; a document or item without terms is in no
    result, nor is one that scores 0.  Texts of any length are read whole.  Rows
    of one item are one query with the terms of all its texts; a null item is a
    query, too.  Repeated documents each are ranked, those without an id before
    others of their score.  An empty table gives no rows; further columns are
    not used.
    """
    prepare(docs.sparkSession)
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    asked = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / query_bytes))
    number = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = None
    for b in range(blocks):
        items = asked.filter(number == b).groupBy("item_id").agg(F.sort_array(F.collect_set("text")).alias("texts")).orderBy("item_id").collect()
        part = _search_block(own, items, k)
        part = part.withColumn("item_id", F.col("item_id").cast(benchmark.schema["item_id"].dataType))
        out = part if out is None else out.unionByName(part)
    return out


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), " + _LOWER + "), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
WITH w AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
d AS (SELECT doc_id, sum(tf) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS n, sum(n) AS l FROM d),
m AS (SELECT doc_id, 100 - 50 + (50::HUGEINT * d.n * s.n) // s.l AS m FROM d, s),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
f AS (SELECT term, floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w FROM t SEMI JOIN q USING (term), s GROUP BY term, s.n),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000::HUGEINT * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM q JOIN f USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {TOP}
"""
