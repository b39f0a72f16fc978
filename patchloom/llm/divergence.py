"""Audit of how the sources of a language differ in their words, by a heavy-light split.

Each language keeps the terms of at least ``LEAST_DOCS`` of its documents.  A
group (language, source) gives a kept term, with ``count`` occurrences there and
N of all kept terms, p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)), so that a
term it lacks has the group's least p, p0.  Two groups differ in a term by
f(p, q) = floor((p - q) ** 2 / (p + q)).

1. Chunks of documents count their terms by group and ship them to the part of
   (language, term), which keeps or drops the term and knows all its groups.
2. For every pair of groups, f is summed over the language's kept terms:
   V * f(p0, q0), as if all terms were lacking in both, and what the terms that
   are there change.  Heavy terms, those of at least a ``1 / LIGHT``-th of the
   groups, are dense tiles, terms by groups, compared column by column.  Light
   terms are postings: what a posting changes against all groups that lack the
   term is computed once for equal (group, p), and each pair of postings of one
   term corrects the pair of groups it stands for.  Both sums are of whole
   numbers and add up exactly.  Tiles are cells of ``TILE_TERMS`` terms and two
   blocks of ``BLOCK_GROUPS`` groups, each a task's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.llm import blobs, kernels
from patchloom.llm.session import cut_lineage, prepare

U64 = np.uint64
LEAST_DOCS = 10
SCALE = 10**9
TOP_TERMS = 10
LIGHT = 4
TILE_TERMS = 1024
BLOCK_GROUPS = 128
CHUNK_BYTES = 8 << 20

#: Bytes of terms: letters, A-Z lower-cased, and all beyond ASCII; anything else separates.
TERM_BYTES = np.zeros(256, np.uint8)
for _b in [*range(0x61, 0x7B), *range(0x80, 0x100)]:
    TERM_BYTES[_b] = _b
TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)

POSTINGS = "lang string, source string, term string, count bigint, total bigint, held_by bigint, lead boolean"
_OPTIONS = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))


def _chunk_counts(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.Table:
    """(lang, source, term, count, docs) of a chunk and the hash of (lang, term)."""
    groups = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
    by_lang, by_source = lang.dictionary_encode(), source.dictionary_encode()
    group_of = np.array(by_lang.indices).astype(np.int64) * max(len(by_source.dictionary), 1) + np.array(by_source.indices)
    group, first, group_of = np.unique(group_of, return_index=True, return_inverse=True)
    data, offsets = kernels.text_buffer(texts)
    norm = TERM_BYTES[data]
    starts, ends, word_at = kernels.word_spans(norm, offsets)
    hashes, where, word = np.unique(kernels.word_hashes(norm, starts, ends), return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(texts)), np.diff(word_at))
    in_doc, times = np.unique(row * max(len(hashes), 1) + word, return_counts=True)
    doc, word = in_doc // max(len(hashes), 1), in_doc % max(len(hashes), 1)
    pair, place = np.unique(word * max(len(group), 1) + group_of[doc], return_inverse=True)
    count, docs = np.bincount(place, times, len(pair)).astype(np.int64), np.bincount(place, minlength=len(pair))
    word, own = pair // max(len(group), 1), first[pair % max(len(group), 1)]
    at, end = starts[where], ends[where]
    size = end - at
    # The bytes of the distinct terms, one after the other.
    step = np.repeat(at - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
    terms = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(norm[step]))])
    picked = groups.take(pa.array(own))
    lang_hash = kernels.mix(np.array([hash_of(x) for x in by_lang.dictionary.to_pylist()], np.uint64))
    key = kernels.mix(hashes[word] + lang_hash[np.array(by_lang.indices)[own]])
    return pa.table({"key": key.view(np.int64), "lang": picked.field("lang"), "source": picked.field("source"), "term": terms.take(pa.array(word)), "count": count, "docs": docs})


def hash_of(text: str) -> int:
    """A 64-bit hash of a short text that is the same in all workers."""
    out = 0xCBF29CE484222325
    for b in text.encode():
        out = (out ^ b) * 0x100000001B3 % 2**64
    return out


def _sealed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_OPTIONS) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _count(parts: int):
    """(part, kind, data): the counts of chunks, dealt by language and term."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        counts = _chunk_counts(*(c.combine_chunks() for c in table.columns))
        part = blobs.part_of(counts.column("key").to_numpy().view(np.uint64), parts)
        order = np.argsort(part, kind="stable")
        counts, part = counts.drop_columns(["key"]).take(pa.array(order)), part[order]
        for name in ("lang", "source"):
            counts = counts.set_column(counts.schema.get_field_index(name), name, counts.column(name).combine_chunks().dictionary_encode())
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else [0]
        rows = [(int(part[lo]), 0, _sealed(counts.slice(lo, hi - lo))) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        return blobs.batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            _, offsets = kernels.text_buffer(batch.column(2))
            for lo, hi in kernels.doc_chunks(offsets, CHUNK_BYTES):
                held.append(batch.slice(lo, hi - lo))
                size += int(offsets[hi] - offsets[lo])
                if size >= CHUNK_BYTES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
        kernels.release()

    return run


def _keep(least_docs: int):
    """The postings of the kept terms of a part; each term's total and number of groups, and one posting that leads."""

    def run(got: dict[int, list[bytes]]) -> pa.Table:
        sealed = [pa.ipc.open_stream(b).read_all() for b in got[0]]
        plain = [t.set_column(0, "lang", pc.cast(t.column("lang"), pa.string())).set_column(1, "source", pc.cast(t.column("source"), pa.string())) for t in sealed]
        groups = pa.concat_tables(plain).group_by(["lang", "source", "term"]).aggregate([("count", "sum"), ("docs", "sum")])
        terms = groups.group_by(["lang", "term"]).aggregate([("count_sum", "sum"), ("docs_sum", "sum"), ("source", "count"), ("source", "min")])
        terms = terms.filter(pc.greater_equal(terms.column("docs_sum_sum"), least_docs))
        out = groups.join(terms, ["lang", "term"], join_type="inner")
        lead = pc.equal(out.column("source"), out.column("source_min"))
        return pa.table([out.column("lang"), out.column("source"), pc.cast(out.column("term"), pa.large_string()).cast(pa.string()), out.column("count_sum"), out.column("count_sum_sum"), out.column("source_count"), lead], ["lang", "source", "term", "count", "total", "held_by", "lead"])

    return run


def kept_postings(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``POSTINGS``: each group's count of each term kept by its language; null columns are ''."""
    spark = prepare(docs.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = docs.select(text("lang").alias("lang"), text("source").alias("source"), F.col("text").cast("string").alias("text"))
    counted = own.mapInArrow(_count(blobs.part_count(spark)), blobs.SCHEMA)
    return cut_lineage(blobs.by_part(counted, _keep(least_docs), POSTINGS))


def _share(count: Column, size: Column, terms: Column) -> Column:
    """p of a count among ``size`` occurrences of ``terms`` terms, exactly."""
    wide = "decimal(38,0)"
    return (F.expr("1") + F.call_function("div", (count + 2).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (size + 2 * terms).cast("decimal(27,0)"))).cast("bigint")


def _differ(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _cell(table: pa.Table) -> pa.Table:
    """What the terms of a cell add to the sums of its pairs of groups (``a`` of the first block, ``b`` of the second, a < b)."""
    t = {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in table.column_names if c not in ("lang", "term")}
    group = t["kind"] == 0
    x, y = int(t["x"][0]), int(t["y"][0])
    none = np.ones(2 * BLOCK_GROUPS, np.int64)
    # Places 0.. are the first block's groups, BLOCK_GROUPS.. the second's; the same block stands in both.
    side = lambda at, gid, block, base: (at[gid // BLOCK_GROUPS == block], gid[gid // BLOCK_GROUPS == block] % BLOCK_GROUPS + base)
    here = np.zeros(2 * BLOCK_GROUPS, bool)
    at_group = np.flatnonzero(group)
    for block, base in ((x, 0), (y, BLOCK_GROUPS)):
        at, place = side(at_group, t["gid"][at_group], block, base)
        none[place], here[place] = t["p"][at], True
    pa0, pb0 = none[:BLOCK_GROUPS], none[BLOCK_GROUPS:]
    ground = _f(pa0[:, None], pb0[None, :])
    out = np.zeros((BLOCK_GROUPS, BLOCK_GROUPS), np.int64)
    if t["first"][0]:
        out += int(t["terms"][0]) * ground
    at = np.flatnonzero(~group)
    if len(at):
        codes = np.array(table.column("term").combine_chunks().take(pa.array(at)).dictionary_encode().indices).astype(np.int64)
        both = [(*side(at, t["gid"][at], block, base), base) for block, base in ((x, 0), (y, BLOCK_GROUPS))]
        code_of = np.zeros(len(t["kind"]), np.int64)
        code_of[at] = codes
        row = np.concatenate([b[0] for b in both])
        place = np.concatenate([b[1] for b in both])
        code, p, heavy = code_of[row], t["p"][row], t["heavy"][row].astype(bool)
        out += _heavy(code[heavy], place[heavy], p[heavy], none, ground)
        out += _light(code[~heavy], place[~heavy], p[~heavy], none, ground)
    a, b = np.nonzero(here[:BLOCK_GROUPS, None] & here[None, BLOCK_GROUPS:] & ((x < y) | (np.arange(BLOCK_GROUPS)[:, None] < np.arange(BLOCK_GROUPS)[None, :])))
    a, b = a[(out[a, b] != 0) | bool(t["first"][0])], b[(out[a, b] != 0) | bool(t["first"][0])]
    return pa.table([table.column("lang").slice(0, 1).take(pa.array(np.zeros(len(a), np.int64))), pa.array(a + x * BLOCK_GROUPS), pa.array(b + y * BLOCK_GROUPS), pa.array(out[a, b])], ["lang", "a", "b", "value"])


def _heavy(code: np.ndarray, place: np.ndarray, p: np.ndarray, none: np.ndarray, ground: np.ndarray) -> np.ndarray:
    """Dense: every heavy term's p in every group of the two blocks, column against columns."""
    out = np.zeros_like(ground)
    terms, code = np.unique(code, return_inverse=True)
    if not len(terms):
        return out
    tile = np.repeat(none[:, None], len(terms), 1)
    tile[place, code] = p
    second = tile[BLOCK_GROUPS:]
    live = np.flatnonzero((second != none[BLOCK_GROUPS:, None]).any(1) | (none[BLOCK_GROUPS:] > 1))
    for a in np.flatnonzero((tile[:BLOCK_GROUPS] != none[:BLOCK_GROUPS, None]).any(1) | (none[:BLOCK_GROUPS] > 1)).tolist():
        out[a, live] = _f(tile[a][None, :], second[live]).sum(1) - len(terms) * ground[a, live]
    return out


def _light(code: np.ndarray, place: np.ndarray, p: np.ndarray, none: np.ndarray, ground: np.ndarray) -> np.ndarray:
    """Sparse: each posting against the groups that lack its term, then the pairs of postings of one term."""
    out = np.zeros_like(ground)
    if not len(code):
        return out
    kinds, times = np.unique(np.stack([place, p]), axis=1, return_counts=True)
    for g, v, n in zip(*kinds.tolist(), times.tolist(), strict=True):
        if g < BLOCK_GROUPS:
            out[g] += n * (_f(np.int64(v), none[BLOCK_GROUPS:]) - ground[g])
        else:
            out[:, g - BLOCK_GROUPS] += n * (_f(none[:BLOCK_GROUPS], np.int64(v)) - ground[:, g - BLOCK_GROUPS])
    order = np.lexsort((place, code))
    code, place, p = code[order], place[order], p[order]
    split = np.searchsorted(code * 2 * BLOCK_GROUPS + place, np.unique(code) * 2 * BLOCK_GROUPS + BLOCK_GROUPS)
    end = np.append(blobs.runs(code)[1:], len(code))
    # First-block posting i of a term meets its second-block postings, one more of them at a time.
    term = np.repeat(np.arange(len(end)), np.diff(np.append(0, end)))
    mine = np.flatnonzero(place < BLOCK_GROUPS)
    other, last = split[term[mine]], end[term[mine]]
    while len(mine := mine[keep := other < last]):
        other, last = other[keep], last[keep]
        g, h = place[mine], place[other] - BLOCK_GROUPS
        fix = _f(p[mine], p[other]) - _f(p[mine], none[place[other]]) - _f(none[g], p[other]) + ground[g, h]
        np.add.at(out, (g, h), fix)
        other = other + 1
    return out


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each group differs from the others, and by which terms.

    Part ``pair`` has a row for each other source of the language, its value
    summed over all kept terms; part ``term`` the terms a group has more of than
    its language, the first ``top`` by value.  Ties are ranked by the item's
    bytes.  A null language, source or text is ''; groups without terms, or of a
    language that keeps none, have pairs of what formulas give (0 without kept
    terms); a language with one source has no pairs.  Long texts are counted
    whole, repeated rows each count, further columns are not used, and an empty
    table gives no rows.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    postings = kept_postings(docs, least_docs)
    sizes = postings.groupBy("lang", "source").agg(F.sum("count").alias("size"))
    kept = postings.filter("lead").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    by_lang = Window.partitionBy("lang")
    groups = docs.select(text("lang"), text("source")).distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["size", "terms", "lang_size"])
    groups = groups.withColumn("gid", F.row_number().over(by_lang.orderBy("source")) - 1).withColumn("groups", F.count("*").over(by_lang))
    groups = cut_lineage(groups.withColumn("p0", F.when(F.col("terms") > 0, _share(F.lit(0), F.col("size"), F.greatest("terms", F.lit(1)))).otherwise(1)))
    placed = postings.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("size"), F.col("terms")))

    tiles = F.greatest(F.ceil(F.col("terms") / TILE_TERMS), F.lit(1)).cast("int")
    blocks = F.ceil(F.col("groups") / BLOCK_GROUPS).cast("int")
    own = F.floor(F.col("gid") / BLOCK_GROUPS).cast("int")
    cells = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    place = ["lang", "tile", "x", "y"]
    rows = [*place, "kind", "gid", "p", "heavy", "terms", "first", "term"]
    ground = groups.filter("groups > 1").withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1))).select("*", F.inline(cells))
    ground = ground.withColumns({"kind": F.lit(0), "p": F.col("p0"), "heavy": F.lit(False), "first": F.col("tile") == 0, "term": F.lit("")})
    there = placed.filter("groups > 1").withColumn("tile", F.pmod(F.xxhash64("term"), tiles).cast("int")).select("*", F.inline(cells))
    there = there.withColumns({"kind": F.lit(1), "heavy": F.col("held_by") * LIGHT >= F.col("groups"), "first": F.col("tile") == 0})
    sums = ground.select(*rows).unionByName(there.select(*rows)).groupBy(*place).applyInArrow(_cell, "lang string, a bigint, b bigint, value bigint")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("gid"), F.col("b").alias("other")), F.struct(F.col("b").alias("gid"), F.col("a").alias("other")))).alias("x"), "value").select("lang", "x.*", "value")
    names = groups.select("lang", F.col("gid").cast("bigint").alias("gid"), "source")
    pairs = both.join(names, ["lang", "gid"]).join(names.select("lang", F.col("gid").alias("other"), F.col("source").alias("item")), ["lang", "other"])

    in_lang = placed.withColumn("q", _share(F.col("total"), F.col("lang_size"), F.col("terms"))).filter("p > q")
    terms = in_lang.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _differ(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= top))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), {_LOWER}) AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c, (1 + ({SCALE}::HUGEINT * (coalesce(c.c, 0) + 2)) // (s.n + 2 * v.v))::HUGEINT AS p, (1 + ({SCALE}::HUGEINT * (k.total + 2)) // (v.n + 2 * v.v))::HUGEINT AS q
  FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
x AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q
),
n AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM n WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
