"""N-gram Jaccard join by count vectors: documents that share 80 % of their word shingles.

1. A document's shingle hashes are sorted; the hash range is cut into groups,
   more of them than two linked documents of its size class can differ in.
   So linked documents have a group with the same tokens, and every group
   becomes a block key (``signatures``).  Documents whose tokens leave too many
   groups empty for that argument also use their least tokens as keys, of which
   linked documents share one.
2. In a block, the least document is compared to the others; components follow.
3. Blocks that still hold several components are grouped by which they hold.
   A group's documents, by their group counts, are points of an R-tree, and
   those outside its largest component are searched in it.  The summed
   coordinate minima of a point and a node's upper corner bound the overlap with
   anything below the node; subtrees under the bound, or of the point's own
   component, are left out.
4. Surviving pairs are verified on the token sets.

Exact copies meet by a digest of the set and take no part in 2 to 4 beyond one
of each run of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm import blobs, kernels
from patchloom.llm.id_filter import IdFilter
from patchloom.llm.components import connected_components
from patchloom.llm.session import cut_lineage, prepare

U64 = np.uint64
SHINGLE = 5
#: A link: NUM * union <= DEN * intersection, that is 80 of 100.
NUM, DEN = 4, 5
SMALL = 32
TEXT_BYTES = 2 << 20
RUN_BYTES = 16 << 20
#: A point has 2 ** LEAST_BITS to 2 ** MOST_BITS groups, in the R-tree at most 2 ** TREE_BITS.
LEAST_BITS, TREE_BITS, MOST_BITS = 6, 10, 15
LEAF = 16
CELL = 2048
ASKED_AT_ONCE = 256

#: Bytes of words after lower-casing A-Z; space and 0x09-0x0D separate.  Byte 0 is a word's, too.
WORD_BYTES = np.arange(256, dtype=np.uint16)
WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
WORD_BYTES[0] = 0x41
WORD_BYTES = WORD_BYTES.astype(np.uint8)
for _b in [0x20, *range(0x09, 0x0E)]:
    WORD_BYTES[_b] = 0

#: Block keys travel with 48 bits: the 24 that choose the part and 24 more.
SIGNED = np.dtype([("high", "<u4"), ("low", "<u2"), ("doc", "<i8")])
DOC = np.dtype([("s1", "<u8"), ("s2", "<u8"), ("doc", "<i8"), ("n", "<i8")])
COPY = np.dtype([("doc", "<i8"), ("first", "<i8"), ("n", "<i8")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a text buffer."""
    for lo, hi in kernels.doc_chunks(offsets, TEXT_BYTES):
        norm = WORD_BYTES[data[offsets[lo] : offsets[hi]]]
        starts, ends, word_at = kernels.word_spans(norm, offsets[lo : hi + 1] - offsets[lo])
        words = kernels.word_hashes(norm, starts, ends)
        windows = kernels.window_hashes(words, SHINGLE)
        for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                some = np.sort(windows[a : b - SHINGLE + 1])
                yield some[np.concatenate([[True], some[1:] != some[:-1]])]
            elif b > a:
                yield kernels.window_hashes(words[a:b], b - a) ^ U64(b - a)
            else:
                yield np.empty(0, np.uint64)


def least_overlap(total):
    """The least intersection of linked sets whose sizes sum to ``total``."""
    return -(-NUM * total // (NUM + DEN))


def size_classes(largest: int) -> list[int]:
    """Upper sizes; a partner is in the same class or the next."""
    out = [SMALL]
    while out[-1] < largest:
        out.append(out[-1] * DEN // NUM)
    return out


def group_count(upper: int) -> int:
    """More groups than linked sets of a class can differ in, with room for empty groups."""
    differ = (upper + upper * DEN // NUM) // (NUM + DEN)
    empty = (differ + 1) * np.exp(-upper / (differ + 1))
    return differ + 2 + int(np.ceil(empty + 3 * np.sqrt(empty)))


class Schemes:
    def __init__(self) -> None:
        self.upper = size_classes(1 << 10)
        self.groups = [group_count(u) for u in self.upper]

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """Block keys of a set."""
        n, out = len(tokens), []
        if n > self.upper[-1]:
            self.upper = size_classes(n)
            self.groups = [group_count(u) for u in self.upper]
        prefix = n <= SMALL * DEN // NUM
        k = int(np.searchsorted(self.upper, n))
        for scheme in (k, k - 1) if n > SMALL else ():
            if scheme < 1:
                continue
            groups = self.groups[scheme]
            group = ((tokens >> U64(32)) * U64(groups)) >> U64(32)
            first = blobs.runs(group)
            content = np.add.reduceat(tokens, first)
            out.append(kernels.mix(content + group[first] * U64(0x9FB21C651E98DF25) + U64((groups + 1) * 0xC3A5C85C97CB3127 % 2**64)))
            other = min(n * DEN // NUM, self.upper[scheme] * DEN // NUM) if scheme == k else self.upper[scheme]
            prefix |= len(first) <= (n + other) // (NUM + DEN)
        if prefix:
            out.append(kernels.mix(tokens[: n - -(-NUM * n // DEN) + 1] ^ U64(0xA0761D6478BD642F)))
        return np.concatenate(out)


def _sign(parts: int):
    def flush(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        if held["copies"]:
            copies = np.array(held["copies"], COPY)
            rows += blobs.deal(2, kernels.mix(copies["doc"].astype(np.uint64)), copies, parts)
        if held["docs"]:
            docs = np.array(held["docs"], DOC)
            rows += blobs.deal(1, docs["s1"], docs, parts)
        if held["sigs"]:
            signed = np.empty(sum(map(len, held["sigs"])), SIGNED)
            sig = np.concatenate(held["sigs"])
            signed["high"], signed["low"] = sig >> U64(32), (sig >> U64(16)) & U64(0xFFFF)
            signed["doc"] = np.repeat(np.array(held["ids"], np.int64), [len(s) for s in held["sigs"]])
            rows += blobs.deal(0, sig, signed, parts)
        for x in held.values():
            x.clear()
        for lo in range(0, len(rows), 256):
            yield blobs.batch(rows[lo : lo + 256])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes, seen, size = Schemes(), {}, 0
        held: dict[str, list] = {"docs": [], "copies": [], "sigs": [], "ids": []}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = kernels.text_buffer(batch.column(1))
            length = np.diff(offsets).tolist()
            for doc, bytes_, tokens in zip(ids, length, shingle_sets(data, offsets), strict=True):
                s1, s2 = int(tokens.sum()), int((tokens * tokens).sum())
                if len(tokens) == 0:
                    s1 = int(kernels.mix(np.array([doc], np.int64).view(np.uint64))[0])
                    held["copies"].append((doc, doc, 0))
                elif (s1, s2) in seen:
                    held["copies"].append((doc, seen[s1, s2], len(tokens)))
                else:
                    seen[s1, s2] = doc
                    held["docs"].append((s1, s2, doc, len(tokens)))
                    held["sigs"].append(schemes.signatures(tokens))
                    held["ids"].append(doc)
                size += bytes_
                if size >= RUN_BYTES:
                    size = 0
                    seen.clear()
                    yield from flush(held)
        yield from flush(held)
        del seen, held
        kernels.release()

    return run


#: kind 0: a document, its set's size and a copy of it; 1: a pair to verify; 2: a block of more than two and its member.
MET = "kind int, a bigint, b bigint, n bigint"


def _meet(got: dict[int, list[bytes]]) -> pa.Table:
    none = np.empty(0, np.int64)
    out: list[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]] = [(0, none, none, none)]
    if 2 in got:
        copies = blobs.unpack(got[2], COPY)
        out.append((0, copies["doc"], copies["first"], copies["n"]))
    if 1 in got:
        docs = blobs.unpack(got[1], DOC)
        docs = docs[np.lexsort((docs["doc"], docs["s2"], docs["s1"]))]
        first = blobs.runs(docs["s1"], docs["s2"])
        least = np.repeat(docs["doc"][first], np.diff([*first, len(docs)]))
        out.append((0, docs["doc"], least, docs["n"]))
    if 0 in got:
        signed = blobs.unpack(got[0], SIGNED)
        sig, doc = signed["high"].astype(np.uint64) << U64(16) | signed["low"], signed["doc"].copy()
        del signed
        order = np.lexsort((doc, sig))
        sig, doc = sig[order], doc[order]
        del order
        fresh = blobs.runs(sig, doc)
        sig, doc = sig[fresh], doc[fresh]
        first = blobs.runs(sig)
        count = np.diff([*first, len(sig)])
        several = np.repeat(count > 1, count)
        sig, doc = sig[several], doc[several]
        if len(sig):
            first = blobs.runs(sig)
            count = np.diff([*first, len(sig)])
            same = np.add.reduceat(kernels.mix(doc.astype(np.uint64) + U64(1)), first)
            _, once = np.unique(same, return_index=True)
            keep = np.zeros(len(first), bool)
            keep[once] = True
            least = np.repeat(doc[first], count)[np.repeat(keep, count)]
            sig, doc = sig[np.repeat(keep, count)], doc[np.repeat(keep, count)]
            pairs = np.unique(np.stack([least, doc], 1)[least != doc], axis=0)
            out.append((1, pairs[:, 0], pairs[:, 1], None))
            more = np.repeat(count[keep] > 2, count[keep])
            out.append((2, sig[more].view(np.int64), doc[more], None))
    columns = [np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in out]), np.concatenate([x[1] for x in out]), np.concatenate([x[2] for x in out]), np.concatenate([np.zeros(len(x[1]), np.int64) if x[3] is None else x[3] for x in out])]
    return pa.table([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["kind", "a", "b", "n"])


def point(tokens: np.ndarray) -> bytes:
    """Group counts of a set, with about as many groups as tokens: log2 of the groups, a count's bytes, counts."""
    bits = int(np.clip(max(1, len(tokens) - 1).bit_length(), LEAST_BITS, MOST_BITS))
    counts = np.bincount((tokens >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    width = 1 if counts.max() < 256 else 4
    return bytes([bits, width]) + counts.astype(f"<u{width}").tobytes()


def counts_of(raw: bytes, bits: int | None = None) -> np.ndarray:
    """The counts of a point; with ``bits``, neighbouring groups are added until it has as few groups."""
    counts = np.frombuffer(raw, f"<u{raw[1]}", offset=2).astype(np.int64)
    return counts if bits is None else counts.reshape(1 << bits, -1).sum(1)


def coarse(raw: bytes) -> bytes:
    """A point with at most 2 ** TREE_BITS groups."""
    if raw[0] <= TREE_BITS:
        return raw
    counts = counts_of(raw, TREE_BITS)
    width = 1 if counts.max() < 256 else 4
    return bytes([TREE_BITS, width]) + counts.astype(f"<u{width}").tobytes()


@F.pandas_udf(T.BinaryType())
def _coarse(raw: pd.Series) -> pd.Series:
    return raw.map(coarse)


def overlap_bound(a: bytes, b: bytes) -> int:
    """The summed coordinate minima of two points, which no intersection exceeds."""
    bits = min(a[0], b[0])
    return int(np.minimum(counts_of(a, bits), counts_of(b, bits)).sum())


def _points(tokens: np.ndarray) -> bytes:
    return point(tokens)


def _tokens(tokens: np.ndarray) -> bytes:
    return tokens.tobytes()


def _derive(value, some: IdFilter | None, centres: IdFilter | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if some is not None:
                batch = some.keep(batch)
            data, offsets = kernels.text_buffer(batch.column(1))
            for lo, hi in kernels.doc_chunks(offsets, TEXT_BYTES):
                sets = list(shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                ids = batch.column(0).slice(lo, hi - lo)
                centre = np.zeros(hi - lo, bool) if centres is None else centres.may_hold(ids.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in sets], pa.int64()), pa.array(centre), pa.array([value(t) for t in sets], pa.binary())], ["doc", "n", "centre", "value"])
        kernels.release()

    return run


DERIVED = "doc bigint, n bigint, centre boolean, value binary"


def _of_pairs_documents(docs: DataFrame, pairs: DataFrame, value, also: DataFrame | None = None) -> DataFrame:
    """``(doc, n, centre, value)`` of the documents in ``pairs`` and ``also``, and perhaps of others; centres may be an ``a``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc"))
    ids = (ids if also is None else ids.union(also)).distinct()
    some, centres = IdFilter.of(ids), IdFilter.of(pairs.select(F.col("a").alias("doc")).distinct())
    return docs.mapInArrow(_derive(value, some, centres), DERIVED)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted token sets meet the threshold."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return DEN * both >= NUM * (len(a) + len(b) - both)


def _passing(test):
    """The pairs of a batch whose values pass ``test``, read where Arrow holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(), strict=True)
            keep = [test(a.as_buffer(), b.as_buffer(), x, y) for a, b, (x, y) in zip(batch.column("value_a"), batch.column("value_b"), total, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        kernels.release()

    return run


def _bounded(a: pa.Buffer, b: pa.Buffer, n_a: int, n_b: int) -> bool:
    """Whether the points of two sets of these sizes leave room for a link."""
    return min(n_a, n_b) > 0 and overlap_bound(a, b) >= least_overlap(n_a + n_b)


def _verify(a: pa.Buffer, b: pa.Buffer, n_a: int, n_b: int) -> bool:
    return min(n_a, n_b) > 0 and linked(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"))


def _of_pairs(pairs: DataFrame, values: DataFrame, test, only_centres: bool = True) -> DataFrame:
    """The pairs ``(a, b)`` that pass a test on both documents' values."""
    one = {s: values.filter("centre" if s == "a" and only_centres else "true").select(F.col("doc").alias(s), F.col("n").alias(f"n_{s}"), F.col("value").alias(f"value_{s}")) for s in "ab"}
    return pairs.join(one["b"], "b").join(one["a"], "a").mapInArrow(_passing(test), "a bigint, b bigint")


def _links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked ones of ``pairs``, by their token sets."""
    sets = cut_lineage(_of_pairs_documents(docs, pairs, _tokens))
    return cut_lineage(_of_pairs(pairs, sets, _verify))


class RTree:
    """Points packed by recursive halving of the widest coordinate; a node keeps its upper corner."""

    def __init__(self, points: np.ndarray, label: np.ndarray, rows: np.ndarray | None = None) -> None:
        self.rows = np.arange(len(points)) if rows is None else rows
        own = points[self.rows]
        self.high, sizes = own.max(0), own.sum(1, dtype=np.int64)
        self.least, self.most = int(sizes.min()), int(sizes.max())
        one = label[self.rows]
        self.label = int(one[0]) if (one == one[0]).all() else None
        self.below: list[RTree] = []
        if len(self.rows) > LEAF:
            order = np.argsort(own[:, int(np.argmax(np.ptp(own, axis=0)))], kind="stable")
            half = len(order) // 2
            del own
            self.below = [RTree(points, label, self.rows[order[:half]]), RTree(points, label, self.rows[order[half:]])]

    def search(self, points: np.ndarray, label: np.ndarray, asked: np.ndarray, tag: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row of ``asked``, row of ``points``) of different labels whose bound allows a link."""
        yield from self._search(points, label, asked, tag, asked.sum(1, dtype=np.int64), np.arange(len(asked)))

    def _search(self, points, label, asked, tag, size, rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        own = size[rows]
        keep = (NUM * own <= DEN * self.most) & (NUM * self.least <= DEN * own)
        if self.label is not None:
            keep &= tag[rows] != self.label
        rows, own = rows[keep], own[keep]
        if len(rows) == 0:
            return
        bound = np.minimum(asked[rows], self.high).sum(1, dtype=np.int64)
        rows = rows[bound >= least_overlap(own + self.least)]
        if len(rows) == 0:
            return
        if self.below:
            for node in self.below:
                yield from node._search(points, label, asked, tag, size, rows)
            return
        for row in self.rows.tolist():
            other = rows[tag[rows] != label[row]]
            bound = np.minimum(asked[other], points[row]).sum(1, dtype=np.int64)
            near = other[bound >= least_overlap(size[other] + int(points[row].sum(dtype=np.int64)))]
            yield near, np.full(len(near), row)


def _dense(raw: list[bytes]) -> np.ndarray:
    """Points as rows of small counts, all with as few groups as the coarsest has."""
    bits = min(p[0] for p in raw)
    wide = any(p[1] > 1 for p in raw) or bits < max(p[0] for p in raw)
    out = np.empty((len(raw), 1 << bits), np.uint32 if wide else np.uint8)
    for i, p in enumerate(raw):
        out[i] = counts_of(p, bits) if wide else np.frombuffer(p, np.uint8, offset=2)
    return out


def _tree_pairs(table: pa.Table) -> pa.Table:
    """Pairs of different components whose coarse bound allows a link, of all cells dealt to a part.

    A cell has points, of which its R-tree is built, and asked points, which are
    searched in it; ``asked`` tells them apart.
    """
    order = np.lexsort(tuple(table.column(c).to_numpy() for c in ("doc", "asked", "y", "x", "group")))
    keys = [table.column(c).to_numpy()[order] for c in ("group", "x", "y")]
    doc, label, asked = (table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("doc", "component", "asked"))
    value = table.column("value").combine_chunks()
    cuts = np.append(blobs.runs(*keys), len(order))
    found = [np.empty((0, 2), np.int64)]
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        middle = lo + int(np.searchsorted(asked[lo:hi], True))
        if middle in (lo, hi):
            continue
        every = _dense([value[i].as_buffer().to_pybytes() for i in order[lo:hi].tolist()])
        own, others = every[: middle - lo], every[middle - lo :]
        tree = RTree(own, label[lo:middle])
        for first in range(0, hi - middle, ASKED_AT_ONCE):
            some = slice(middle + first, min(middle + first + ASKED_AT_ONCE, hi))
            for a, b in tree.search(own, label[lo:middle], others[first : first + ASKED_AT_ONCE], label[some]):
                pair = np.stack([doc[some][a], doc[lo:middle][b]], 1)
                found.append(np.sort(pair, axis=1))
        if len(found) > 4096:
            found = [np.unique(np.concatenate(found), axis=0)]
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def _mixed_groups(labelled: DataFrame) -> DataFrame:
    """``(group, doc, component, major, size, minor)`` of the blocks that hold several components.

    Blocks that hold the same components are one group: a family of near copies
    meets in about as many blocks as it has groups of tokens, with the same
    components each time.  ``major`` is the group's largest component and
    ``minor`` the number of documents outside it.  A pair of different
    components has a document outside the major one, so only those are asked.
    """
    met = labelled.select("block", "component").distinct()
    kinds = met.groupBy("block").agg(F.count("*").alias("kinds"), F.sum(F.xxhash64("component").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("component", F.lit(1))).alias("xor"))
    names = kinds.filter("kinds > 1").select("block", F.xxhash64("kinds", "sum", "xor").alias("group"))
    members = cut_lineage(labelled.join(names, "block").select("group", "doc", "component").distinct())
    sizes = members.groupBy("group", "component").agg(F.count("*").alias("n"))
    groups = sizes.groupBy("group").agg(F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("minor"), F.max_by("component", F.struct("n", "component")).alias("major"))
    return members.join(groups, "group")


def _cells(members: DataFrame) -> DataFrame:
    """``(group, x, y, doc, component, asked)``: chunks of a group's points against chunks of its asked documents.

    A cell has at most about ``CELL`` points and ``CELL`` asked documents.  Where
    few are asked, each point is in one cell.
    """
    columns, rows = (F.ceil(F.col(c) / CELL).cast("int") for c in ("size", "minor"))
    place = lambda n, salt: F.pmod(F.xxhash64("doc", F.lit(salt)), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    points = members.select("group", upto(rows).alias("x"), place(columns, 0).alias("y"), "doc", "component", F.lit(False).alias("asked"))
    asked = members.filter("component <> major").select("group", place(rows, 1).alias("x"), upto(columns).alias("y"), "doc", "component", F.lit(True).alias("asked"))
    return points.unionByName(asked)


def components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, its least linked ``doc_id``.

    Links run between rows of different ``doc_id``; rows that share one are one
    node.  Empty and null texts have no shingles and are alone.  A null
    ``doc_id`` is linked with nothing and is its own (null) component.  Other
    columns are not read; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    every = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))
    docs = every.filter("doc is not null")
    parts = blobs.part_count(spark)
    signed = docs.mapInArrow(_sign(parts), blobs.SCHEMA)
    met = cut_lineage(blobs.by_part(signed, _meet, MET))
    pairs = met.filter("kind = 1").select("a", "b").distinct()
    members = met.filter("kind = 2").select(F.col("a").alias("block"), F.col("b").alias("doc"))
    points = cut_lineage(_of_pairs_documents(docs, pairs, _points, members.select("doc")))
    copies = met.filter("kind = 0 and a <> b").select("a", "b")
    near = cut_lineage(_of_pairs(pairs, points, _bounded))
    edges = cut_lineage(copies.union(_links(docs, near)))
    labels = connected_components(edges)

    labelled = members.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("block", "doc", F.coalesce("component", "doc").alias("component"))
    cells = _cells(_mixed_groups(labelled)).join(points.select("doc", _coarse("value").alias("value")), "doc")
    groups = cells.withColumn("part", F.pmod(F.xxhash64("group", "x", "y"), F.lit(parts)))
    found = groups.groupBy("part").applyInArrow(_tree_pairs, "a bigint, b bigint").distinct()
    again = cut_lineage(_of_pairs(found.join(pairs, ["a", "b"], "left_anti"), points, _bounded, only_centres=False))
    if again.limit(1).count():
        more = _links(docs, again)
        if more.limit(1).count():
            labels = connected_components(edges.union(more))
    base = met.filter("kind = 0").select(F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"))
    out = base.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    lost = every.filter("doc is null").mapInArrow(_derive(_points, None, None), DERIVED).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    return out.unionByName(lost)


def _side(hit: IdFilter, id_at: int, held: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(id_at).cast(pa.int64())
            may = hit.may_hold(ids.fill_null(0).to_numpy(zero_copy_only=False)) & ~np.asarray(ids.is_null())
            yield batch.filter(pa.array(may if held else ~may))

    return run


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are the least of their component.

    Repeated rows of a ``doc_id`` stay or go together; a null ``doc_id`` stays.
    Only rows that an id filter does not clear are shuffled.
    """
    gone = cut_lineage(components(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("doc")).distinct())
    hit, at = IdFilter.of(gone), docs.columns.index("doc_id")
    clear = docs.mapInArrow(_side(hit, at, held=False), docs.schema)
    asked = docs.mapInArrow(_side(hit, at, held=True), docs.schema)
    return clear.unionByName(asked.join(gone, asked["doc_id"] == gone["doc"], "left_anti"))


#: Shared shingles counted for each pair, and what links reach.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE {DEN} * c >= {NUM} * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least_of.b AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) least_of ON least_of.a = d.doc_id
"""
