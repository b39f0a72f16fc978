"""Removal of repeated strings by a prefix-free parse of the corpus.

A rolling hash sets triggers in each text so that every string of ``LENGTH``
bytes holds one and equal strings hold it at the same place.  The strings that
share a trigger form a phrase, which reaches as far as they do.

* The parse: each document's phrases with their places.  Phrases are dealt by
  their trigger.  One that a smaller document has too goes whole; one whose
  trigger nobody else has stays.
* The dictionary: where a trigger has several phrases (at the ends of what is
  repeated), the distinct ones are brought together, and a suffix array orders
  their suffixes of at least ``LENGTH`` bytes.  Equal strings are neighbours in
  it, and each belongs to the least document that the parse has for it.
* These answers go back along the parse into text order; overlapping ones are
  merged.
* A trigger that very many phrases have (a passage of all documents, with other
  text beside it) would bring them all to one task.  Such triggers, of which
  there can be only ``MOST_HEAVY``, are found first; the strings around them are
  dealt by their own hashes, the least document of each run of texts only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm import blobs, kernels
from patchloom.llm.session import cut_lineage, prepare

U64 = np.uint64
LENGTH = 50
#: Triggers are TRIGGER bytes long; of the STRIDE places in a string, the one that its least STEP-byte hash selects modulo STRIDE.
TRIGGER, STRIDE, STEP = 28, 23, 5
SEGMENT = 1 << 20
RUN_BYTES = 16 << 20
LEAST_ID = -(2**63)

#: A trigger is heavy if it has over a MOST_HEAVY-th of all phrases, and NOTED in a run of texts at least.
MOST_HEAVY, NOTED = 20_000, 64

#: 48 bits of the trigger's and of the phrase's hash; ``at`` holds the first byte's place (34 bits) and the phrase's length (6).
PHRASE = np.dtype([("trigger_high", "<u4"), ("trigger_low", "<u2"), ("content_high", "<u4"), ("content_low", "<u2"), ("doc", "<i8"), ("at_high", "u1"), ("at", "<u4")])
#: The same where ids repeat, with a hash that tells apart the texts of one id.
TAGGED = np.dtype([*PHRASE.descr, ("tag", "<i8")])
STRING = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<i8")])
SPAN = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("start", "<i8"), ("end", "<i8")])
SHARED = np.dtype([("trigger", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<i8"), ("length", "<i8"), ("bytes", "u1", (LENGTH + STRIDE,))])


def phrases(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first byte, length, trigger hash and content hash of the phrases of a text buffer."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    steps = len(data) - STEP + 1
    word = data[:steps].astype(np.uint64)
    for i in range(1, STEP):
        word |= data[i : i + steps].astype(np.uint64) << U64(8 * i)
    word *= U64(0x9E3779B97F4A7C15)
    word &= U64(0xFFFFFFFFFF000000)
    word |= np.arange(steps, dtype=np.uint64)
    least, span = word, 1
    want = LENGTH - STEP + 1
    while span * 2 <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < want:
        least = np.minimum(least[: n], least[want - span : want - span + n])
    first = np.arange(n, dtype=np.int64)
    place = (least[:n] & U64(0xFFFFFF)).astype(np.int64)
    ahead = place - first
    trigger = first + (np.arange(LENGTH) % STRIDE)[ahead]
    row = np.searchsorted(offsets, first, "right") - 1 if len(offsets) > 2 else np.zeros(n, np.int64)
    whole = first + LENGTH <= offsets[row + 1]
    new = whole.copy()
    new[1:] &= ~(whole[:-1] & (trigger[1:] == trigger[:-1]) & (row[1:] == row[:-1]))
    last = whole.copy()
    last[:-1] &= ~(whole[1:] & (trigger[1:] == trigger[:-1]) & (row[1:] == row[:-1]))
    lo, hi = np.flatnonzero(new), np.flatnonzero(last) + LENGTH
    at = trigger[lo]
    power, inverse = kernels.TABLES.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(kernels.BYTE_HASH[data] * power[: len(data)], out=sums[1:])
    trigger_hash = kernels.mix((sums[at + TRIGGER] - sums[at]) * inverse[at])
    content = kernels.mix((sums[hi] - sums[lo]) * inverse[lo] + (at - lo).astype(np.uint64) * U64(0xD6E8FEB86659FD93) + (hi - lo).astype(np.uint64))
    return row[lo], lo - offsets[row[lo]], hi - lo, trigger_hash, content


def string_hashes(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``LENGTH`` bytes from each place."""
    out = np.zeros(len(first), np.uint64)
    for i in range(LENGTH):
        out *= U64(kernels.BASE)
        out += kernels.BYTE_HASH[data[first + i]]
    return kernels.mix(out)


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, first byte in it, bytes and row offsets, of at most about ``SEGMENT`` bytes each."""
    for lo, hi in kernels.doc_chunks(offsets, SEGMENT):
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= 2 * SEGMENT:
            yield lo, 0, data[a:b], offsets[lo : hi + 1] - a
        else:
            for at in range(a, b - LENGTH + 1, SEGMENT):
                part = data[at : min(at + SEGMENT + LENGTH - 1, b)]
                yield lo, at - a, part, np.array([0, len(part)])


def merged(start: np.ndarray, end: np.ndarray, *groups: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of overlapping or touching spans; sorted by groups, then start."""
    if len(start) == 0:
        return (start, end, *groups)
    order = np.lexsort((start, *groups[::-1]))
    start, end, groups = start[order], end[order], tuple(g[order] for g in groups)
    first = blobs.runs(*groups)
    run = np.zeros(len(start), np.int64)
    run[first] = 1
    run = np.cumsum(run)
    shift = run * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1
    return (start[at], (reach - shift)[last], *(g[at] for g in groups))


def _span_records(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    start, end, doc, tag = merged(start, end, doc, tag)
    out = np.empty(len(doc), SPAN)
    out["doc"], out["tag"], out["start"], out["end"] = doc, tag, start, end
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, np.ndarray, np.ndarray]]:
    """Ids and tags of a batch with each segment of its texts: first row, first byte, bytes and row offsets."""
    for batch in batches:
        ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        data, offsets = kernels.text_buffer(batch.column(2))
        for segment in _segments(data, offsets):
            yield ids, tags, *segment


def _note_triggers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Triggers that a run of texts has ``NOTED`` times or more, and with 0 the run's number of phrases."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        trigger, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]) >> U64(16), return_counts=True)
        noted = n >= NOTED
        total = int(n.sum())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(np.append(trigger[noted].astype(np.int64), 0)), pa.array(np.append(n[noted], total))], ["trigger", "n"])

    for _, _, _, _, part, at in _texts(batches):
        held.append(phrases(part, at)[3])
        size += len(part)
        if size >= RUN_BYTES:
            size = 0
            yield flush()
    yield flush()


def heavy_triggers(texts: DataFrame) -> np.ndarray:
    """The first 48 bits of the triggers that more than a ``MOST_HEAVY``-th of all phrases have, in order."""
    counts = cut_lineage(texts.mapInArrow(_note_triggers, "trigger bigint, n bigint").groupBy("trigger").agg(F.sum("n").alias("n")))
    total = counts.filter("trigger = 0").agg(F.sum("n")).first()[0] or 0
    rows = counts.filter((F.col("trigger") != 0) & (F.col("n") > total / MOST_HEAVY) & (F.col("n") >= NOTED)).select("trigger").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).astype(np.uint64))


def _least_first(key: np.ndarray, doc: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by keys, then documents, and which places in it are not of a key's least document."""
    order = np.lexsort((doc, *more, key))
    first = blobs.runs(key[order], *(m[order] for m in more))
    return order, doc[order] > np.repeat(doc[order][first], np.diff([*first, len(order)]))


def _parse(parts: int, heavy, tagged: bool):
    def flush(held: list[tuple[np.ndarray, ...]], strings: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        spans = []
        if held:
            doc, tag, start, length, trigger, content = (np.concatenate(x) for x in zip(*held, strict=True))
            order, again = _least_first(trigger, doc, content)
            doc, tag, start, length, trigger, content = (x[order] for x in (doc, tag, start, length, trigger, content))
            spans.append((doc[again], tag[again], start[again], (start + length)[again]))
            out = np.empty(int((~again).sum()), TAGGED if tagged else PHRASE)
            for name, hashes in (("trigger", trigger[~again]), ("content", content[~again])):
                out[f"{name}_high"], out[f"{name}_low"] = hashes >> U64(32), (hashes >> U64(16)) & U64(0xFFFF)
            out["doc"] = doc[~again]
            at = (start[~again].astype(np.uint64) << U64(6)) | (length[~again] - LENGTH).astype(np.uint64)
            out["at_high"], out["at"] = at >> U64(32), at & U64(0xFFFFFFFF)
            if tagged:
                out["tag"] = tag[~again]
            rows += blobs.deal(0, trigger[~again], out, parts)
        if strings:
            key, doc, tag, start = (np.concatenate(x) for x in zip(*strings, strict=True))
            order, again = _least_first(key, doc)
            key, doc, tag, start = (x[order] for x in (key, doc, tag, start))
            spans.append((doc[again], tag[again], start[again], start[again] + LENGTH))
            out = np.empty(int((~again).sum()), STRING)
            out["hash"], out["doc"], out["tag"], out["start"] = key[~again], doc[~again], tag[~again], start[~again]
            rows += blobs.deal(2, out["hash"], out, parts)
        if spans:
            gone = _span_records(*(np.concatenate(x) for x in zip(*spans, strict=True)))
            rows += blobs.deal(1, kernels.mix(gone["doc"].astype(np.uint64)), gone, parts)
        held.clear()
        strings.clear()
        for lo in range(0, len(rows), 256):
            yield blobs.batch(rows[lo : lo + 256])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        strings: list[tuple[np.ndarray, ...]] = []
        often, size = heavy.value, 0
        for ids, tags, lo, ahead, part, at in _texts(batches):
            row, start, length, trigger, content = phrases(part, at)
            if len(often):
                place = np.minimum(np.searchsorted(often, trigger >> U64(16)), len(often) - 1)
                split = often[place] == trigger >> U64(16)
                n = length[split] - LENGTH + 1
                own = np.repeat(row[split], n)
                each = np.repeat(start[split], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                strings.append((string_hashes(part, at[own] + each), ids[own + lo], tags[own + lo], each + ahead))
                row, start, length, trigger, content = (x[~split] for x in (row, start, length, trigger, content))
            held.append((ids[row + lo], tags[row + lo], start + ahead, length, trigger, content))
            size += len(part)
            if size >= RUN_BYTES:
                size = 0
                yield from flush(held, strings)
        yield from flush(held, strings)
        kernels.release()

    return run


#: kind 0: bytes to remove; 1: a phrase whose trigger has other phrases.
MARKS = "kind int, doc bigint, tag bigint, start bigint, end bigint"


def _marks(kind: int, doc, tag, start, end) -> pa.Table:
    return pa.table([pa.array(np.full(len(doc), kind, np.int32)), *(pa.array(np.ascontiguousarray(x), pa.int64()) for x in (doc, tag, start, end))], ["kind", "doc", "tag", "start", "end"])


def _dictionary(tagged: bool):
    def run(got: dict[int, list[bytes]]) -> pa.Table:
        out = [_marks(0, *(np.empty(0, np.int64),) * 4)]
        if 1 in got:
            gone = blobs.unpack(got[1], SPAN)
            out.append(_marks(0, gone["doc"], gone["tag"], gone["start"], gone["end"]))
        if 2 in got:
            found = blobs.unpack(got[2], STRING)
            order, again = _least_first(found["hash"], found["doc"])
            found = found[order][again]
            spans = _span_records(found["doc"], found["tag"], found["start"], found["start"] + LENGTH)
            out.append(_marks(0, spans["doc"], spans["tag"], spans["start"], spans["end"]))
        if 0 in got:
            found = blobs.unpack(got[0], TAGGED if tagged else PHRASE)
            trigger = found["trigger_high"].astype(np.uint64) << U64(16) | found["trigger_low"]
            order = np.argsort(trigger)
            found, trigger = found[order], trigger[order]
            first = blobs.runs(trigger)
            several = np.repeat(np.diff([*first, len(found)]) > 1, np.diff([*first, len(found)]))
            found, trigger = found[several], trigger[several]
            if len(found):
                content = found["content_high"].astype(np.uint64) << U64(16) | found["content_low"]
                order, gone = _least_first(trigger, found["doc"], content)
                found, trigger, content = found[order], trigger[order], content[order]
                first = blobs.runs(trigger)
                count = np.diff([*first, len(found)])
                other_doc = np.repeat(np.minimum.reduceat(found["doc"], first) < np.maximum.reduceat(found["doc"], first), count)
                mixed = np.zeros(len(found), np.int64)
                mixed[blobs.runs(trigger, content)] = 1
                mixed = np.repeat(np.add.reduceat(mixed, first) > 1, count)
                at = found["at_high"].astype(np.uint64) << U64(32) | found["at"]
                start = (at >> U64(6)).astype(np.int64)
                end = start + LENGTH + (at & U64(63)).astype(np.int64)
                tag = found["tag"] if tagged else np.zeros(len(found), np.int64)
                spans = _span_records(found["doc"][gone], tag[gone], start[gone], end[gone])
                out.append(_marks(0, spans["doc"], spans["tag"], spans["start"], spans["end"]))
                ask = ~gone & mixed & other_doc
                out.append(_marks(1, found["doc"][ask], tag[ask], start[ask], end[ask]))
        return pa.concat_tables(out)

    return run


def _share(parts: int):
    """Bytes of the asked phrases, dealt by their trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            data, offsets = kernels.text_buffer(batch.column(2))
            asked = batch.column(3)
            n = np.diff(asked.offsets.to_numpy())
            start, end = (asked.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row = np.repeat(np.arange(len(n)), n)
            for lo in range(0, len(row), 1 << 17):
                r, s, e = row[lo : lo + (1 << 17)], start[lo : lo + (1 << 17)], end[lo : lo + (1 << 17)]
                out = np.zeros(len(r), SHARED)
                out["doc"], out["tag"], out["start"], out["length"] = docs[r], tags[r], s, e - s
                places = (offsets[r] + s)[:, None] + np.arange(LENGTH + STRIDE)
                inside = np.arange(LENGTH + STRIDE) < (e - s)[:, None]
                out["bytes"] = np.where(inside, data[np.minimum(places, len(data) - 1)], 0)
                least = _least_steps(out["bytes"][:, :LENGTH])
                trigger = (least % STRIDE)[:, None] + np.arange(TRIGGER)
                key = kernels.mix(np.ascontiguousarray(np.take_along_axis(out["bytes"], trigger, 1)).view("<u4").astype(np.uint64) @ np.array([pow(kernels.BASE, i + 1, 2**64) for i in range(TRIGGER // 4)], np.uint64))
                out["trigger"] = key
                rows = list(blobs.deal(0, key, out, parts))
                for a in range(0, len(rows), 256):
                    yield blobs.batch(rows[a : a + 256])

    return run


def _least_steps(strings: np.ndarray) -> np.ndarray:
    """Place of the least hash of STEP bytes in each string of LENGTH bytes, as ``phrases`` has it."""
    steps = LENGTH - STEP + 1
    word = strings[:, :steps].astype(np.uint64)
    for i in range(1, STEP):
        word |= strings[:, i : i + steps].astype(np.uint64) << U64(8 * i)
    word *= U64(0x9E3779B97F4A7C15)
    return np.argmin(word & U64(0xFFFFFFFFFF000000), axis=1)


def suffix_array(dictionary: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of at least ``LENGTH`` bytes of distinct phrases in order of their first ``LENGTH`` bytes.

    For each: its phrase, its place in it, and whether these bytes differ from
    those of the suffix before.  Phrases have at most ``LENGTH + STRIDE`` bytes.
    """
    phrase, place, text = [], [], []
    for i in range(STRIDE + 1):
        has = np.flatnonzero(length >= LENGTH + i)
        if len(has):
            phrase.append(has)
            place.append(np.full(len(has), i))
            text.append(np.ascontiguousarray(dictionary[has, i : i + LENGTH]).view(f"S{LENGTH}").ravel())
    phrase, place, text = np.concatenate(phrase), np.concatenate(place), np.concatenate(text)
    order = np.argsort(text, kind="stable")
    text = text[order]
    return phrase[order], place[order], np.append(True, text[1:] != text[:-1])


def _order(got: dict[int, list[bytes]]) -> pa.Table:
    """Spans of the strings of the shared phrases that a smaller document has too.

    The parse names each phrase by its entry in the dictionary of distinct ones.
    Equal strings are neighbours in the dictionary's suffix array; the least
    document of a run of them is the least that the parse has for its phrases.
    """
    out = [_marks(0, *(np.empty(0, np.int64),) * 4)]
    for shared in _groups(got.get(0, [])):
        whole = np.ascontiguousarray(shared["bytes"]).view(f"V{LENGTH + STRIDE}").ravel()
        _, entry, parse = np.unique(whole, return_index=True, return_inverse=True)
        phrase, place, new = suffix_array(shared["bytes"][entry], shared["length"][entry])
        least_of_phrase = np.full(len(entry), np.iinfo(np.int64).max)
        np.minimum.at(least_of_phrase, parse, shared["doc"])
        first = np.flatnonzero(new)
        least = np.empty(len(phrase), np.int64)
        least[:] = np.repeat(np.minimum.reduceat(least_of_phrase[phrase], first), np.diff([*first, len(phrase)]))
        by_phrase = np.argsort(phrase, kind="stable")
        suffixes = np.bincount(phrase, minlength=len(entry))
        begin = np.cumsum(suffixes) - suffixes
        n = suffixes[parse]
        occurrence = np.repeat(np.arange(len(shared)), n)
        suffix = by_phrase[np.repeat(begin[parse], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
        gone = shared["doc"][occurrence] > least[suffix]
        occurrence, start = occurrence[gone], shared["start"][occurrence[gone]] + place[suffix[gone]]
        spans = _span_records(shared["doc"][occurrence], shared["tag"][occurrence], start, start + LENGTH)
        out.append(_marks(0, spans["doc"], spans["tag"], spans["start"], spans["end"]))
    return pa.concat_tables(out)


def _groups(data: list[bytes]) -> Iterator[np.ndarray]:
    """The shared phrases, whole triggers at a time, about 50,000 in each piece."""
    if not data:
        return
    shared = blobs.unpack(data, SHARED)
    shared = shared[np.argsort(shared["trigger"], kind="stable")]
    cuts = np.append(blobs.runs(shared["trigger"]), len(shared))
    lo = 0
    while lo < len(shared):
        hi = int(cuts[min(np.searchsorted(cuts, lo + 50_000), len(cuts) - 1)])
        yield shared[lo:hi]
        lo = hi


def _id(column: Column) -> Column:
    return F.coalesce(column.cast("bigint"), F.lit(LEAST_ID))


def keyed_texts(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``(doc, tag, text)`` and whether ids repeat; the tag, a hash of the text, tells apart the texts of one id and is 0 where none repeats."""
    texts = docs.select(_id(F.col("doc_id")).alias("doc"), F.col("text").cast("string").alias("text"))
    repeated = texts.groupBy("doc").count().filter("count > 1").limit(1).count() > 0
    tag = F.xxhash64("text") if repeated else F.lit(0).cast("bigint")
    return texts.select("doc", tag.alias("tag"), "text"), repeated


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc``, ``text`` and ``spans``, the byte ranges to remove, whose overlaps are not merged.

    Texts are shuffled by id once: the exchange below the first join is the one
    below the second.
    """
    spark = prepare(docs.sparkSession)
    parts = blobs.part_count(spark)
    texts, tagged = keyed_texts(docs)
    heavy = spark.sparkContext.broadcast(heavy_triggers(texts))
    marks = cut_lineage(blobs.by_part(texts.mapInArrow(_parse(parts, heavy, tagged), blobs.SCHEMA), _dictionary(tagged), MARKS))
    lists = marks.filter("kind = 1").groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "end")).alias("asked"))
    shared = texts.hint("merge").join(lists, ["doc", "tag"]).mapInArrow(_share(parts), blobs.SCHEMA)
    gone = marks.filter("kind = 0").unionByName(blobs.by_part(shared, _order, MARKS))
    spans = gone.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return texts.hint("merge").join(spans, ["doc", "tag"], "left").select("doc", "text", "spans")


def _cut(spans: object, size: int) -> np.ndarray:
    """Merged spans of one document, as an array of (start, end)."""
    if spans is None or len(spans) == 0:
        return np.empty((0, 2), np.int64)
    both = np.array([(x["start"], x["end"]) for x in spans], np.int64)
    return np.stack(merged(both[:, 0], np.minimum(both[:, 1], size), np.zeros(len(both), np.int64))[:2], 1)


def _kept(text: str | None, spans: object) -> tuple[bytes, bytes, np.ndarray]:
    raw = (text or "").encode()
    cut, out, at = _cut(spans, len(raw)), [], 0
    for lo, hi in cut.tolist():
        out.append(raw[at:lo])
        at = hi
    return raw, b"".join([*out, raw[at:]]), cut


def _report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for doc, text, spans in zip(f["doc"], f["text"], f["spans"], strict=True):
            raw, kept, cut = _kept(text, spans)
            rows.append((None if doc == LEAST_ID else doc, len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})


def report(docs: DataFrame) -> DataFrame:
    """Per row: bytes, removed bytes, maximal removed runs and the digest of the rest.

    Each string is judged on the input.  A null text is empty; texts under
    ``LENGTH`` bytes stay whole.  Rows that share a ``doc_id`` are no smaller
    than each other; a null ``doc_id`` is smaller than all numbers.  Other
    columns are not read; an empty table gives no rows.
    """
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return repeated_spans(docs).mapInPandas(_report, schema)


def _remaining(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        kept = [_kept(t, s)[1].decode(errors="ignore") for t, s in zip(f["text"], f["spans"], strict=True)]
        yield pd.DataFrame({"doc_id": [None if d == LEAST_ID else d for d in f["doc"]], "text": kept}).astype({"doc_id": "Int64"})


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the remaining text; characters cut in two at a span's end go whole.

    A null text comes back empty; other edge cases are those of ``report``.
    """
    return repeated_spans(docs).mapInPandas(_remaining, "doc_id bigint, text string")


#: Every string of LENGTH bytes with the least document that has it, and the bytes that no repeated one covers.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (SELECT doc_id, i, array_slice(b, i + 1, i + {LENGTH}) AS t FROM (SELECT doc_id, b, unnest(range(0, n - {LENGTH - 1})) AS i FROM d WHERE n >= {LENGTH})),
f AS (SELECT t, min(doc_id) AS first FROM s GROUP BY t),
h AS (SELECT s.doc_id, s.i FROM s JOIN f USING (t) WHERE f.first < s.doc_id),
m AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS new FROM h)),
r AS (SELECT doc_id, min(i) AS lo, max(i) + {LENGTH} AS hi FROM m GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS lo, lo AS hi FROM r UNION ALL SELECT r.doc_id, max(r.hi), any_value(d.n) FROM r JOIN d USING (doc_id) GROUP BY r.doc_id),
l AS (SELECT doc_id, list_reduce(list(array_slice(b, lo + 1, hi) ORDER BY lo), lambda x, y: x || y) AS b FROM k JOIN d USING (doc_id) GROUP BY doc_id),
g AS (SELECT doc_id, sum(hi - lo) AS n, count(*) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(g.spans, 0) AS n_spans, sha256(coalesce(l.b, d.b)) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN g USING (doc_id)
"""
