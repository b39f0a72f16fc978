"""Harmonic packing of tokenised documents into fixed-length sequences.

A document of ``length`` ids that fits a sequence belongs to the class of the
reciprocal capacity ``capacity // length``: class k holds the lengths over
``capacity / (k + 1)`` and up to ``capacity / k``, and fills each of its
sequences with exactly k whole documents, whatever the other classes do.  What
such a sequence leaves free is filled by a stream of cut documents: those longer
than a sequence, which have to be cut anyway, and, only as far as these do not
suffice, the documents of the emptiest sequences.  The rest of the stream makes
full sequences, and one that may not be full.

Blocks of documents, dealt by a hash, are packed independently by different
workers.  A block has about ``BLOCK_BYTES`` of text, so it is all that a task
ever holds besides a longer document, and the share of padding does not depend
on the input's size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm import kernels
from patchloom.llm.session import prepare

CAPACITY = 2048
BLOCK_BYTES = 4 << 20
END_ID = 1
#: A worker keeps so many words and ids, about 30 bytes a word, in each of two generations.
CACHE_WORDS, CACHE_IDS = 600_000, 4_000_000
#: Longer words are not kept.
LONGEST_WORD = 64
CHUNK_BYTES = 1 << 20

#: Ids travel in as few bytes as all of the tokenizer fit, 2 or 4.
TOKENS = "block bigint, doc_id bigint, width int, ids binary"
RESULT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Known:
    """Ids of words by 64-bit hash, in order of hash; ``alpha`` tells whether a word is of letters only.

    A table of a million words is wrong about a word that it lacks once in
    2 ** 44 lookups.
    """

    def __init__(self) -> None:
        self.key, self.at, self.n, self.alpha = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint16), np.empty(0, bool)
        self.pool = np.empty(0, np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are here, and their entries."""
        place = np.searchsorted(self.key, keys)
        if not len(self.key):
            return np.zeros(len(keys), bool), place
        place = np.minimum(place, len(self.key) - 1)
        return self.key[place] == keys, place

    def add(self, key: np.ndarray, ids: list[np.ndarray], alpha: np.ndarray) -> None:
        n = np.array([len(x) for x in ids], np.uint16)
        at = len(self.pool) + np.cumsum(n, dtype=np.int64) - n
        order = np.argsort(key, kind="stable")
        into = np.searchsorted(self.key, key[order])
        self.key, self.at, self.n, self.alpha = (np.insert(old, into, new[order]) for old, new in ((self.key, key), (self.at, at.astype(np.uint32)), (self.n, n), (self.alpha, alpha)))
        self.pool = np.concatenate([self.pool, *ids]).astype(np.uint32)


#: Bytes of words for hashing; space and line feed part words.  ASCII words are the same in any case.
WORD_BYTES = np.arange(256, dtype=np.uint8)
WORD_BYTES[[0x20, 0x0A]] = 0
LOWER_BYTES = WORD_BYTES.copy()
LOWER_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
SIGNS = b".,"


class WordIds:
    """Ids of texts by way of their white-space separated words.

    The tokenizer drops white space, never joins across it, and parts letters
    from other signs.  So a text's ids are its words' ids in turn, and those of
    a word of letters with a full stop or comma are the word's and the sign's.
    Words of letters are encoded many at a time and cut after the ids that end
    a word.  Words are remembered up to a bound, those of the last two
    generations, as long as the worker lives.
    """

    shared: dict[str, WordIds] = {}

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.older = Known(), Known()
        self.signs = {sign: ids for sign, ids in zip(SIGNS, self._encode_each([chr(c) for c in SIGNS]), strict=True)}

    @classmethod
    def of(cls, tokenizer_path: str) -> WordIds:
        if tokenizer_path not in cls.shared:
            cls.shared[tokenizer_path] = cls(tokenizer_path)
        return cls.shared[tokenizer_path]

    def _encode_each(self, words: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(words), 4096):
            for got in self.tokenizer.encode_batch_fast(words[at : at + 4096], add_special_tokens=False):
                yield np.asarray(got.ids, np.uint32)

    def _encode_letters(self, words: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(words), 512):
            some = words[at : at + 512]
            ids = np.asarray(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                yield from np.split(ids, cuts[:-1])
            else:
                yield from self._encode_each(some)

    def _ids_of(self, words: list[str], alpha: list[bool]) -> list[np.ndarray]:
        letters = self._encode_letters([w for w, a in zip(words, alpha, strict=True) if a])
        others = self._encode_each([w for w, a in zip(words, alpha, strict=True) if not a])
        return [next(letters if a else others) for a in alpha]

    def _resolved(self, keys: np.ndarray, norm: np.ndarray, starts: np.ndarray, ends: np.ndarray, ask) -> tuple[np.ndarray, np.ndarray]:
        """Entries in ``known`` of all words, by their keys; new ones are learned.  ``ask(words)`` says which of the new are of letters only."""
        unique, first, place = np.unique(keys, return_index=True, return_inverse=True)
        here, _ = self.known.find(unique)
        was, entry = self.older.find(unique)
        moved = np.flatnonzero(~here & was)
        if len(moved):
            old = entry[moved]
            at, n = self.older.at[old].astype(np.int64), self.older.n[old]
            self.known.add(unique[moved], [self.older.pool[lo : lo + k] for lo, k in zip(at.tolist(), n.tolist(), strict=True)], self.older.alpha[old])
        fresh = np.flatnonzero(~here & ~was)
        if len(fresh):
            words = [norm[s:e].tobytes().decode() for s, e in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist(), strict=True)]
            alpha = ask(words)
            self.known.add(unique[fresh], self._ids_of(words, alpha), np.array(alpha, bool))
        _, entry = self.known.find(unique)
        return entry[place], place

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows of a text buffer, one after the other, and their row offsets."""
        if len(self.known.key) > CACHE_WORDS or len(self.known.pool) > CACHE_IDS:
            self.older, self.known = self.known, Known()
        spans = np.where(data == 0, np.uint8(1), WORD_BYTES[data])
        starts, ends, row_at = kernels.word_spans(spans, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        count = lambda mask: np.diff(np.append(0, np.cumsum(mask))[np.stack([starts, ends])], axis=0)[0]
        ascii_word = count(data >= 0x80) == 0
        odd = (count(data == 0) > 0) | (ends - starts > LONGEST_WORD)
        lower = np.zeros(len(data) + 1, np.int8)
        lower[starts[ascii_word]] += 1
        lower[ends[ascii_word]] -= 1
        norm = np.where(np.cumsum(lower[:-1], dtype=np.int8) > 0, LOWER_BYTES[data], data)
        last = data[ends - 1]
        signed = np.isin(last, np.frombuffer(SIGNS, np.uint8)) & (ends - starts > 1) & ~odd
        stems = ends - signed
        entry = np.zeros(len(starts), np.int64)
        plain = np.flatnonzero(~odd)
        letters = lambda words: [w.isalpha() for w in words]
        keys = kernels.word_hashes(norm, starts[plain], stems[plain])
        entry[plain], _ = self._resolved(keys, norm, starts[plain], stems[plain], letters)
        whole = np.flatnonzero(signed & ~np.where(odd, False, self.known.alpha[entry]))
        sign = signed.copy()
        sign[whole] = False
        if len(whole):
            before = len(self.known.key)
            keys = kernels.word_hashes(norm, starts[whole], ends[whole])
            again, _ = self._resolved(keys, norm, starts[whole], ends[whole], lambda words: [False] * len(words))
            if len(self.known.key) != before:
                entry[plain], _ = self._resolved(kernels.word_hashes(norm, starts[plain], stems[plain]), norm, starts[plain], stems[plain], letters)
            entry[whole] = again
        at, n = self.known.at[entry].astype(np.int64), self.known.n[entry].astype(np.int64)
        pool = self.known.pool
        rare = np.flatnonzero(odd)
        if len(rare):
            ids = list(self._encode_each([data[s:e].tobytes().decode() for s, e in zip(starts[rare].tolist(), ends[rare].tolist(), strict=True)]))
            n[rare] = [len(x) for x in ids]
            at[rare] = len(pool) + np.cumsum(n[rare]) - n[rare]
            pool = np.concatenate([pool, *ids])
        size = n + sign
        to = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to, n) + within] = pool[np.repeat(at, n) + within]
        for c, ids in self.signs.items():
            own = sign & (last == c)
            out[(to + n)[own]] = ids[0]
        return out, np.append(to, len(out))[row_at]


def _tokenise(tokenizer_path: str, end_id: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words, task = WordIds.of(tokenizer_path), TaskContext.get().partitionId()
        width = 2 if max(len(words.ends) - 1, end_id) < 1 << 16 else 4
        for batch in batches:
            data, offsets = kernels.text_buffer(batch.column(1))
            for lo, hi in kernels.doc_chunks(offsets, CHUNK_BYTES):
                ids, at = words.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = at + np.arange(len(at))
                ended = np.full(at[-1], end_id, f"<u{width}")
                ended[np.delete(np.arange(at[-1]), at[1:] - 1)] = ids
                docs = batch.column(0).slice(lo, hi - lo)
                column = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((width * at).astype(np.int32)), pa.py_buffer(ended)])
                block = [zlib.crc32(b"%d %d" % (doc or 0, task), zlib.crc32(raw.as_buffer())) % blocks for doc, raw in zip(docs.to_pylist(), column, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), docs, pa.array(np.full(hi - lo, width, np.int32)), column], ["block", "doc_id", "width", "ids"])
        kernels.release()

    return run


def harmonic_bins(length: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Sequences of exactly ``capacity // length`` documents of one class, longer ones first; a class's last may have fewer."""
    kind = capacity // length
    order = np.lexsort((np.arange(len(length)), -length, kind))
    kind = kind[order]
    out = []
    cuts = np.append(np.flatnonzero(np.append(True, kind[1:] != kind[:-1])), len(kind)) if len(kind) else []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        k = int(kind[lo])
        out += [order[at : min(at + k, hi)] for at in range(lo, hi, k)]
    return out


def placed(length: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces (document, start, length, sequence, offset) of documents of the given numbers of ids, each at least 1."""
    fits = np.flatnonzero(length <= capacity)
    bins = [fits[b] for b in harmonic_bins(length[fits], capacity)]
    used = np.array([length[b].sum() for b in bins], np.int64)
    order = np.argsort(used, kind="stable")
    long = np.flatnonzero(length > capacity)
    stream = int(length[long].sum()) + np.append(0, np.cumsum(used[order]))
    free = np.append(0, np.cumsum((capacity - used[order])[::-1]))[::-1]
    dissolved = int(np.argmax(stream >= free)) if len(bins) else 0
    kept = [bins[i] for i in order[dissolved:]]
    streamed = np.concatenate([long, *(bins[i] for i in order[:dissolved])]).astype(np.int64)
    out: list[tuple[np.ndarray, ...]] = []
    gap_at: list[tuple[int, int, int]] = []
    for sequence, members in enumerate(kept):
        offset = np.cumsum(length[members]) - length[members]
        out.append((members, np.zeros_like(members), length[members], np.full_like(members, sequence), offset))
        room = capacity - int(length[members].sum())
        if room:
            gap_at.append((sequence, capacity - room, room))
    total = int(length[streamed].sum())
    gaps = np.array(gap_at, np.int64).reshape(-1, 3)
    rest = max(0, total - int(gaps[:, 2].sum()))
    full = np.arange(-(-rest // capacity))
    fresh = np.stack([len(kept) + full, np.zeros_like(full), np.full_like(full, capacity)], 1)
    slots = np.concatenate([gaps, fresh])
    slot_end = np.cumsum(slots[:, 2])
    doc_end = np.cumsum(length[streamed])
    cuts = np.unique(np.concatenate([[0], slot_end[slot_end < total], doc_end]))
    lo, hi = cuts[:-1], cuts[1:]
    d, s = np.searchsorted(doc_end, lo, "right"), np.searchsorted(slot_end, lo, "right")
    if len(lo):
        out.append((streamed[d], lo - (doc_end - length[streamed])[d], hi - lo, slots[s, 0], slots[s, 1] + lo - (slot_end - slots[:, 2])[s]))
    return np.stack([np.concatenate(c) for c in zip(*out, strict=True)], 1).astype(np.int64) if out else np.empty((0, 5), np.int64)


def _pack(capacity: int, with_ids: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        block, width = (table.column(c)[0].as_py() for c in ("block", "width"))
        raw = [np.frombuffer(x.as_buffer(), f"<u{width}").astype("<u4") for x in table.column("ids").combine_chunks()]
        length = np.array([len(x) for x in raw], np.int64)
        pieces = placed(length, capacity)
        pieces = pieces[np.lexsort((pieces[:, 4], pieces[:, 3]))]
        cut = [raw[d][start : start + n] for d, start, n in pieces[:, :3].tolist()]
        columns = {
            "doc_id": table.column("doc_id").take(pa.array(pieces[:, 0])), "start": pa.array(pieces[:, 1]), "length": pa.array(pieces[:, 2]), "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64()),
            "doc_tokens": pa.array(length[pieces[:, 0]]), "sequence_id": pa.array((block << 32) + pieces[:, 3]), "offset": pa.array(pieces[:, 4]),
        }
        if with_ids:
            columns["ids"] = pa.array([x.astype(np.int64) for x in cut], pa.list_(pa.int64()))
        return pa.table(columns)

    return run


def packed_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES, with_ids: bool = True) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ``ids``.

    ``capacity`` is at least 1.  A null or empty text has the end id alone.
    Each row is a document of its own, also when ``doc_id`` is null or repeated
    (repeated rows of a file's part go to one block).  A very long document is
    cut like any other, in one task.  Of equal documents in a block any order is
    the same.  Other columns are not read; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    tokens = docs.mapInArrow(_tokenise(tokenizer_path, end_id, blocks), TOKENS)
    return tokens.groupBy("block").applyInArrow(_pack(capacity, with_ids), RESULT + (", ids array<bigint>" if with_ids else ""))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``packed_pieces`` with the digest of each piece's ids instead of the ids."""
    return packed_pieces(docs, tokenizer_path, capacity, end_id, block_bytes, with_ids=False)
