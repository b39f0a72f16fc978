"""Language-model scores by a weighted backoff automaton of word n-grams.

The model interpolates counts of one to three words.  With ``c`` the count of
an n-gram in the texts that are learned from:

    p1(w)    = (c(w) + 1) / (N + V + 1)
    pn(w|h)  = (1 - gn) * c(hw) / c(h) + gn * pn-1(w|h')

where h' is h without its first word, and pn is pn-1 where h was never seen.  So
a seen n-gram hw is an arc of state h, a failure arc leads from h to h' with the
weight gn, and all arcs of a state and those behind its failure arc sum to one.
``gn`` is left-one-out: of the tokens whose context also occurs elsewhere, the
share whose n-gram does not, which follows from the n-grams met once.

1. Texts are kept in blocks of ``BLOCK_BYTES``.  A block asks for the counts of
   its distinct n-grams, and tells its own, as sorted hashes dealt by ranges.
2. Each range sums what the blocks tell and answers every block in the order of
   its question, and with the range's share of N, V and the n-grams met once.
3. A block's n-grams, with their counts, are the states and arcs that its texts
   can reach.  One traversal from left to right carries the state and adds up
   the weights, many stretches of the block side by side; a stretch starts in
   the state that the two tokens before it lead to.

Weights are whole multiples of ``1 / UNIT``, so that sums are exact in any
order.  Words are told apart by 64 bits of hash, n-grams by ``key_bits``, which
grow with the corpus: one that it lacks is taken for another with a chance of
2 ** -SPARE_BITS at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm import blobs, kernels
from patchloom.llm.ngram_join import WORD_BYTES
from patchloom.llm.session import cut_lineage, prepare

U64 = np.uint64
BLOCK_BYTES = 6 << 20
#: A block's texts travel in rows of this size, the first of them numbered FIRST.
PIECE_BYTES, FIRST = 256 << 10, -(1 << 30)
LANES = 2048
UNIT = 10**10
#: An n-gram's hash has so many bits more than it takes to number the corpus's tokens.
SPARE_BITS = 20
#: The bounds of the weight of a failure arc, and its value where nothing tells.
LEAST_GAMMA, MOST_GAMMA, BLIND_GAMMA = 0.05, 0.95, 0.5
FOLDS, HELD_FOLD = 7, 2

#: What stands for the begin and the end of a text among the hashes of words.
BEGIN, END = U64(0x6A09E667F3BCC908), U64(0xBB67AE8584CAA73B)
#: Numbers of a part: tokens, words, texts, and n-grams met once of each length.
STATS = ["tokens", "words", "texts", "once1", "once2", "once3"]

RESULT = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
_LEVEL = pa.Codec("zstd", compression_level=7)


def held_out(doc_id: Column) -> Column:
    """True for the rows that the model does not learn from; so is a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_FOLD, F.lit(True))


class Grams(NamedTuple):
    """A block's tokens and distinct n-grams.

    ``tokens`` number ``words`` (hashes in order); token 0 to n of each text are
    its begin, words and end.  ``keys[k]`` are the hashes of the distinct
    n-grams of k + 1 tokens in order, and ``told[k]`` their counts in the
    block's texts that are learned from.  ``pair`` and ``triple`` hold the
    n-grams by token numbers, in order, ``of_pair`` and ``of_triple`` their
    places in ``keys``.
    """

    tokens: np.ndarray
    text_at: np.ndarray
    words: np.ndarray
    keys: list[np.ndarray]
    told: list[np.ndarray]
    pair: np.ndarray
    of_pair: np.ndarray
    triple: np.ndarray
    of_triple: np.ndarray
    triple_end: np.ndarray


def _joined(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    return kernels.mix(prefix * kernels.WINDOW_BASE + word)


def _distinct(hashes: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, their summed counts, and each one's place."""
    keys, place = np.unique(hashes, return_inverse=True)
    return keys, np.bincount(place, told, len(keys)).astype(np.int32), place.astype(np.int32)


def _numbered(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and each one's place in 32 bits."""
    distinct, place = np.unique(tokens, return_inverse=True)
    return distinct, place.astype(np.int32)


def grams_of(texts: pa.Array, learn: np.ndarray) -> Grams:
    """The n-grams of a block; ``learn`` tells which texts count."""
    data, offsets = kernels.text_buffer(texts)
    norm = WORD_BYTES[data]
    starts, ends, word_at = kernels.word_spans(norm, offsets)
    n = len(word_at) - 1
    hashes = np.empty(len(starts) + 2 * n, np.uint64)
    text_at = word_at + 2 * np.arange(n + 1)
    own = np.ones(len(hashes), bool)
    own[text_at[:-1]] = own[text_at[1:] - 1] = False
    hashes[own] = kernels.word_hashes(norm, starts, ends)
    hashes[text_at[:-1]], hashes[text_at[1:] - 1] = BEGIN, END
    del norm, starts, ends, own
    words, tokens = _numbered(hashes)
    del hashes
    size = np.int64(len(words))
    counted = np.repeat(learn, np.diff(text_at))
    told = [np.bincount(tokens, counted, len(words)).astype(np.int32)]
    # A pair ends at each token but the begins, a triple where a pair also ends at the token before.
    ends_pair = np.ones(len(tokens), bool)
    ends_pair[text_at[:-1]] = False
    second = np.flatnonzero(ends_pair).astype(np.int32)
    pair, at_pair = _numbered(tokens[second - 1] * size + tokens[second])
    hash2 = _joined(words[pair // size], words[pair % size])
    key2, told2, of_pair = _distinct(hash2, np.bincount(at_pair, counted[second], len(pair)))
    pair_at = np.full(len(tokens), -1, np.int32)
    pair_at[second] = at_pair
    third = second[ends_pair[second - 1]]
    del second, at_pair, ends_pair
    triple, at_triple = _numbered(pair_at[third - 1] * size + tokens[third])
    triple_end = np.empty(len(triple), np.int32)
    triple_end[at_triple] = pair_at[third]
    told3 = np.bincount(at_triple, counted[third], len(triple))
    del pair_at, third, at_triple, counted
    key3, told3, of_triple = _distinct(_joined(hash2[triple // size] + U64(1), words[triple % size]), told3)
    return Grams(tokens, text_at, words, [words, key2, key3], [*told, told2, told3], pair, of_pair, triple, of_triple, triple_end)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of hashes, so that a part's sorted keys are near each other."""
    return (((keys >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)


def key_bits(blocks: int) -> int:
    """Bits of an n-gram's hash, for a corpus of so many blocks."""
    return min(64, SPARE_BITS + max(1, blocks * BLOCK_BYTES // 4).bit_length())


def _short(keys: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Whole hashes of words, the first bits of those of n-grams."""
    return keys if k == 0 else keys >> U64(64 - bits)


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(_part(keys, parts), np.arange(parts + 1))


def _pressed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of 64-bit values as byte planes, compressed."""
    flat = np.concatenate([np.array([len(a) for a in arrays], np.uint64), *(a.view(np.uint64) for a in arrays)])
    raw = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(flat).to_bytes(8, "little") + _LEVEL.compress(raw, asbytes=True)


def _unpressed(data: bytes, count: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(_LEVEL.decompress(data[8:], n * 8, asbytes=True), np.uint8).reshape(8, n)
    flat = np.ascontiguousarray(raw.T).view(np.uint64).ravel()
    return np.split(flat[count:], np.cumsum(flat[: count - 1].astype(np.int64)))


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=U64(0)) if len(keys) else keys


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, part, data): ``BLOCK_BYTES`` of rows (doc_id, learn, text) each as one compressed stream, in pieces."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    options = pa.ipc.IpcWriteOptions(compression=_LEVEL)
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=options) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())
        whole = sink.getvalue().to_pybytes()
        pieces = [whole[at : at + PIECE_BYTES] for at in range(0, len(whole), PIECE_BYTES)]
        part = FIRST + np.arange(len(pieces), dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pieces), number)), pa.array(part, pa.int32()), pa.array(pieces, pa.binary())], ["block", "part", "data"])

    for batch in batches:
        _, offsets = kernels.text_buffer(batch.column(2))
        for lo, hi in kernels.doc_chunks(offsets, BLOCK_BYTES):
            if size and size + offsets[hi] - offsets[lo] > BLOCK_BYTES:
                yield flush()
                held.clear()
                number, size = number + 1, 0
            held.append(batch.slice(lo, hi - lo))
            size += int(offsets[hi] - offsets[lo])
    if held:
        yield flush()
    held.clear()
    kernels.release()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The blocks of a task, whose pieces follow each other."""
    block, pieces = None, []
    for batch in batches:
        for number, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if number != block and pieces:
                yield block, _opened(b"".join(pieces))
                pieces = []
            block = number
            pieces.append(piece)
    if pieces:
        yield block, _opened(b"".join(pieces))


def _opened(data) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all().combine_chunks()


def _grams_of_block(table: pa.Table) -> Grams:
    return grams_of(table.column(2), table.column(1).to_numpy(zero_copy_only=False))


def _questions(parts: int, bits: int):
    """(part, block, data): the sorted n-grams of each block and what it tells of them; every part is asked, as its numbers are needed, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in _whole(batches):
            grams = _grams_of_block(table)
            cuts = [_cuts(keys, parts) for keys in grams.keys]
            rows = []
            for p in range(parts):
                own = []
                for k, (keys, told, c) in enumerate(zip(grams.keys, grams.told, cuts, strict=True)):
                    own += [_steps(_short(keys[c[p] : c[p + 1]], k, bits)), told[c[p] : c[p + 1]].astype(np.int64)]
                rows.append(_pressed(own))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), pa.array(np.full(parts, block)), pa.array(rows, pa.binary())], ["part", "block", "data"])
            del grams, rows, table
            kernels.release()

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Sums what the blocks tell of one range, and answers each in the order it asked, with the part's numbers."""
    asked = [_unpressed(d.as_buffer().to_pybytes(), 6) for d in table.column("data")]
    replies: list[list[np.ndarray]] = [[] for _ in asked]
    stats = dict.fromkeys(STATS, 0)
    for k in range(3):
        sizes = np.array([len(a[2 * k]) for a in asked])
        keys = np.concatenate([np.cumsum(a[2 * k], dtype=np.uint64) for a in asked])
        distinct, place = np.unique(keys, return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        np.add.at(counts, place, np.concatenate([a[2 * k + 1] for a in asked]).view(np.int64))
        word = distinct != BEGIN if k == 0 else np.ones(len(distinct), bool)
        stats[f"once{k + 1}"] = int((counts[word] == 1).sum())
        if k == 0:
            stats |= {"tokens": int(counts[word].sum()), "words": int((counts[word] > 0).sum()), "texts": int(counts[~word].sum())}
        for reply, part in zip(replies, np.split(counts[place], np.cumsum(sizes)[:-1]), strict=True):
            reply.append(part)
    own = np.array([stats[s] for s in STATS], np.int64)
    out = pa.Table.from_arrays([table.column("block"), table.column("part"), pa.array([_pressed([*r, own]) for r in replies], pa.binary())], ["block", "part", "data"])
    if table.nbytes > blobs.TIDY_BYTES:
        del asked, replies
        kernels.release()
    return out


class Model(NamedTuple):
    """Numbers of the whole corpus."""

    tokens: int
    words: int
    gamma2: float
    gamma3: float


def _gamma(once: int, shorter: int, total: int) -> float:
    """Of the tokens whose context is met again, the share whose n-gram is not."""
    if total - shorter <= 0:
        return BLIND_GAMMA
    return min(max((once - shorter) / (total - shorter), LEAST_GAMMA), MOST_GAMMA)


def model_of(tokens: int, words: int, texts: int, once1: int, once2: int, once3: int) -> Model:
    return Model(tokens, words, _gamma(once2, once1, tokens), _gamma(once3, once2, tokens - texts))


def _weight(p) -> np.ndarray:
    return np.rint(np.log10(p) * UNIT).astype(np.int64)


class Automaton:
    """States: 0 has no context, 1 + w is word w, 1 + words + b is the pair b.

    ``word_arc``, ``pair_arc`` and ``triple_arc`` are weights of arcs from the
    three kinds of states, the latter two 1 where there is no arc.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], model: Model) -> None:
        n = self.n = np.int64(len(grams.words))
        c1, c2, c3 = counts[0], counts[1][grams.of_pair], counts[2][grams.of_triple]
        p1 = (c1 + 1) / (model.tokens + model.words + 1)
        ctx2 = c1[grams.pair // n]
        p2 = (1 - model.gamma2) * (c2 / np.maximum(ctx2, 1)) + model.gamma2 * p1[grams.pair % n]
        ctx3 = c2[grams.triple // n]
        p3 = (1 - model.gamma3) * (c3 / np.maximum(ctx3, 1)) + model.gamma3 * p2[grams.triple_end]
        self.pair, self.triple, self.triple_end = grams.pair, grams.triple, grams.triple_end
        self.begin = int(np.searchsorted(grams.words, BEGIN))
        self.word_arc, self.pair_arc, self.triple_arc = _weight(p1), np.where(c2 > 0, _weight(p2), 1), np.where(c3 > 0, _weight(p3), 1)
        self.known, self.pair_last = c1 > 0, (grams.pair % n).astype(np.int32)
        self.fail2, self.fail3 = int(_weight(model.gamma2)), int(_weight(model.gamma3))

    @staticmethod
    def _arcs(keys: np.ndarray, weights: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each wanted key, and whether there is an arc."""
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return place, (keys[place] == wanted) & (weights[place] <= 0)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after reading a word in each of many states, and the weights of the way there."""
        n, weight, state = self.n, np.zeros(len(word), np.int64), state.copy()
        open_ = word != self.begin
        at = np.flatnonzero(open_ & (state > n))
        place, hit = self._arcs(self.triple, self.triple_arc, (state[at] - 1 - n) * n + word[at])
        go, stay = at[hit], at[~hit]
        weight[go], open_[go] = self.triple_arc[place[hit]], False
        target = 1 + n + self.triple_end[place[hit]]
        weight[stay] += self.fail3
        state[stay] = 1 + self.pair_last[state[stay] - 1 - n]
        state[go] = target
        at = np.flatnonzero(open_ & (state > 0))
        place, hit = self._arcs(self.pair, self.pair_arc, (state[at] - 1) * n + word[at])
        go, stay = at[hit], at[~hit]
        weight[go] += self.pair_arc[place[hit]]
        weight[stay] += self.fail2
        state[go], state[stay], open_[go] = 1 + n + place[hit], 0, False
        at = np.flatnonzero(open_)
        weight[at] += self.word_arc[word[at]]
        state[at] = np.where(self.known[word[at]], 1 + word[at], 0)
        begin = np.flatnonzero(word == self.begin)
        state[begin] = 1 + self.begin if self.known[self.begin] else 0
        return state, weight

    def traverse(self, tokens: np.ndarray) -> np.ndarray:
        """The weight of reading each token, from left to right."""
        steps = -(-len(tokens) // LANES)
        lanes = -(-len(tokens) // steps)
        padded = np.full(lanes * steps, self.begin, np.int32)
        padded[: len(tokens)] = tokens
        rows = padded.reshape(lanes, steps).T
        state = np.zeros(lanes, np.int64)
        starts = np.arange(lanes) * steps
        for back in (2, 1):
            at = np.flatnonzero(starts >= back)
            state[at], _ = self.step(state[at], padded[starts[at] - back])
        out = np.empty((lanes, steps), np.int64)
        for i in range(steps):
            state, out[:, i] = self.step(state, rows[i])
        return out.ravel()[: len(tokens)]


def _scores(table: pa.Table) -> pa.Table:
    """The rows of a block with their scores, from its pieces and all parts' answers."""
    table = table.sort_by("part")
    data = table.column("data")
    pieces = int((table.column("part").to_numpy() < 0).sum())
    rows = _opened(b"".join(data.slice(0, pieces).to_pylist()))
    grams = _grams_of_block(rows)
    replies = [_unpressed(d.as_buffer().to_pybytes(), 4) for d in data.slice(pieces)]
    counts = [np.concatenate([r[k] for r in replies]).view(np.int64) for k in range(3)]
    model = model_of(*(int(n) for n in sum(r[3] for r in replies)))
    del replies
    machine = Automaton(grams, counts, model)
    first, end = grams.text_at[:-1], grams.text_at[1:]

    def span(x: np.ndarray) -> np.ndarray:
        """Sums over each text's tokens but its begin."""
        total = np.append(0, np.cumsum(x))
        return total[end] - total[first + 1]

    score = span(machine.traverse(grams.tokens)) / UNIT
    base = span(machine.word_arc[grams.tokens]) / UNIT
    known = span(machine.known[grams.tokens].astype(np.int64))
    held = ~rows.column(1).to_numpy(zero_copy_only=False)
    out = pa.Table.from_arrays([rows.column(0), pa.array(held), pa.array(end - first - 1), pa.array(known), pa.array(np.full(len(first), model.tokens)), pa.array(base), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    del grams, machine
    kernels.release()
    return out


def score(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """Per row: whether it is held out, its tokens, those known, the model's size, and two log10 probabilities.

    ``held`` tells the rows that the model does not learn from; without it,
    those of ``held_out``.  ``base_score`` is the product of p1, ``score`` that
    of the automaton.  A null or empty text is the end token alone; a text of
    any length is one stretch of its block; repeated rows each count and get
    equal scores; further columns are not used.  An empty table stays empty,
    and where nothing is learned from, all words are equally unlikely.
    """
    spark = prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    learn = ~F.coalesce(held_out(F.col("doc_id")) if held is None else held, F.lit(True))
    own = docs.select("doc_id", learn.alias("learn"), F.col("text").cast("string").alias("text"))
    blocks = cut_lineage(own.mapInArrow(_blocks, "block bigint, part int, data binary"))
    ask = _questions(blobs.part_count(spark), key_bits(blocks.filter(F.col("part") == FIRST).count()))
    asked = blocks.mapInArrow(ask, "part int, block bigint, data binary")
    answers = asked.groupBy("part").applyInArrow(_answer, "block bigint, part int, data binary")
    both = blocks.unionByName(answers)
    return both.groupBy("block").applyInArrow(_scores, f"doc_id {id_type}, {RESULT}")


_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))"
_GAMMA = "CASE WHEN {2} - {1} <= 0 THEN {3} ELSE least(greatest(({0} - {1})::DOUBLE / ({2} - {1})::DOUBLE, {4}), {5}) END"
#: The model by counts of n-grams; texts are token lists between ' <' and ' >', which no word is.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_CRC} % {FOLDS} = {HELD_FOLD}, true) AS held,
  list_concat([' <'], regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), [' >']) AS w FROM documents),
t AS (SELECT r, held, i, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a FROM (SELECT r, held, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
c1 AS (SELECT c, count(*) AS n FROM t WHERE NOT held GROUP BY c),
c2 AS (SELECT b, c, count(*) AS n FROM t WHERE NOT held AND i > 1 GROUP BY b, c),
c3 AS (SELECT a, b, c, count(*) AS n FROM t WHERE NOT held AND i > 2 GROUP BY a, b, c),
o AS (SELECT (SELECT coalesce(sum(n), 0)::BIGINT FROM c1 WHERE c <> ' <') AS tokens, (SELECT count(*) FROM c1 WHERE c <> ' <') AS words, (SELECT coalesce(sum(n), 0)::BIGINT FROM c1 WHERE c = ' <') AS texts,
  (SELECT count(*) FROM c1 WHERE n = 1 AND c <> ' <') AS o1, (SELECT count(*) FROM c2 WHERE n = 1) AS o2, (SELECT count(*) FROM c3 WHERE n = 1) AS o3),
m AS (SELECT tokens, words, {_GAMMA.format("o2", "o1", "tokens", f"{BLIND_GAMMA}::DOUBLE", f"{LEAST_GAMMA}::DOUBLE", f"{MOST_GAMMA}::DOUBLE")} AS g2, {_GAMMA.format("o3", "o2", "(tokens - texts)", f"{BLIND_GAMMA}::DOUBLE", f"{LEAST_GAMMA}::DOUBLE", f"{MOST_GAMMA}::DOUBLE")} AS g3 FROM o),
x AS (SELECT t.r, coalesce(n1.n, 0) AS x1, coalesce(h1.n, 0) AS h2, coalesce(n2.n, 0) AS x2, coalesce(h2.n, 0) AS h3, coalesce(n3.n, 0) AS x3, g2, g3, (coalesce(n1.n, 0) + 1)::DOUBLE / (tokens + words + 1)::DOUBLE AS p1
  FROM t CROSS JOIN m LEFT JOIN c1 n1 ON n1.c = t.c LEFT JOIN c1 h1 ON h1.c = t.b LEFT JOIN c2 n2 ON n2.b = t.b AND n2.c = t.c LEFT JOIN c2 h2 ON h2.b = t.a AND h2.c = t.b LEFT JOIN c3 n3 ON n3.a = t.a AND n3.b = t.b AND n3.c = t.c WHERE i > 1),
y AS (SELECT *, (1 - g2) * (x2::DOUBLE / greatest(h2, 1)::DOUBLE) + g2 * p1 AS p2 FROM x),
z AS (SELECT *, (1 - g3) * (x3::DOUBLE / greatest(h3, 1)::DOUBLE) + g3 * p2 AS p3 FROM y),
u AS (SELECT r, x1, round(log10(p1) * {UNIT})::BIGINT AS l1, round(log10(p2) * {UNIT})::BIGINT AS l2, round(log10(p3) * {UNIT})::BIGINT AS l3, CASE WHEN h2 > 0 THEN round(log10(g2) * {UNIT})::BIGINT ELSE 0 END AS f2, CASE WHEN h3 > 0 THEN round(log10(g3) * {UNIT})::BIGINT ELSE 0 END AS f3, x2, x3 FROM z),
s AS (SELECT r, count(*) AS n_tokens, count_if(x1 > 0)::BIGINT AS n_known, sum(l1)::BIGINT AS base, sum(CASE WHEN x3 > 0 THEN l3 WHEN x2 > 0 THEN f3 + l2 ELSE f3 + f2 + l1 END)::BIGINT AS score FROM u GROUP BY r)
SELECT doc_id, held AS held_out, n_tokens, n_known, (SELECT tokens FROM m) AS train_tokens, base::DOUBLE / {UNIT} AS base_score, score::DOUBLE / {UNIT} AS score FROM d JOIN s USING (r)
"""
