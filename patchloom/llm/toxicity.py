"""Toxicity by a weighted finite-state grammar over clauses.

Small transducers read a clause's tokens: insult, target, negation, reported
speech, and two for threats, whether one was just met and whether a word that
can be its object was.  Their composition, one machine over tuples of states,
puts out each insult or threat as negated, reported or open.  A threat is one if
its target follows before ``REACH`` words in a row that are of no class, or an
object comes so shortly before it; else it is bare and matches nothing.  The state at the clause's end decides
what open insults were: with a target anywhere in the clause they are aimed,
without it plain.  Commas and colons end a clause but not the report that it is
in, so what is quoted after them is reported still; other marks end both.  A
document's score is a calibrated function of what its clauses have put out, not
of isolated words.

The insult lexicon (words, and stems of words) is learned from a bounded sample
of labelled rows, starting from ``SEED_INSULTS``; so are the final weights.  The
sample's words are counted where the texts are; the driver gets the counts of
words with evidence and a row of features for each sampled document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm import kernels
from patchloom.llm.labelled import SAMPLE_ROWS, held_out, training_rows
from patchloom.llm.session import cut_lineage, free_name, prepare, schema_of, with_names

# Closed word classes of the grammar, in the languages of the corpus.
SEED_INSULTS = ["idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "scum", "loser", "trash", "clown"]
THREATS = ["kill", "hurt", "destroy", "beat", "burn", "shoot", "stab", "töten", "umbringen", "verletzen", "tuer", "frapper", "matar", "golpear"]
TARGETS = ["you", "your", "they", "them", "their", "he", "she", "him", "her", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "ton", "tú", "te", "usted", "ellos"]
OBJECTS = ["dich", "euch", "te", "toi", "vous", "les", "los"]
NEGATIONS = ["not", "never", "no", "isn't", "aren't", "nicht", "kein", "keine", "nie", "pas", "jamais", "ne", "nunca"]
REPORTS = ["said", "says", "wrote", "called", "quoted", "claimed", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió"]

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, OBJECT, GAP = range(8)
#: So many words of no class in a row are a gap, which parts a threat from what follows.
REACH = 3
STEMS = (4, 5, 6, 7)
LEAST_TOXIC = 3
EVIDENCE = 3.0
TEXT_BYTES = 2 << 20

WORD_BYTES = np.zeros(256, np.uint8)
for _b in [0x27, *range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORD_BYTES[_b] = _b
WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
#: Marks that end a clause, and those that also end a report.
CLAUSE_ENDS, REPORT_ENDS = np.zeros(256, bool), np.zeros(256, bool)
CLAUSE_ENDS[[ord(c) for c in ".,;:!?\n"]] = True
REPORT_ENDS[[ord(c) for c in ".;!?\n"]] = True

#: State changes of each transducer: (state, category) -> state.  What is not listed stays.
TRANSDUCERS = {
    "insult": {(0, INSULT): 1, (1, INSULT): 1},
    "target": {(0, TARGET): 1, (0, OBJECT): 1},
    "negation": {(0, NEGATION): 1, (1, NEGATION): 0},
    "report": {(0, REPORT): 1, (1, REPORT): 1},
    "threat": {(0, THREAT): 1, (1, GAP): 0, (1, TARGET): 0, (1, OBJECT): 0},
    "object": {(0, OBJECT): 1, (1, GAP): 0},
}
PLAIN, AIMED, NEGATED, REPORTED, THREATS_OUT, BARE = range(6)
OPEN_INSULT, OPEN_THREAT, MET = 6, 7, 8
#: Columns of a text's scores after the outputs.
CLAUSES, DISTINCT, BEST, WORDS = 6, 7, 8, 9


def compose() -> tuple[dict[tuple, tuple], dict[tuple, int], dict[tuple, tuple]]:
    """The composed machine: (states, category) -> (states, output or None), what final states make of open insults, and the states after a soft end."""
    names, moves, ends, soft = list(TRANSDUCERS), {}, {}, {}
    for states in product((0, 1), repeat=len(names)):
        of = dict(zip(names, states, strict=True))
        ends[states] = AIMED if of["target"] else PLAIN
        soft[states] = tuple(s if n == "report" else 0 for n, s in of.items())
        for category in range(1, GAP + 1):
            after = tuple(TRANSDUCERS[n].get((s, category), s) for n, s in zip(names, states, strict=True))
            put = None
            if category in (INSULT, THREAT):
                kind = OPEN_INSULT if category == INSULT else THREATS_OUT if of["object"] else OPEN_THREAT
                put = REPORTED if of["report"] else NEGATED if of["negation"] else kind
            elif of["threat"] and category in (TARGET, OBJECT):
                put = MET
            moves[states, category] = (after, put)
    return moves, ends, soft


MACHINE, FINAL, SOFT = compose()
START = (0,) * len(TRANSDUCERS)


def _hash(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).lower().encode(), np.uint8)
    norm = np.where(raw == 32, 0, raw).astype(np.uint8)
    starts, ends, _ = kernels.word_spans(norm, np.array([0, len(norm)]))
    return kernels.word_hashes(norm, starts, ends)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, word offsets and, for the whole word and each stem length, hashes."""
    norm = WORD_BYTES[data]
    starts, ends, word_at = kernels.word_spans(norm, offsets)
    keys = [kernels.word_hashes(norm, starts, ends)]
    for k in STEMS:
        long = ends - starts > k
        stem = np.zeros(len(starts), np.uint64)
        stem[long] = kernels.word_hashes(norm, starts[long], starts[long] + k) ^ np.uint64(k)
        keys.append(stem)
    return starts, word_at, np.stack(keys) if len(starts) else np.empty((len(STEMS) + 1, 0), np.uint64)


class Lexicon:
    """Category and weight by hash; ``learned`` maps hashes of words and stems to insult weights."""

    def __init__(self, learned: dict[int, float]) -> None:
        entries = {int(h): (INSULT, w) for h, w in learned.items()}
        for words, category in ((THREATS, THREAT), (TARGETS, TARGET), (OBJECTS, OBJECT), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
            entries |= {int(h): (category, 1.0) for h in _hash(words)}
        self.hashes = np.array(sorted(entries), np.uint64)
        self.category = np.array([entries[int(h)][0] for h in self.hashes], np.int8)
        self.weight = np.array([entries[int(h)][1] for h in self.hashes])
        self.bits = np.zeros(1 << 16, bool)
        self.bits[self.hashes >> np.uint64(48)] = True

    def match(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        category, weight = np.zeros(keys.shape[1], np.int8), np.zeros(keys.shape[1])
        for row in keys:
            at = np.flatnonzero(self.bits[row >> np.uint64(48)])
            place = np.minimum(np.searchsorted(self.hashes, row[at]), len(self.hashes) - 1)
            hit = self.hashes[place] == row[at]
            at, place = at[hit], place[hit]
            better = self.weight[place] > weight[at]
            at, place = at[better], place[better]
            category[at], weight[at] = self.category[place], self.weight[place]
        return category, weight


def clause_scores(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Per text: summed outputs of the machine by kind, matched clauses, distinct insults, the best clause, words."""
    starts, word_at, keys = tokens(data, offsets)
    category, weight = lexicon.match(keys)
    out = np.zeros((len(offsets) - 1, WORDS + 1))
    out[:, WORDS] = np.diff(word_at)
    marked = np.flatnonzero(category)
    if not len(marked):
        return out
    row = np.searchsorted(word_at, marked, "right") - 1
    other = row[1:] != row[:-1]
    clause, report = (np.cumsum(marks[data])[starts[marked]] for marks in (CLAUSE_ENDS, REPORT_ENDS))
    last = np.append((clause[1:] != clause[:-1]) | other, True)
    hard = np.append((report[1:] != report[:-1]) | other, True)
    gap = np.append(False, np.diff(marked) > REACH)
    states, put_out = START, np.zeros(MET)
    seen: dict[int, set] = {}
    for i, r, end, ends_report, after_gap, kind, w in zip(marked.tolist(), row.tolist(), last.tolist(), hard.tolist(), gap.tolist(), category[marked].tolist(), weight[marked].tolist(), strict=True):
        if after_gap:
            # Threats that were waiting for their target are bare.
            states = MACHINE[states, GAP][0]
            put_out[BARE] += put_out[OPEN_THREAT]
            put_out[OPEN_THREAT] = 0
        states, put = MACHINE[states, kind]
        if put == MET:
            put_out[THREATS_OUT] += put_out[OPEN_THREAT]
            put_out[OPEN_THREAT] = 0
        elif put is not None:
            put_out[put] += w
            if kind == INSULT:
                seen.setdefault(r, set()).add(int(keys[0, i]))
        if end:
            put_out[FINAL[states]] += put_out[OPEN_INSULT]
            put_out[BARE] += put_out[OPEN_THREAT]
            best = put_out[:BARE].sum()
            out[r, :CLAUSES] += put_out[:CLAUSES]
            out[r, CLAUSES] += best > 0
            out[r, BEST] = max(out[r, BEST], best)
            states = START if ends_report else SOFT[states]
            put_out[:] = 0
    for r, words in seen.items():
        out[r, DISTINCT] = len(words)
    return out


def features(scores: np.ndarray) -> np.ndarray:
    total = scores[:, :BARE].sum(1)
    clauses, distinct = scores[:, CLAUSES], scores[:, DISTINCT]
    return np.column_stack([np.log1p(scores[:, :CLAUSES]), np.log1p(total), np.minimum(clauses, 4), np.minimum(distinct, 4), clauses >= 2, distinct >= 2, np.log1p(scores[:, BEST])])


def _each(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = kernels.text_buffer(pc.utf8_lower(texts))
    for lo, hi in kernels.doc_chunks(offsets, TEXT_BYTES):
        yield data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text a key that near copies share, its label and its distinct words and stems."""
    for batch in batches:
        label, at = batch.column(1).to_pylist(), 0
        for data, offsets in _each(batch.column(0)):
            _, word_at, keys = tokens(data, offsets)
            windows = kernels.window_hashes(keys[0], 3)
            near, words = [], []
            for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
                own = np.unique(keys[:, a:b])
                near.append(int(windows[a : b - 2].min() if b - a > 2 else kernels.mix(np.array([own.sum()], np.uint64))[0]) - (1 << 63))
                words.append(own[own > 0].tobytes())
            n = len(near)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64()), pa.array(label[at : at + n], pa.int32()), pa.array(words, pa.binary())], ["near", "label", "words"])
            at += n


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = np.array(batch.column(1).to_pylist(), np.int64)
        words = [np.frombuffer(w.as_buffer(), np.uint64) for w in batch.column(2)]
        toxic = np.repeat(label, [len(w) for w in words])
        word, place = np.unique(np.concatenate([np.empty(0, np.uint64), *words]), return_inverse=True)
        got = [np.bincount(place, weights=w, minlength=len(word)).astype(np.int64) for w in (toxic, 1 - toxic)]
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(got[0]), pa.array(got[1])], ["word", "toxic", "clean"])


def learn_lexicon(sample: DataFrame) -> dict[int, float]:
    """Log odds of the words and stems that are evidence beyond chance, of rows of ``text`` and ``label``; near copies of a text count once."""
    learned = {int(h): 2.0 for h in _hash(SEED_INSULTS)}
    keyed = sample.select("text", "label").mapInArrow(_keyed, "near bigint, label int, words binary")
    once = cut_lineage(keyed.groupBy("near").agg(F.min_by(F.struct("label", "words"), F.struct("label", "words")).alias("x")).select("near", "x.label", "x.words"))
    totals = {r["label"]: r["n"] for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return learned
    base = totals[1] / sum(totals.values())
    counts = once.mapInArrow(_count_words, "word bigint, toxic bigint, clean bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= LEAST_TOXIC)
    rows = counts.collect()
    need = EVIDENCE + np.log(max(1, len(rows)))
    for r in rows:
        t, n = r["toxic"], r["clean"]
        share = t / (t + n)
        if share > 0.7:
            evidence = t * np.log(share / base) + (n * np.log((1 - share) / (1 - base)) if n else 0)
            if evidence > need:
                learned[r["word"] % 2**64] = float(np.log((t + 0.5) / (n + 0.5)) - np.log(base / (1 - base)))
    return learned


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton steps for ridge logistic regression; the last coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * len(x) / 100 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * len(x) / 100 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _featured(lexicon: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Lexicon(lexicon)
        for batch in batches:
            x = [features(clause_scores(d, o, ready)) for d, o in _each(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for part in x for r in part], pa.binary()), batch.column(1)], ["x", "label"])

    return run


def fit(sample: DataFrame) -> tuple[dict[int, float], np.ndarray]:
    """The learned lexicon and the final weights, from rows of ``text`` and ``label``; repeated texts count once."""
    sample = cut_lineage(sample.select("text", "label").distinct())
    lexicon = learn_lexicon(sample)
    frame = sample.mapInArrow(_featured(lexicon), "x binary, label int").toPandas().sort_values(["x", "label"], ignore_index=True)
    label = frame["label"].to_numpy().astype(int)
    if not len(label) or label.min() == label.max():
        width = features(np.zeros((1, WORDS + 1))).shape[1]
        return lexicon, np.array([0.0] * CLAUSES + [2.0] + [0.0] * (width - CLAUSES - 1) + [-3.0])
    return lexicon, fit_logistic(np.stack([np.frombuffer(x) for x in frame["x"]]), label)


def _score(lexicon: dict[int, float], weights: np.ndarray, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Lexicon(lexicon)
        for batch in batches:
            got = [np.empty(0)]
            for data, offsets in _each(batch.column(text_at)):
                x = features(clause_scores(data, offsets, ready))
                got.append(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got))], [*batch.schema.names, "score"])
        kernels.release()

    return run


def scored(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, column: str = "toxicity") -> DataFrame:
    """The rows of ``docs``, all columns, and the probability as ``column``, with underscores after it if ``docs`` has that name.

    Labels are learned from at most ``rows`` rows outside the held-out fold;
    only texts are scored, whole.  Null and empty texts match no clause.
    Without labels of both kinds, the seed lexicon and fixed weights are used.
    Repeated rows score alike; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    lexicon, weights = fit(training_rows(docs, labels, "toxic", rows))
    name = free_name(docs.columns, column)
    plain = lambda d: d.mapInArrow(_score(lexicon, weights, d.columns.index("text")), f"{schema_of(d)}, score double")
    return with_names(docs, ["text"], plain).toDF(*docs.columns, name)


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row.

    Nulls, empty and very long texts, repeated rows, missing labels and an empty
    table are as in ``scored``; a null ``doc_id`` is held out; other columns are
    not read.
    """
    found = scored(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels, rows, "score")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, that score under ``threshold``.

    Null and empty texts stay; repeated rows stay or go together; an empty
    table stays empty.  Scores are those of ``scored``.
    """
    found = scored(docs, labels, rows)
    name = found.columns[-1]
    return found.filter(F.col(f"`{name}`") < threshold).drop(F.col(f"`{name}`"))
