"""Very long texts, hot groups, clashing column names, and plain-Python twins of the two classifiers' scores."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm import decontamination, kernels, license_scan, line_dedup, ngram_join, packing, quality, suffix_dedup, toxicity
from patchloom.llm.queries import tokenizer_path
from tests_llm_tables import brute_components, brute_lines

DOCS = "doc_id bigint, text string"


def words(draw, n, size=5):
    return [bytes(draw.choices(b"abcdefghijklmnopqrstuvwxyz", k=size)).decode() for _ in range(n)]


def brute_strings(rows, k=50):
    """Bytes covered by a string of k bytes that also starts in a smaller document."""
    first = {}
    raw = {i: (t or "").encode() for i, t in rows}
    for i, b in raw.items():
        for p in range(len(b) - k + 1):
            s = b[p : p + k]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - k + 1):
            if first[b[p : p + k]] < i:
                gone[p : p + k] = b"\1" * k
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_with_heavy_triggers(spark):
    """A hundred documents share a passage, with other text right beside it; some share that, too."""
    draw = random.Random(3)
    passage = "the passage that all of these documents share, word by word, as it was written first"
    beside = [" ".join(words(draw, 6)) for _ in range(5)]
    rows = [(i, " ".join(words(draw, 20)) + draw.choice(beside) + passage + draw.choice(beside) + " ".join(words(draw, 20))) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    texts, _ = suffix_dedup.keyed_texts(docs)
    assert len(suffix_dedup.heavy_triggers(texts)) > 0
    assert {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.report(docs).collect()} == brute_strings(rows)


def test_suffix_dedup_of_repeated_ids(spark):
    """Texts of one id are no smaller than each other, whatever their tags."""
    draw = random.Random(4)
    common = " ".join(words(draw, 40))
    rows = [(1, f"{common} x"), (1, f"y {common}"), (1, f"y {common}"), (2, f"z {common}"), (None, common[:60])]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.report(spark.createDataFrame(rows, DOCS).repartition(3)).collect())
    assert got == [(0, 0), (1, 60), (1, 60), (1, 60), (2, len(common) + 1)]


def test_suffix_dedup_of_long_texts(spark):
    """Texts beyond two segments: what is removed is what was taken over, also across a segment's end."""
    draw = random.Random(5)
    long = bytes(draw.choices(b"abcdefghijklmnopqrstuvwxyz ", k=2_300_000)).decode()
    fresh = [bytes(draw.choices(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=1000)).decode() for _ in range(4)]
    taken = [(100, 400), (1_048_500, 1_048_700), (2_299_000, 2_300_000)]
    parts = [fresh[0], *(x for f, (lo, hi) in zip(fresh[1:], taken, strict=True) for x in (long[lo:hi], f))]
    got = {r["doc_id"]: r for r in suffix_dedup.report(spark.createDataFrame([(1, long), (2, "".join(parts))], DOCS)).collect()}
    assert (got[1]["n_removed"], got[2]["n_removed"], got[2]["n_spans"]) == (0, 1500, 3)
    assert got[2]["kept_sha256"] == hashlib.sha256("".join(fresh).encode()).hexdigest()


def test_long_texts_elsewhere(spark):
    draw = random.Random(6)
    tokens = words(draw, 600_000)
    long = " ".join(tokens)
    near = " ".join([*tokens[:-1000], *words(draw, 1000)])
    rows = [(1, long), (2, near), (3, "\n".join(tokens[:90_000])), (4, "\n".join(tokens[50_000:90_000]))]
    docs = spark.createDataFrame(rows, DOCS).repartition(2).cache()
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.components(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.line_report(docs).collect()} == {1: (1, 0), 2: (1, 0), 3: (90_000, 0), 4: (40_000, 40_000)}
    bench = spark.createDataFrame([("a", " ".join(tokens[300_000:300_012])), ("b", " ".join(tokens[599_995:]))], "item_id string, text string")
    for block in (decontamination.BLOCK_BYTES, 1):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in decontamination.contamination(docs, bench, block_bytes=block).collect()}
        assert got == {1: (600_000, 17, 2), 2: (600_000, 12, 1), 3: (90_000, 0, 0), 4: (40_000, 0, 0)}
    pieces = packing.pack(docs.filter("doc_id > 2"), tokenizer_path()).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of")).collect()
    assert len(pieces) == 2 and all(r["n"] == r["of"] > 40_000 for r in pieces)


def test_join_in_small_cells(spark, monkeypatch):
    """A family of near copies whose blocks are cut into many cells, against brute force."""
    monkeypatch.setattr(ngram_join, "CELL", 4)
    draw = random.Random(7)
    base = words(draw, 120)
    rows = []
    for i in range(70):
        own, at = list(base), draw.randrange(100)
        own[at : at + draw.choice([1, 2, 8, 14, 18])] = words(draw, draw.choice([1, 2, 8, 14, 18]))
        rows.append((i, " ".join(own)))
    assert {r["doc_id"]: tuple(r)[1:] for r in ngram_join.components(spark.createDataFrame(rows, DOCS).repartition(3)).collect()} == brute_components(rows)


def test_clashing_names(spark):
    """Columns named like the operators' own, in other case or with underscores, pass unchanged."""
    names = ["doc_id", "text", "later", "__later", "Lines", "removed", "d", "t", "toxicity", "__toxicity", "score", "quality", "c0", "n_words", "spans", "items", "key"]
    rows = [(i, "a line\nof some text\nthat repeats\n" * 2 + str(i), *(f"{n}{i}" for n in names[2:])) for i in range(5)]
    docs = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(5)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([("x", "of no use here")], "item_id string, text string")
    rest = sorted(tuple(r) for r in docs.drop("text").collect())
    for out in (line_dedup.remove_repeated_windows(docs), toxicity.reject(docs, labels, 2.0), ngram_join.keep_first(docs), decontamination.remove_documents(docs, bench), decontamination.remove_documents(docs, bench, block_bytes=1)):
        assert out.columns == names
        assert set(tuple(r) for r in out.drop("text").collect()) <= set(rest) and out.count() >= 1
    for out, name in ((toxicity.scored(docs, labels), "toxicity_"), (quality.scored(docs, labels), "quality_")):
        assert out.columns == [*names, name] and sorted(tuple(r)[:1] + tuple(r)[2:-1] for r in out.collect()) == rest


WORD = re.compile("[0-9a-z'\x80-\U0010ffff]+")


def plain_clauses(text, lexicon):
    """The grammar read word by word: (plain, aimed, negated, reported, threats, bare), matched clauses, distinct insults, best clause, words."""
    closed = [(toxicity.THREATS, "threat"), (toxicity.TARGETS, "target"), (toxicity.OBJECTS, "object"), (toxicity.NEGATIONS, "not"), (toxicity.REPORTS, "report")]
    kinds = {w: k for words_, k in closed for w in words_}
    total, clauses, insults, best, n = [0.0] * 6, 0, set(), 0.0, 0
    for sentence in re.split("[.;!?\n]", text.lower()):
        reported = False
        for clause in re.split("[,:]", sentence):
            target = negated = waiting = object_near = False
            out, insult, threat, unmarked = [0.0] * 6, 0.0, 0.0, 0
            for w in WORD.findall(clause):
                n += 1
                kind, weight = ("insult", lexicon[w]) if w in lexicon else (kinds.get(w), 1.0)
                if kind is None:
                    unmarked += 1
                    continue
                if unmarked >= toxicity.REACH:
                    out[5] += threat
                    threat, waiting, object_near = 0.0, False, False
                unmarked = 0
                if kind in ("target", "object"):
                    target, object_near = True, object_near or kind == "object"
                    if waiting:
                        out[4] += threat
                        threat, waiting = 0.0, False
                elif kind == "not":
                    negated = not negated
                elif kind == "report":
                    reported = True
                else:
                    if kind == "insult":
                        insults.add(w)
                    if reported:
                        out[3] += weight
                    elif negated:
                        out[2] += weight
                    elif kind == "insult":
                        insult += weight
                    elif object_near:
                        out[4] += weight
                    else:
                        threat += weight
                    waiting = waiting or kind == "threat"
            out[1 if target else 0] += insult
            out[5] += threat
            score = sum(out[:5])
            clauses += score > 0
            best = max(best, score)
            total = [a + b for a, b in zip(total, out, strict=True)]
    return [*total, clauses, len(insults), best, n]


def test_toxicity_equals_a_plain_reading():
    draw = random.Random(9)
    lexicon = {"idiot": 2.0, "grobul": 1.5, "fül": 0.7}
    pool = ["idiot", "grobul", "fül", "you", "toi", "kill", "töten", "not", "ne", "said", "écrit", "wood", "Ötzi", "a", "b2", "it's"]
    texts = ["".join(draw.choice(pool) + draw.choice([" ", " ", " ", " ", ", ", ": ", ".", "! ", "\n"]) for _ in range(draw.randint(0, 40))) for _ in range(600)]
    ready = toxicity.Lexicon({int(h): lexicon[w] for w in lexicon for h in toxicity._hash([w])})
    raw = [t.lower().encode() for t in texts]
    got = toxicity.clause_scores(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), ready)
    assert np.allclose(got, [plain_clauses(t, lexicon) for t in texts])


def test_quality_equals_a_plain_reading(spark):
    """Pooling and both layers, token by token, from the fitted tables."""
    draw = random.Random(10)
    rows = [(i, " ".join(words(draw, draw.randint(1, 30), 2)) + (" *** |" if i % 2 else ".")) for i in range(120)] + [(120, ""), (121, None)]
    docs = spark.createDataFrame(rows, DOCS).cache()
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id bigint, quality int")
    vectors = quality.word_vectors(docs)
    network = quality.fit(docs, labels, vectors)
    token = re.compile("[0-9a-zA-Z\x80-\U0010ffff]+|(?:(?![0-9a-zA-Z\x80-\U0010ffff])[!-~\n])+")

    def bucket(w):
        low = "".join(c.lower() if c.isascii() else c for c in w)
        raw = np.frombuffer(low.encode(), np.uint8)
        return int(kernels.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0] >> np.uint64(64 - quality.BITS))

    for r in quality.predictions(docs, labels).collect():
        text = rows[r["doc_id"]][1] or ""
        own = [vectors[bucket(w)].astype(float) for w in token.findall(text)]
        n = len(own)
        mean = sum(own) / n if n else np.zeros(quality.DIMENSIONS)
        step = sum((abs(a - b) for a, b in zip(own[1:], own, strict=False)), np.zeros(quality.DIMENSIONS)) / max(n, 1)
        x = np.concatenate([mean, step, [np.log1p(n), float(n == 0)]])
        hidden = [np.tanh(sum(z * w for z, w in zip((x - network.mean) / network.scale, column, strict=True)) + b) for column, b in zip(network.parts[0].T, network.parts[1], strict=True)]
        logit = sum(h * w for h, w in zip(hidden, network.parts[2], strict=True)) + network.parts[3][0]
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(logit / network.temperature, -30, 30))), abs=2e-4)


def test_lines_of_a_hot_window(spark):
    """A window that all rows have, and one that a row repeats, against brute force."""
    draw = random.Random(11)
    hot = "one\ntwo\nthree"
    rows = [(i, "\n".join([*words(draw, 3), hot, *words(draw, 2), *([hot] * (i % 3))])) for i in range(60)]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.line_report(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    assert got == brute_lines(rows)


def test_windows_that_many_items_share(spark):
    draw = random.Random(9)
    opening = " ".join(f"open{i}" for i in range(25))
    tail = lambda: " ".join(f"x{draw.randrange(10**6)}" for _ in range(12))
    texts = [f"{opening} {tail()}" for _ in range(1000)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")
    rows = [(i, f"{tail()} {opening} {tail()}") for i in range(300)] + [(1000 + i, texts[i]) for i in range(5)] + [(2000, tail())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    every = hashlib.sha256(",".join(sorted(str(i) for i in range(1000))).encode()).hexdigest()
    began = time.perf_counter()
    got = {r["doc_id"]: tuple(r)[1:] for r in decontamination.contamination(docs, bench).collect()}
    assert time.perf_counter() - began < 30
    assert got[0] == (49, 25, 1000, every, True) and got[1003] == (37, 37, 1000, every, True) and got[2000][1:3] == (0, 0)
    assert {r["doc_id"]: tuple(r)[1:] for r in decontamination.contamination(docs.filter("doc_id < 20 OR doc_id > 999"), bench, block_bytes=1).collect()}.items() <= got.items()


def test_spans_are_united_in_both_forms_and_other_columns_stay(spark):
    words = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words[:30])), (2, "w40 w41"), (3, " ".join(words[20:35]))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "k", " ".join(words), 7), (2, None, None, 8)], "doc_id bigint, spans string, text string, items int")
    one, other = (sorted(map(str, decontamination.find_hits(docs.select("doc_id", "text"), bench, block_bytes=b).select("doc_id", "spans", "items").collect())) for b in (1 << 20, 1))
    assert one == other and "start=0, end=35" in one[0] and "start=40, end=42" in one[0]
    left = decontamination.remove_spans(docs, bench)
    assert left.columns == docs.columns and left.orderBy("doc_id").first()["text"].split() == words[35:40] + words[42:]


def licence_runs(text, threshold=0.7):
    """Each licence's best run of the words of a text, by sets and loops."""
    norm = lambda t: re.sub(r"[^a-z0-9.]+", " ", t.lower()).strip(" ").split(" ")
    grams = lambda w: list(zip(w, w[1:], strict=False))
    own, out = grams(norm(text)), {}
    for name, t in (license_scan.NOTICES | license_scan.full_texts()).items():
        known = set(grams(norm(t)))
        if len(set(own) & known) < math.ceil(threshold / (2 - threshold) * len(known) - 1e-9):
            continue
        total = best = 0.0
        start = at = last = -1
        first, seen = 0, set()
        for i, g in enumerate(own):
            if g not in known:
                continue
            left = total - threshold * (i - at - 1)
            if start < 0 or left <= 0:
                start, total, seen = i, 2 - threshold, {g}
            else:
                total = left + (0 if g in seen else 2 - threshold)
                seen.add(g)
            at = i
            if total > best:
                best, first, last = total, start, i
        run = set(own[first : last + 1])
        score = 2 * len(run & known) / (len(run) + len(known))
        if score >= threshold:
            out[name] = round(score, 9)
    return out


def test_licence_runs_against_loops(spark):
    draw = random.Random(11)
    known = license_scan.NOTICES | license_scan.full_texts()
    words = ["the", "of", "license", "software", "under", "alpha", "beta", "version", "2.0"]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))

    def piece():
        t = known[draw.choice(sorted(known))].split()
        at = draw.randrange(max(1, len(t) // 4))
        return "\n".join(" ".join(t[i : i + 9]) for i in range(at, len(t) - draw.randrange(max(1, len(t) // 4)), 9))

    texts = ["\n".join(draw.choice([piece, lambda: prose(draw.randrange(60))])() for _ in range(draw.randrange(1, 6))) for _ in range(40)] + ["", "x", "all rights reserved all rights reserved"]
    got: dict = {i: {} for i in range(len(texts))}
    for r in license_scan.best_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect():
        got[r["doc_id"]][r["id"]] = round(r["score"], 9)
    assert got == {i: licence_runs(t) for i, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 40


def test_a_text_of_many_licence_copies_is_scanned_in_linear_time(spark):
    text = license_scan.full_texts()["gpl-3.0-text"]
    took = []
    for n in (1, 2, 16):
        df = spark.createDataFrame([(1, "\n\n".join([text] * n))], "doc_id bigint, text string")
        began = time.perf_counter()
        row = license_scan.scan(df).first()
        took.append(time.perf_counter() - began)
        assert row["licenses"] == "gpl-3.0-header,gpl-3.0-text"
    assert took[2] < took[1] + 20
