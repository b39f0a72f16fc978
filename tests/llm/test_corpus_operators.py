"""Language-model scores, source divergence and lexical search against plain brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from patchloom.llm import divergence, kernels, lexical, lm_score

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, block int, part string, rank double"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(["alpha", "Beta", "gamma", "delta", "epsilon", "the", "the", "of", "Ünder", "x1", "0", "don't", "naïve"]) for _ in range(n))


def corpus(n: int = 60) -> list[tuple]:
    rows = [(i, prose(i % 25, 5 + i * 7 % 40), ("en", "de")[i % 7 == 0], f"s{i % 5}", 1, "p", 0.5) for i in range(n)]
    rows += [(900, None, "en", None, 1, None, None), (901, "", None, "s1", 1, None, None), (902, " \t\n .. ", "en", "s2", None, None, None), (903, "word" * 3000, "en", "s3", None, None, None)]
    rows += [(904, prose(4, 30000), "en", "s0", 1, "p", 0.5), (None, prose(2, 9), "en", "s1", 1, "p", 0.5)]
    return rows + rows[:3]


def model(rows: list[tuple]) -> dict:
    """doc rows -> (held, n, known, N, base, score) by counting in dictionaries."""
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: ["<", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), ">"]
    counts: list[Counter] = [Counter(), Counter(), Counter()]
    texts = 0
    for i, text, *_ in rows:
        if not held(i):
            t, texts = tokens(text), texts + 1
            for k in range(3):
                counts[k].update(tuple(t[j : j + k + 1]) for j in range(len(t) - k))
    begins = counts[0].pop(("<",), 0)
    total, size = sum(counts[0].values()), len(counts[0])
    once = [sum(v == 1 for v in c.values()) for c in counts]

    def gamma(a, b, n):
        return 0.5 if n - b <= 0 else min(max((a - b) / (n - b), 0.05), 0.95)

    g2, g3 = gamma(once[1], once[0], total), gamma(once[2], once[1], total - texts)
    ctx = lambda h: begins if h == ("<",) else counts[len(h) - 1][h]

    def p(h, w):
        if not h:
            return (counts[0][(w,)] + 1) / (total + size + 1)
        if not ctx(h):
            return p(h[1:], w)
        g = (g2, g3)[len(h) - 1]
        return (1 - g) * counts[len(h)][(*h, w)] / ctx(h) + g * p(h[1:], w)

    out = []
    for i, text, *_ in rows:
        t = tokens(text)
        base = sum(math.log10(p((), w)) for w in t[1:])
        score = sum(math.log10(p(tuple(t[max(0, j - 2) : j]), t[j])) for j in range(1, len(t)))
        out.append((i, held(i), len(t) - 1, sum(counts[0][(w,)] > 0 for w in t[1:]), total, base, score))
    return out


def close(got: list[tuple], want: list[tuple]) -> None:
    key = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], abs=1e-5, rel=1e-9)


def test_scores_are_those_of_counted_ngrams(spark):
    rows = corpus()
    got = [tuple(r) for r in lm_score.score(spark.createDataFrame(rows, DOCS).repartition(3)).collect()]
    close(got, model(rows))


def test_scores_do_not_depend_on_blocks_or_lanes(spark, monkeypatch):
    rows = corpus()
    whole = lm_score.score(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    parts = lm_score.score(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))
    import pyarrow as pa

    grams = lm_score.grams_of(pa.array([r[1] for r in rows]), np.ones(len(rows), bool))
    machine = lm_score.Automaton(grams, grams.told, lm_score.model_of(*(int(grams.told[0].sum()) - len(rows), len(grams.words) - 1, len(rows), 1, 20, 50)))
    together = machine.traverse(grams.tokens)
    monkeypatch.setattr(lm_score, "LANES", 1)
    assert (together == machine.traverse(grams.tokens)).all()


def test_probabilities_of_a_state_sum_to_one():
    import pyarrow as pa

    texts = [prose(i, 30) for i in range(20)]
    grams = lm_score.grams_of(pa.array(texts), np.ones(20, bool))
    total, size = int(grams.told[0].sum()) - 20, len(grams.words) - 1
    machine = lm_score.Automaton(grams, grams.told, lm_score.model_of(total, size, 20, 0, 60, 300))
    words = np.flatnonzero(np.arange(len(grams.words)) != machine.begin)
    for state in (0, 1 + machine.begin, 1 + int(words[0]), 1 + machine.n, 1 + machine.n + 5):
        seen = 10.0 ** (machine.step(np.full(len(words), state), words)[1] / lm_score.UNIT)
        unknown = 1 / (total + size + 1)
        for fail in [machine.fail3, machine.fail2] if state > machine.n else [machine.fail2] if state else []:
            unknown *= 10.0 ** (fail / lm_score.UNIT)
        assert seen.sum() + unknown == pytest.approx(1, abs=1e-6)


def test_scores_of_edge_tables(spark):
    assert lm_score.score(spark.createDataFrame([], DOCS)).count() == 0
    # None of these is learned from: all words are equally unlikely.
    from pyspark.sql import functions as F

    got = lm_score.score(spark.createDataFrame(corpus(5), DOCS), held=F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known) for r in got} == {(0, 0)} and all(r.score == r.base_score == 0 for r in got)
    one = lm_score.score(spark.createDataFrame([("a", "x x x")], "doc_id string, text string"), held=F.lit(False)).collect()[0]
    assert (one.doc_id, one.n_tokens, one.n_known, one.train_tokens) == ("a", 4, 4, 4)


def audit(rows: list[tuple], least: int = 10, top: int = 10) -> set[tuple]:
    term = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    count, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        count[lang, source].update(term(text))
        df[lang].update(set(term(text)))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        share = lambda c, n: 1 + 10**9 * (c + 2) // (n + 2 * len(kept))  # noqa: B023, E731
        size = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(count[lang, s][t], size[s]) for t in kept} for s in sources}
        q = {t: share(sum(count[lang, s][t] for s in sources), sum(size.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", i.decode(), -v, n) for n, (v, i) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", i.decode(), -v, n) for n, (v, i) in enumerate(sorted(terms)[:top], 1)}
    return out


@pytest.mark.parametrize("least", [1, 3, 10, 10**6])
def test_divergence_against_brute_force(spark, least):
    rows = corpus()
    got = divergence.divergence(spark.createDataFrame(rows, DOCS).repartition(3), least).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == audit(rows, least)


def test_divergence_of_many_groups_in_blocks_of_cells(spark, monkeypatch):
    pick = random.Random(5)
    # Rare terms are held by a few of 150 groups, common ones by all, one group has a third of all rows.
    rows = [(i, " ".join(pick.choice(["all", "most", f"rare{chr(97 + pick.randrange(26))}{chr(97 + pick.randrange(26))}"]) for _ in range(30)), "en", f"s{0 if i % 3 == 0 else i % 150}", 0, "", 0.0) for i in range(600)]
    got = {tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, DOCS), 3).collect()}
    assert got == audit(rows, 3)


def test_divergence_of_edge_tables(spark):
    assert divergence.divergence(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, None, None, None, 0, "", 0.0), (2, "x", "", "b", 0, "", 0.0), (3, None, "xx", "only", 0, "", 0.0)]
    assert {tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, DOCS)).collect()} == audit(rows)


def ranking(rows: list[tuple], items: list[tuple], k: int = 50) -> list[tuple]:
    term = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(i, Counter(term(t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(x[2] for x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(term(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, size in docs:
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is not None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


ITEMS = [(1, "alpha beta the zeta"), (2, "x1 naïve"), (2, "0"), (3, None), (4, ""), (5, "nowhere"), (None, "under Ünder gamma"), (6, "the of"), (7, "the " * 500 + "wordwordword")]


@pytest.mark.parametrize(("k", "shard", "query"), [(50, 8 << 20, 4 << 20), (5, 4096, 4 << 20), (3, 1000, 1500)])
def test_search_against_brute_force(spark, monkeypatch, k, shard, query):
    monkeypatch.setattr(lexical, "SHARD_BYTES", shard)
    rows = corpus(120)
    docs, items = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = lexical.search(docs, items, k, query).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, ranking(rows, ITEMS, k)))


def test_non_essential_lists_are_probed_exactly():
    import pyarrow as pa

    pick = np.random.default_rng(3)
    terms, docs = 40, 900
    held = pick.random((terms, docs)) < np.linspace(0.9, 0.01, terms)[:, None]
    term, doc = np.nonzero(held)
    postings = pa.table({"term": term.astype(np.int32), "doc": doc.astype(np.int32), "tf": pick.integers(1, 5, len(term)).astype(np.int32)})
    weights = np.linspace(100, 7000, terms).astype(np.int64)
    shard = lexical.Shard(pa.table({"id": np.arange(docs), "n": pick.integers(1, 900, docs)}), postings, weights, docs, docs * 400)
    for _ in range(50):
        query = np.sort(pick.choice(terms, pick.integers(1, 20), replace=False))
        full = np.zeros(docs, np.int64)
        for t in query:
            full[doc[term == t]] += shard.adds[term == t]
        want = np.sort(full)[::-1][:10]
        places, scores = shard.search(query, 0, 10)
        assert (np.sort(scores)[::-1][:10] == want[want > 0]).all() and (full[places] == scores).all()
        places, scores = shard.search(query, int(want[-1]), 10)
        assert set(places) >= set(np.flatnonzero(full >= max(int(want[0]), 1))) and (scores >= max(int(want[-1]), 1)).all()


def test_search_of_edge_tables(spark):
    empty, items = spark.createDataFrame([], DOCS), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(spark.createDataFrame(corpus(5), DOCS), items.limit(0)).count() == 0
    names = spark.createDataFrame([("a", "alpha", 1)], "item_id string, text string, rank int")
    one = lexical.search(spark.createDataFrame([("d", "alpha"), ("e", "beta")], "doc_id string, text string"), names).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in one] == [("a", 1, "d")]


def test_many_equal_documents_keep_the_least_ids(spark):
    rows = [(i, "alpha beta", "en", "s", 0, "", 0.0) for i in range(400)] + [(1000 + i, "gamma", "en", "s", 0, "", 0.0) for i in range(200)]
    got = lexical.search(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame([(1, "alpha")], "item_id bigint, text string")).collect()
    assert sorted((r["rank"], r.doc_id) for r in got) == [(i + 1, i) for i in range(50)]


def test_long_text_length_terms_leave_64_bits():
    assert lexical.length_term(np.array([10**12, 5]), 10**9, 10**13).tolist() == [50 + 50 * 10**12 * 10**9 // 10**13, 50]
    assert kernels.CHUNK > 0
