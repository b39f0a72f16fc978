"""The pipeline's stages in turn, each held against its operator's brute force on small tables."""

import os
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from patchloom.llm import toxicity
from patchloom.llm.labelled import training_rows
from patchloom.llm.queries import tokenizer_path
from tests_llm_tables import LOWER, brute_components, brute_lines

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def clean_of(texts, items):
    """The documents without a window of ten words of an item, or of a shorter item's all."""
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = set()
    for w in map(words, items):
        k = min(10, len(w))
        windows |= {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
    sizes = {len(w) for w in windows}
    own = {i: words(t) for i, t in texts.items()}
    return {i for i, w in own.items() if not any(tuple(w[p : p + k]) in windows for k in sizes for p in range(len(w) - k + 1))}


def mild_of(spark, docs, texts):
    """The documents that the fitted grammar scores under a half, one text at a time."""
    lexicon, weights = toxicity.fit(training_rows(docs, spark.read.parquet(f"{SF}/labels.parquet"), "toxic"))
    ready, out = toxicity.Lexicon(lexicon), set()
    for i, t in texts.items():
        raw = np.frombuffer((t or "").lower().encode(), np.uint8)
        x = toxicity.features(toxicity.clause_scores(raw, np.array([0, len(raw)]), ready))[0]
        if x @ weights[:-1] + weights[-1] < 0:
            out.add(i)
    return out


def check_packed(rows, texts):
    """Each id of each document lies in one piece, and each sequence is filled without gaps."""
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids, at = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(own, key=lambda r: r["start"]):
            some = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["start"] == at and len(some) == r["length"] > 0 and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(some.tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        source = docs
        docs = stage(spark, docs, SF).cache()
        if name == "packing":
            check_packed(docs.collect(), before)
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        assert set(after) <= set(before) and len(after) > 0.6 * len(before)
        if name == "line_dedup":
            assert {i: t for i, (_, _, t) in brute_lines(before.items()).items()} == after
        else:
            assert all(before[i] == t for i, t in after.items())
        if name == "toxicity":
            assert mild_of(spark, source, before) == set(after)
        if name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert clean_of(before, items) == set(after)
        if name == "ngram_join":
            assert {i for i, (_, c) in brute_components(before.items()).items() if i == c} == set(after)


def test_run_is_deterministic(spark):
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) for _ in range(2))
    assert a == b and len(a) > 100
