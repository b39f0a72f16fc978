"""Classifiers on planted labels: held-out accuracy, determinism and the defined edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm import quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(4)
    words = ["".join(draw.choice(["an", "the", "or", "ti", "es", "on"]) for _ in range(draw.randint(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(500):
        body = [draw.choice(words) for _ in range(draw.randint(30, 80))]
        toxic, good = draw.random() < 0.3, draw.random() < 0.7
        for _ in range(draw.randint(2, 4) if toxic else 0):
            body.insert(draw.randrange(len(body)), draw.choice(["idiot", "moron", "grobulak", "grobunef"]))
        text = " ".join(body) if good else "*** ".join(body) + " | |"
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    docs += [(600, ""), (601, None), (602, docs[0][1]), (None, docs[0][1])]
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).cache(), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").cache()


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(tables, module, label):
    docs, labels = tables
    got = {r["doc_id"]: r for r in module.predictions(docs, labels).collect()}
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    assert len(got) == 504 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    held = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.95
    assert got[600]["score"] == got[601]["score"] and got[602]["score"] == got[0]["score"] == got[None]["score"]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edges(spark, tables, module):
    docs, labels = tables
    assert module.predictions(docs.limit(0), labels).count() == 0
    assert module.predictions(docs.limit(3), labels.limit(0)).count() == 3


def test_rejection_keeps_columns(tables):
    docs, labels = tables
    kept = toxicity.reject(docs.withColumn("score", F.lit(1)).withColumn("label", F.lit("x")), labels)
    assert kept.columns == ["doc_id", "text", "score", "label"] and 300 < kept.count() < 450


def test_grammar_scopes():
    lexicon = toxicity.Lexicon({int(h): 2.0 for h in toxicity._hash(["idiot"])})
    score = lambda t: toxicity.clause_scores(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), lexicon)[0]
    assert score("an idiot")[toxicity.PLAIN] == 2 and score("you idiot")[toxicity.AIMED] == 2
    assert score("not an idiot")[toxicity.NEGATED] == 2 and score("not so. an idiot")[toxicity.PLAIN] == 2
    assert score("they said you idiot")[toxicity.REPORTED] == 2 and score("never not an idiot")[toxicity.PLAIN] == 2
    assert score("i will kill you")[toxicity.THREATS_OUT] == 1 and score("").sum() == 0
    assert score("burn the wood")[toxicity.BARE] == 1 and score("burn the wood")[toxicity.CLAUSES] == 0
    assert score("idiot that you are")[toxicity.AIMED] == 2 and score("you said idiot")[toxicity.REPORTED] == 2
    for text in ('he said: "you are an idiot"', "he said, you are an idiot", "they wrote: an idiot, you idiot"):
        assert score(text)[toxicity.REPORTED] >= 2 and score(text)[toxicity.AIMED] == 0
    assert score("he said so. you are an idiot")[toxicity.AIMED] == 2
    for text in ("she beat the record, her best", "I will kill the process for you", "you kill the lights"):
        assert score(text)[toxicity.THREATS_OUT] == 0 and score(text)[toxicity.BARE] == 1
    for text in ("i will hurt all of them", "kill or hurt you", "ich werde dich töten", "te voy a matar", "we burn your house"):
        assert score(text)[toxicity.THREATS_OUT] >= 1
    assert score("she did not kill you")[toxicity.NEGATED] == 1
    assert score("you. burn it")[toxicity.THREATS_OUT] == 0 and score("an idiot, you")[toxicity.PLAIN] == 2


def test_temperature_calibrates():
    draw = np.random.Generator(np.random.PCG64(3))
    logit = draw.normal(0, 2, 4000)
    y = (draw.random(4000) < 1 / (1 + np.exp(-logit))).astype(float)
    assert 3 < quality.Network._calibrate(logit * 4, y) < 5.3
