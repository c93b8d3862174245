"""Toxicity: held-out accuracy, unseen misspellings, and texts of any shape."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import toxicity

CLEAN = ["river", "window", "garden", "seven", "paper", "quiet", "morning", "carry", "stone", "letter", "bridge", "honey", "market", "cloud"]
RUDE = ["blockhead", "numbskull", "dimwit", "nitwit"]


def texts(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        toxic = rng.random() < 0.3
        words = rng.choices(CLEAN, k=rng.choice([8, 30, 120]))
        for _ in range(rng.choice([1, 2]) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(RUDE)
        rows.append((" ".join(words).encode(), int(toxic)))
    return [t for t, _ in rows], np.array([y for _, y in rows])


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(*texts(1, 600))


def test_unseen_texts(model):
    found, toxic = texts(2, 300)
    assert ((toxicity.score_texts(found, model) >= 0.5) == toxic).mean() > 0.97


def test_unseen_misspellings_share_vectors(model):
    plain = "river window garden seven paper quiet"
    spelled = ["Blockheaad", "numbskulls", "dimwitt", "nitwitz"]
    scores = toxicity.score_texts([f"{plain} {w} {plain}".encode() for w in spelled] + [f"{plain} mornings {plain}".encode()], model)
    assert scores[:-1].min() > 0.5 > scores[-1]


def test_pieces_of_long_texts(model, monkeypatch):
    rng = random.Random(3)
    long = " ".join(rng.choices([*CLEAN, "dimwit", "é" * 70, "  ", "x" * 1000, "-"], k=4000)).encode()
    whole = toxicity.worst_windows([long, b"", b"a", long[:999]], model.weights, model.bias)
    monkeypatch.setattr(toxicity, "PIECE_BYTES", 300)
    pieces = toxicity.worst_windows([long, b"", b"a", long[:999]], model.weights, model.bias)
    assert np.array_equal(whole[1], pieces[1]) and np.allclose(whole[0][[0, 2, 3]], pieces[0][[0, 2, 3]])


def test_one_class_and_no_rows():
    found, _ = texts(4, 20)
    assert toxicity.score_texts(found, toxicity.fit(found, np.ones(20, np.int64))).min() > 0.99
    assert toxicity.score_texts(found, toxicity.fit(found, np.zeros(20, np.int64))).max() < 0.01
    assert toxicity.score_texts([b"x", b""], toxicity.fit([], np.array([], np.int64))).max() < 0.01


def test_training_rows_and_scores_of_a_table(spark):
    found, toxic = texts(5, 400)
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(found)] + [(500, None), (501, ""), (502, " \n"), (None, "river"), (7, "river")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(toxic)] + [(8, None), (None, 1), (9, 1), (9, 0), (999, 1)], "doc_id long, toxic int")
    taken, own = toxicity.sample(docs, labels)
    held = {r.doc_id for r in docs.filter(toxicity.held_out()).select("doc_id").collect()}
    assert len(taken) == 400 - len([h for h in held if h < 400]) + (7 not in held)
    model = toxicity.fit(taken, own)
    scored = toxicity.score(docs.withColumn("score", F.lit("x")).withColumn("a b", F.lit(1)), model)
    assert scored.columns == ["doc_id", "text", "a b", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == 405 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (500, 501, 502)}) == 1
    assert toxicity.score(docs.filter("false"), model).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(*toxicity.sample(docs, labels))
    rows = toxicity.score(docs.filter(toxicity.held_out()).select("doc_id", "text"), model).join(labels, "doc_id").filter("toxic IS NOT NULL").collect()
    toxic, score = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    assert (rank[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (toxic == 0).sum() > 0.93
    assert (score[toxic == 1] >= 0.5).mean() > 0.7 and (score[toxic == 0] >= 0.5).mean() < 0.03
