"""Lexical search against scoring every document."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import lexsearch

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    number, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = {}
    for item, own in wanted.items():
        ranked = []
        for doc, c in held:
            m = 50 + 50 * sum(c.values()) * number // total
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                ranked.append((-score, doc is None, doc or 0, doc))
        out |= {(item, k + 1): (r[3], -r[0]) for k, r in enumerate(sorted(ranked, key=lambda r: r[:3])[:top])}
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    common, rare = [f"w{i}" for i in range(30)], [f"Été{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(common, k=rng.choice([1, 5, 40])) + rng.choices(rare, k=rng.choice([0, 1, 8])))) for i in range(n)]
    docs += [(1000 + i, docs[3][1]) for i in range(80)] + [(3, "w1-w2"), (None, docs[3][1]), (None, "w1"), (2000, None), (2001, ""), (2002, "?!"), (2003, "W1,w1;w9" * 400)]
    items = [(k, " ".join(rng.choices(common, k=6) + rng.choices(rare, k=5))) for k in range(12)]
    return docs, [*items, (20, docs[3][1]), (20, "w9"), (None, "w4 w5"), (21, None), (22, "..."), (23, "nowhere")]


def found(frame):
    return {(r.item_id, r.rank): (r.doc_id, r.score) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_scoring_everything(spark, monkeypatch, seed):
    monkeypatch.setattr(lexsearch, "BLOCK_TERMS", 60)  # several blocks of items
    docs, items = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(5)
    got = lexsearch.search(frame, spark.createDataFrame(items, "item_id long, text string").withColumn("place", F.lit(1)), top=7)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert found(got) == brute(docs, items, 7)


@pytest.mark.parametrize("shard, leaf, at_once", [(40, 4, 2), (500, 1, 1), (1 << 19, 64, 64)])
def test_shards_and_leaves_of_any_size_give_the_same(monkeypatch, shard, leaf, at_once):
    monkeypatch.setattr(lexsearch, "LEAF_POSTINGS", leaf)
    monkeypatch.setattr(lexsearch, "AT_ONCE", at_once)
    docs, items = corpus(3)
    docs, items = [d for d in docs if d[0] is not None], [i for i in items if i[0] is not None and i[0] < 20]
    own = [r[2] for r in lexsearch.term_counts([t.encode() for _, t in items], None)]
    vocabulary = np.unique(np.concatenate(own))
    rows = [r for r in lexsearch.term_counts([(t or "").encode() for _, t in docs], vocabulary) if r[1]]
    number, total = len(rows), sum(r[1] for r in rows)
    holding = Counter(int(t) for r in rows for t in r[2])
    weights = np.array([lexsearch.weight(number, holding[t]) for t in range(len(vocabulary))])
    best, seen = [lexsearch.Best(5) for _ in own], 0
    while rows:
        k = 1
        while k < len(rows) and sum(len(r[2]) for r in rows[:k]) < shard:
            k += 1
        part, rows = rows[:k], rows[k:]
        flat = [np.concatenate([r[j] for r in part]) for j in (2, 3)]
        built = lexsearch.Shard(np.array([r[1] for r in part]), np.repeat(np.arange(k), [len(r[2]) for r in part]), *flat, number, total)
        ids, none = np.array([docs[r[0]][0] for r in part]), np.zeros(k, bool)
        for b, t in zip(best, own, strict=True):

            def add(d, s, b=b):
                nonlocal seen
                seen += len(d)
                return b.add(s, ids[d], none[d])

            t = np.searchsorted(vocabulary, t).astype(np.int64)
            built.search(t, weights[t], b.floor, add)
    got = {(i, r + 1): (int(d), int(s)) for (i, _), b in zip(items, best, strict=True) for r, (d, s) in enumerate(zip(b.id, b.score, strict=True))}
    assert got == brute(docs, items, 5)
    if leaf == 1:
        assert seen < 0.7 * number * len(own)  # intervals are left unseen


def test_long_texts_in_slices(monkeypatch):
    text = ("Alpha beta, " * 3000 + "x" * 5000 + " gamma").encode()
    whole = next(lexsearch.term_counts([text], None))
    monkeypatch.setattr(lexsearch, "CHUNK_BYTES", 1 << 10)
    sliced = next(lexsearch.term_counts([text * 40], None))
    assert whole[1] == 6002 and sliced[1] == 40 * 6001 + 1
    assert len(whole[2]) == 4 and sorted(sliced[3])[0] == 1


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexsearch.search(docs, items).count() == 0
    assert lexsearch.search(docs, items.filter("false")).count() == 0
