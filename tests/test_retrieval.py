"""Search, merge and metrics against hand-computed values and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ranking, retrieval
from tallyloom.plans import catalog, jobs


def vectors(spark, key, matrix, names):
    rows = [(n, [float(x) for x in v]) for n, v in zip(names, matrix)]
    return spark.createDataFrame(rows, f"{key} STRING, embedding ARRAY<FLOAT>")


def brute_force(q, q_names, d, d_names, depth):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    scores = np.round(unit(q.astype(np.float64)) @ unit(d.astype(np.float64)).T, 6) + 0.0
    expected = {}
    for i, name in enumerate(q_names):
        order = sorted(range(len(d_names)), key=lambda j: (-scores[i, j], d_names[j]))[:depth]
        expected[name] = [(d_names[j], scores[i, j]) for j in order]
    return expected


def found(df):
    got = {}
    for r in df.orderBy("qid", "rk").collect():
        got.setdefault(r.qid, []).append((r.doc_id, r.score))
    return got


@pytest.fixture(scope="module")
def fixture():
    rng = np.random.default_rng(3)
    q = rng.normal(size=(23, 8)).astype(np.float32)
    d = rng.normal(size=(900, 8)).astype(np.float32)
    d[300:600] = d[0]  # a group of copies that holds a third of all rows
    d[601] = 0
    return q, [f"q{i}" for i in range(23)], d, [f"d{i}" for i in range(900)]


@pytest.mark.parametrize("depth,partitions", [(1, 3), (10, 1), (10, 16), (100, 5), (2000, 4)])
def test_topk_matches_brute_force(spark, fixture, depth, partitions):
    q, qn, d, dn = fixture
    df = retrieval.cosine_topk(
        vectors(spark, "qid", q, qn), vectors(spark, "doc_id", d, dn).repartition(partitions), depth
    )
    assert found(df) == brute_force(q, qn, d, dn, depth)


def test_topk_over_many_queries_matches_brute_force(spark, fixture):
    q, qn, d, dn = fixture
    df = retrieval.cosine_topk(
        vectors(spark, "qid", q, qn), vectors(spark, "doc_id", d, dn), 10,
        max_broadcast_queries=4, block_queries=5, block_docs=100,
    )
    assert found(df) == brute_force(q, qn, d, dn, 10)


def test_topk_over_several_batches_of_one_task(spark, fixture):
    q, qn, d, dn = fixture
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = retrieval.cosine_topk(vectors(spark, "qid", q, qn), vectors(spark, "doc_id", d, dn).coalesce(1), 7)
        assert found(df) == brute_force(q, qn, d, dn, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_topk_of_nothing(spark, fixture):
    q, qn, d, dn = fixture
    docs = vectors(spark, "doc_id", d, dn)
    assert retrieval.cosine_topk(vectors(spark, "qid", q, qn).limit(0), docs, 5).count() == 0
    assert retrieval.cosine_topk(vectors(spark, "qid", q, qn), docs.limit(0), 5).count() == 0


def test_a_document_with_the_querys_id_is_not_found(spark, fixture):
    _, _, d, dn = fixture
    docs = vectors(spark, "doc_id", d[600:700], dn[600:700])
    asked = vectors(spark, "qid", d[600:605], dn[600:605])
    got = found(retrieval.cosine_topk(asked, docs, 5))
    expected = brute_force(d[600:605], dn[600:605], d[600:700], dn[600:700], 6)
    assert got == {q: [x for x in best if x[0] != q][:5] for q, best in expected.items()}
    with_self = found(retrieval.cosine_topk(asked, docs, 5, ignore_identical_ids=False))
    assert with_self["d600"][0] == ("d600", 1.0)


def test_depth_and_cutoffs():
    assert retrieval.search_depth(50) == 100 and retrieval.search_depth(1000) == 1000
    assert ranking.k_grid(50) == [1, 3, 5, 10, 50]
    assert ranking.k_grid(1000) == [1, 3, 5, 10, 100, 1000]


def results(spark, rows):
    return spark.createDataFrame(rows, "system STRING, qid STRING, doc_id STRING, score DOUBLE")


def judgements(spark, rows):
    return spark.createDataFrame(rows, "qid STRING, doc_id STRING, rel INT")


def test_metrics_by_hand(spark):
    qrels = judgements(spark, [("q", "d2", 1), ("q", "d3", 1), ("q", "d9", 1), ("q", "d1", 0)])
    runs = results(spark, [("s", "q", "d1", 0.9), ("s", "q", "d2", 0.8), ("s", "q", "d3", 0.7)])
    got = {r.k: r for r in ranking.query_metrics(qrels, runs, [3, 10]).collect()}
    assert got[3].precision == pytest.approx(2 / 3) and got[3].recall == pytest.approx(2 / 3)
    assert got[3]["map"] == pytest.approx(0.388889, abs=1e-6) and got[3].ndcg == pytest.approx(0.530721, abs=1e-6)
    assert got[10].precision == pytest.approx(0.2)  # divides by k even with fewer results


def test_graded_metrics_by_hand(spark):
    qrels = judgements(spark, [("q", "a", 2), ("q", "b", 0), ("q", "c", 1)])
    runs = results(spark, [("s", "q", "a", 3.0), ("s", "q", "b", 2.0), ("s", "q", "c", 1.0)])
    assert ranking.query_metrics(qrels, runs, [3]).first().ndcg == pytest.approx(0.950234, abs=1e-6)


def test_scored_queries(spark):
    qrels = judgements(spark, [("hit", "a", 1), ("miss", "b", 1), ("unsearched", "c", 1), ("none_relevant", "a", 0)])
    runs = results(
        spark,
        [("s", "hit", "a", 1.0), ("s", "miss", "a", 1.0), ("s", "unjudged", "a", 1.0), ("s", "none_relevant", "a", 1.0)],
    )
    got = ranking.ranking_metrics(qrels, runs, [1]).first()
    # queries with both results and judgements count, with 0 where nothing relevant was found
    assert got.n_queries == 3 and got.recall == pytest.approx(1 / 3, abs=1e-5)


def test_a_document_with_the_querys_id_is_no_result(spark):
    qrels = judgements(spark, [("1", "2", 1)])
    runs = results(spark, [("s", "1", "1", 1.0), ("s", "1", "2", 0.5)])
    assert ranking.query_metrics(qrels, runs, [1]).first().ndcg == 1.0
    assert ranking.query_metrics(qrels, runs, [1], ignore_identical_ids=False).first().ndcg == 0.0


def test_metrics_match_python_and_stay_in_bounds(spark):
    rng = np.random.default_rng(5)
    qrels = [(f"q{q}", f"d{d}", int(rng.integers(0, 4))) for q in range(6) for d in rng.permutation(40)[:25]]
    runs = [("s", f"q{q}", f"d{d}", float(rng.random())) for q in range(6) for d in range(40)]
    ks = [1, 3, 5, 10, 30]
    got = {(r.qid, r.k): r for r in ranking.query_metrics(judgements(spark, qrels), results(spark, runs), ks).collect()}
    for q in range(6):
        rel = {d: r for n, d, r in qrels if n == f"q{q}"}
        ranked = [d for _, n, d, s in sorted(runs, key=lambda x: -x[3]) if n == f"q{q}"]
        ideal = sorted((r for r in rel.values() if r > 0), reverse=True)
        total = len(ideal)
        for k in ks:
            gains = [rel.get(d, 0) for d in ranked[:k]]
            dcg = sum(g / math.log2(i + 2) for i, g in enumerate(gains))
            best = sum(g / math.log2(i + 2) for i, g in enumerate(ideal[:k]))
            hits = [i + 1 for i, g in enumerate(gains) if g > 0]
            row = got[f"q{q}", k]
            assert row.ndcg == pytest.approx(dcg / best) and 0 <= row.ndcg <= 1
            assert row["map"] == pytest.approx(sum((n + 1) / at for n, at in enumerate(hits)) / total)
            assert row.recall == pytest.approx(len(hits) / total) and row.precision == pytest.approx(len(hits) / k)


def test_ideal_ranking_scores_one(spark):
    qrels = judgements(spark, [("q", f"d{i}", i % 3) for i in range(50)])
    runs = qrels.select(F.lit("s").alias("system"), "qid", "doc_id", F.col("rel").cast("double").alias("score"))
    assert {r.ndcg for r in ranking.query_metrics(qrels, runs, [1, 10, 100]).collect()} == {1.0}


def test_more_grades_than_the_cutoff(spark):
    qrels = judgements(spark, [("q", f"d{i}", i) for i in range(40)])
    runs = results(spark, [("s", "q", f"d{i}", float(i)) for i in range(39)])
    got = ranking.query_metrics(qrels, runs, [1, 3]).orderBy("k").collect()
    ideal = sum((39 - i) / math.log2(i + 2) for i in range(3))
    assert [r.ndcg for r in got] == pytest.approx([38 / 39, sum((38 - i) / math.log2(i + 2) for i in range(3)) / ideal])
    assert got[1].recall == pytest.approx(3 / 39)


def ranked(spark):
    return spark.createDataFrame(
        [("q", "d1", 0.9, 1), ("q", "d2", 0.8, 2), ("q", "d3", 0.7, 3)], "qid STRING, doc_id STRING, score DOUBLE, rk INT"
    )


def second(spark, rows):
    return spark.createDataFrame(rows, "qid STRING, doc_id STRING, score DOUBLE")


def test_rerank_merge(spark):
    merged = retrieval.merge_rerank(ranked(spark), second(spark, [("q", "d1", -5.0), ("q", "d2", 3.0)]), 2)
    assert [(r.doc_id, r.score) for r in merged.orderBy("rk").collect()] == [("d2", 1003.0), ("d1", 995.0), ("d3", 0.7)]


def test_empty_pool_keeps_the_ranking(spark):
    merged = retrieval.merge_rerank(ranked(spark), second(spark, []), 0)
    assert [r.doc_id for r in merged.orderBy("rk").collect()] == ["d1", "d2", "d3"]


def test_missing_rerank_score_is_an_error(spark):
    with pytest.raises(Exception, match="no rerank score for q / d2"):
        retrieval.merge_rerank(ranked(spark), second(spark, [("q", "d1", 1.0)]), 2).collect()


def test_model_scores_of_the_heads(spark):
    queries = spark.createDataFrame([("q", "abc")], "qid STRING, text STRING")
    corpus = spark.createDataFrame([(f"d{i}", "T" * i, "x") for i in (1, 2, 3)], "doc_id STRING, title STRING, text STRING")

    def load():
        return lambda texts, docs: [len(t) + len(d) for t, d in zip(texts, docs)]

    scores = retrieval.score_pairs(ranked(spark), queries, corpus, 2, load)
    assert {r.doc_id: r.score for r in scores.collect()} == {"d1": 3 + 3, "d2": 3 + 4}
    merged = retrieval.merge_rerank(ranked(spark), scores, 2)
    assert [r.doc_id for r in merged.orderBy("rk").collect()] == ["d2", "d1", "d3"]


def test_heads_without_text_are_errors(spark):
    queries = spark.createDataFrame([("q", "abc")], "qid STRING, text STRING")
    corpus = spark.createDataFrame([(f"d{i}", "T", "x") for i in (2, 3)], "doc_id STRING, title STRING, text STRING")
    load = lambda: lambda texts, docs: [0.0] * len(texts)
    with pytest.raises(Exception, match="no passage for d1"):
        retrieval.score_pairs(ranked(spark), queries, corpus, 3, load).collect()
    with pytest.raises(Exception, match="no query_text for q"):
        retrieval.score_pairs(ranked(spark), queries.limit(0), corpus, 3, load).collect()


def test_batches_hold_passages_of_like_length(spark):
    corpus = spark.range(400).select(
        F.col("id").cast("string").alias("doc_id"), F.lit("").alias("title"), F.repeat(F.lit("x"), (F.col("id") * 37 % 400).cast("int")).alias("text")
    )
    heads = corpus.select(F.lit("q").alias("qid"), "doc_id", F.lit(0.5).alias("score"), F.lit(1).alias("rk")).repartition(1)
    queries = spark.createDataFrame([("q", "abc")], "qid STRING, text STRING")

    def load():
        return lambda texts, docs: [float(max(map(len, docs)) - min(map(len, docs)) + 1000 * len(docs))] * len(docs)

    scores = [r.score for r in retrieval.score_pairs(heads, queries, corpus.coalesce(1), 1, load, batch_size=20).collect()]
    assert len(scores) == 400 and max(s // 1000 for s in scores) <= 20
    assert sum(s % 1000 for s in scores) / len(scores) < 200  # unsorted batches spread over some 370


def test_subsample(spark):
    queries = spark.createDataFrame([(f"q{i}", "t") for i in range(50)], "qid STRING, text STRING")
    qrels = judgements(spark, [(f"q{i}", "d", 1) for i in range(20, 70)])
    everything, untouched = retrieval.subsample_queries(queries, qrels, 50)
    assert everything.count() == 30 and untouched.count() == 50  # also ids without query text
    some, theirs = retrieval.subsample_queries(queries, qrels, 10, seed=1)
    picked = {r.qid for r in some.collect()}
    assert len(picked) == 10 and {r.qid for r in theirs.collect()} == picked
    again, _ = retrieval.subsample_queries(queries.repartition(9), qrels, 10, seed=1)
    other, _ = retrieval.subsample_queries(queries, qrels, 10, seed=2)
    assert {r.qid for r in again.collect()} == picked != {r.qid for r in other.collect()}


def comparison(spark, dense, rerank):
    rows = [("a", "dense", 10, 5, dense, 0.0, 0.0, 0.0), ("a", "rerank", 10, 5, rerank, 0.0, 0.0, 0.0)]
    metrics = spark.createDataFrame(
        rows, "dataset STRING, system STRING, k INT, n_queries BIGINT, ndcg DOUBLE, map DOUBLE, recall DOUBLE, precision DOUBLE"
    )
    return ranking.compare_systems(metrics)


@pytest.mark.parametrize("dense,rerank,passed", [(0.3, 0.3, False), (0.3, 0.3000009, False), (0.3, 0.30001, True), (0.3, 0.2, False)])
def test_gate(spark, dense, rerank, passed):
    gate = ranking.improvement_gate(comparison(spark, dense, rerank))
    assert gate.first().passed is passed
    if not passed:
        with pytest.raises(ranking.RegressionError):
            ranking.enforce_gate(gate)
    assert len(ranking.enforce_gate(gate, allow_regression=True)) == (0 if passed else 1)


def test_gate_without_the_cutoff_fails(spark):
    assert ranking.improvement_gate(comparison(spark, 0.3, 0.5), k=100).first().passed is False


def test_comparison_document(spark):
    parameters = jobs.comparison_parameters(spark, "a", 9, jobs.RetrievalSettings(), "bi", "cross")
    record = ranking.comparison_document(comparison(spark, 0.3, 0.5), parameters).first()
    assert record.dense["ndcg@10"] == 0.3 and record.rerank["ndcg@10"] == 0.5
    assert (record.n_queries, record.n_corpus, record.rerank_pool) == (5, 9, 100)


def test_blocks_agree_with_broadcast_on_tables(spark, small):
    from tallyloom.plans import bindings

    blocks = retrieval.cosine_topk(
        bindings.query_vectors(spark, small), bindings.doc_vectors(spark, small), 100,
        max_broadcast_queries=1, block_queries=3, block_docs=90,
    )
    assert found(blocks) == found(catalog.cosine_topk(spark, small))


def test_repeated_judgements_and_results_count_once(spark):
    qrels = spark.createDataFrame([("q", "a", 1), ("q", "a", 1), ("q", "b", 1)], "qid string, doc_id string, rel int")
    results = spark.createDataFrame([("s", "q", "a", 0.9), ("s", "q", "a", 0.9)], "system string, qid string, doc_id string, score double")
    row = ranking.query_metrics(qrels, results, [1]).first()
    assert (row.ndcg, row.precision, row.recall) == (1.0, 1.0, 0.5)


@pytest.mark.parametrize("scores, message", [([1.0, 1.0], "repeated rerank score"), ([-2000.0], "too low")])
def test_bad_rerank_scores_are_errors(spark, scores, message):
    ranked = spark.createDataFrame([("q", "a", 0.9, 1)], "qid string, doc_id string, score double, rk int")
    second = spark.createDataFrame([("q", "a", s) for s in scores], "qid string, doc_id string, score double")
    with pytest.raises(Exception, match=message):
        retrieval.merge_rerank(ranked, second, 1).collect()


def test_a_missing_vector_is_an_error(spark):
    queries = spark.createDataFrame([("q", [1.0, 0.0]), ("r", None)], "qid string, embedding array<float>")
    corpus = spark.createDataFrame([("a", [1.0, 0.0])], "doc_id string, embedding array<float>")
    with pytest.raises(Exception, match="no vector for r"):
        retrieval.cosine_topk(queries, corpus, 5).collect()
