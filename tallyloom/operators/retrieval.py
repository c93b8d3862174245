"""Dense retrieval: query subsampling, exact cosine top-k, and the rerank merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from tallyloom.functions import text as X
from tallyloom.functions.topk import TopK, unit_rows
from tallyloom.operators.selection import first_n, seeded_rank

MIN_DEPTH = 100
# Candidates (queries times depth) one task may hold at once.
MAX_KEPT = 2_000_000
# Query vectors sent to every task may not be larger than this.
MAX_BROADCAST_BYTES = 64 << 20
# Fixed value: what a reranked score is raised by, so that heads stay above first-stage tails.
HEAD_OFFSET = 1000.0
LEAST_SECOND = -999.0  # fixed value: scores at or below it would reach the tail


# --- inputs -----------------------------------------------------------------------------------------------------


def subsample_queries(
    queries: DataFrame, qrels: DataFrame, max_queries: int | None, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Queries that have judgements, and the judgements to score them with.

    Without a cap below the number of judged queries every such query is kept and the judgements come back unchanged,
    also for ids without query text. With one, ``max_queries`` queries are drawn by a seeded hash order and the
    judgements are restricted to them.
    """
    judged = qrels.select("qid").distinct()
    known = queries.join(judged, "qid", "left_semi")
    if max_queries is None or max_queries >= judged.count():
        return known, qrels
    ranked = known.withColumn("_rank", seeded_rank(F.col("qid"), seed))
    picked = first_n(ranked, max_queries, "_rank", ["qid"]).drop("_rank")
    return picked, qrels.join(picked.select("qid"), "qid", "left_semi")


def passages(corpus: DataFrame) -> DataFrame:
    """``(doc_id, passage)``: what a reranker reads of each document."""
    return corpus.select("doc_id", X.passage(F.col("title"), F.col("text")).alias("passage"))


# --- exact cosine top-k -----------------------------------------------------------------------------------------


def _with_vectors(rows: DataFrame, key: str) -> DataFrame:
    """Ids and vectors; a missing vector is an error, since the row would silently leave every mean."""
    missing = F.raise_error(F.concat(F.lit("no vector for "), F.col(key).cast("string"))).cast(rows.schema["embedding"].dataType)
    return rows.select(key, F.coalesce("embedding", missing).alias("embedding"))


def search_depth(top_k: int) -> int:
    """Results kept per query: never fewer than 100, because that cut-off is always evaluated."""
    return max(MIN_DEPTH, top_k)


def cosine_topk(
    queries: DataFrame,
    corpus: DataFrame,
    depth: int,
    *,
    digits: int = 6,
    ignore_identical_ids: bool = True,
    max_broadcast_queries: int = 4096,
    block_queries: int = 2048,
    block_docs: int = 50_000,
) -> DataFrame:
    """``(qid, doc_id, score, rk)``: the ``depth`` most similar documents of every query, exactly.

    ``queries`` has ``qid, embedding`` and ``corpus`` has ``doc_id, embedding``. Scores are cosines rounded to
    ``digits``, so that ranks do not hang on summation order; ties go to the smaller ``doc_id``. A document whose id is
    the query's is left out (``ignore_identical_ids``), for collections that are searched with their own members.

    Up to ``max_broadcast_queries`` query vectors travel to the executors, and the corpus is read once, unshuffled,
    as block matrix products that keep only each task's best. More queries than that are cut, like the corpus, into
    hash blocks of bounded size, and every pair of blocks is one task-sized product.
    """
    queries, corpus = _with_vectors(queries, "qid"), _with_vectors(corpus, "doc_id")
    out = T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("doc_id", corpus.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("lane", T.IntegerType()),
        ]
    )
    max_broadcast_queries = max(1, min(max_broadcast_queries, MAX_KEPT // depth))
    block_queries = max(1, min(block_queries, MAX_KEPT // depth))
    kept = depth + int(ignore_identical_ids)  # ids are unique, so at most one document of a query falls away
    spark = corpus.sparkSession
    lanes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    head = queries.limit(max_broadcast_queries + 1).toArrow()
    if head.num_rows <= max_broadcast_queries and head.nbytes <= MAX_BROADCAST_BYTES:
        best = _search_broadcast(spark, head, corpus, out, kept, digits, lanes)
    else:
        best = _search_blocks(queries, corpus, out, kept, digits, block_queries, block_docs, lanes)
    if ignore_identical_ids:
        best = best.filter(F.col("qid").cast("string") != F.col("doc_id").cast("string"))
    # Two steps, so that no task ever ranks the candidates of one query from all tasks at once.
    best = _ranked(best, ["qid", "lane"], depth).drop("rk", "lane")
    return _ranked(best, ["qid"], depth).select("qid", "doc_id", "score", "rk")


def _search_broadcast(spark, head: pa.Table, corpus, out, depth, digits, lanes) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    head = head.combine_chunks()
    vectors = head.column("embedding").chunk(0) if head.num_rows else pa.array([], pa.list_(pa.float64()))
    shared = spark.sparkContext.broadcast((head.column("qid").to_pylist(), unit_rows(vectors)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, units = shared.value
        best = TopK(qids, units, depth, digits)
        for batch in batches:
            if qids and batch.num_rows:
                best.add(batch.column(0), batch.column(1))
        yield from best.table(schema, TaskContext.get().partitionId() % lanes).to_batches()

    return corpus.mapInArrow(search, out)


def _search_blocks(queries, corpus, out, depth, digits, block_queries, block_docs, lanes) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    q_blocks = max(1, -(-queries.count() // block_queries))
    d_blocks = max(1, -(-corpus.count() // block_docs))

    def block(key: str, count: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    q = queries.withColumn("qb", block("qid", q_blocks)).withColumn("db", every(d_blocks))
    d = corpus.withColumn("db", block("doc_id", d_blocks)).withColumn("qb", every(q_blocks))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        best = TopK(left.column("qid").to_pylist(), unit_rows(left.column("embedding").chunk(0)), depth, digits)
        best.add(right.column("doc_id").chunk(0), right.column("embedding").chunk(0))
        return best.table(schema, right.column("db")[0].as_py() % lanes)

    return q.groupBy("qb", "db").cogroup(d.groupBy("qb", "db")).applyInArrow(search, out)


def _ranked(results: DataFrame, by: list[str], depth: int | None) -> DataFrame:
    order = W.Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    ranked = results.withColumn("rk", F.row_number().over(order))
    return ranked if depth is None else ranked.filter(F.col("rk") <= depth)


def rank_results(results: DataFrame, depth: int | None = None, by: tuple[str, ...] = ("qid",)) -> DataFrame:
    """Adds ``rk``: score descending, then document id. Result lists are bounded by the search depth."""
    return _ranked(results, list(by), depth)


# --- second stage -----------------------------------------------------------------------------------------------


def score_pairs(
    ranked: DataFrame,
    queries: DataFrame,
    corpus: DataFrame,
    pool: int,
    load_scorer: Callable[[], Callable[[list[str], list[str]], list[float]]],
    batch_size: int = 64,
) -> DataFrame:
    """``(qid, doc_id, score)`` of the heads from a user's reranking model.

    ``load_scorer`` runs once per Python worker and returns ``scorer(query_texts, passages) -> scores``, which gets at
    most ``batch_size`` pairs of like length at a time, so that a padded model wastes little. Only the heads are joined
    to their texts; a head without a query text or a passage is an error.
    """

    def make_predict():
        scorer = load_scorer()

        def predict(texts: np.ndarray, docs: np.ndarray) -> np.ndarray:
            return np.asarray(scorer(list(texts), list(docs)), dtype=np.float64)

        return predict

    score = predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size)

    def required(column: str, key: str) -> Column:
        return F.coalesce(F.col(column), F.raise_error(F.concat(F.lit(f"no {column} for "), F.col(key).cast("string"))).cast("string"))

    heads = ranked.filter(F.col("rk") <= pool).select("qid", "doc_id")
    with_text = heads.join(queries.select("qid", F.col("text").alias("query_text")), "qid", "left")
    with_text = with_text.join(passages(corpus), "doc_id", "left")
    pairs = with_text.select("qid", "doc_id", required("query_text", "qid").alias("query_text"), required("passage", "doc_id").alias("passage"))
    alike = pairs.sortWithinPartitions(F.length("passage") + F.length("query_text"))
    return alike.select("qid", "doc_id", score("query_text", "passage").alias("score"))


def merge_rerank(ranked: DataFrame, rerank_scores: DataFrame, pool: int) -> DataFrame:
    """``(qid, doc_id, score, rk)`` after reranking the first ``pool`` results of each query.

    A head's score becomes 1000 plus its second-stage score, the tail keeps its own. A head without a second-stage
    score is an error, and so are two scores of one pair and a score that would sink a head below a tail. With an empty pool the first-stage ranking is returned as it is.
    """
    pair = F.concat(F.col("qid").cast("string"), F.lit(" / "), F.col("doc_id").cast("string"))
    second = rerank_scores.groupBy("qid", "doc_id").agg(F.max("score").alias("second"), F.count("*").alias("given"))
    wrong = (
        F.when(F.col("given") > 1, F.raise_error(F.concat(F.lit("repeated rerank score for "), pair)).cast("double"))
        .when(F.col("second") <= LEAST_SECOND, F.raise_error(F.concat(F.lit("rerank score too low for "), pair)).cast("double"))
        .otherwise(F.col("second"))
    )
    second = second.select("qid", "doc_id", wrong.alias("second"))
    head = F.col("rk") <= pool
    missing = F.raise_error(F.concat(F.lit("no rerank score for "), pair))
    raised = F.lit(HEAD_OFFSET) + F.coalesce(F.col("second"), missing.cast("double"))
    merged = ranked.join(second, ["qid", "doc_id"], "left").select(
        "qid", "doc_id", F.when(head, raised).otherwise(F.col("score")).alias("score")
    )
    return rank_results(merged)
