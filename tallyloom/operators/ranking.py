"""Ranking metrics at cut-offs, the comparison of two systems, and the improvement gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tallyloom.operators.retrieval import rank_results

# The cut-offs considered, and the slack of the gate.
CUTOFFS = (1, 3, 5, 10, 100, 1000)
GATE_EPSILON = 1e-6
METRICS = ("ndcg", "map", "recall", "precision")
BASELINE, RERANKED = "dense", "rerank"


def k_grid(top_k: int) -> list[int]:
    """The cut-offs up to ``top_k``, with ``top_k`` itself."""
    return sorted({k for k in (*CUTOFFS, top_k) if k <= top_k})


def _discount(position: Column) -> Column:
    return F.log2(position + 1.0)


def _ideal(qrels: DataFrame, on: list[str], ks: list[int]) -> DataFrame:
    """Per query: number of relevant documents and the best possible DCG at each cut-off.

    Judgements are first counted per grade (map-side combined), so a query that owns a third of all judgements is a few
    counters. The ideal list is rebuilt from the counts of the highest grades, no longer than the largest cut-off.
    """
    depth = max(ks)
    grades = qrels.groupBy(*on, "rel").agg(F.count("*").alias("n"))
    relevant = grades.groupBy(*on).agg(F.sum(F.when(F.col("rel") > 0, F.col("n")).otherwise(0)).alias("relevant"))
    place = F.row_number().over(W.Window.partitionBy(*on).orderBy(F.desc("rel")))
    highest = grades.filter(F.col("rel") > 0).withColumn("place", place).filter(F.col("place") <= depth)
    gains = F.flatten(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rel", "n")), asc=False),  # at most ``depth`` grades
            lambda g: F.array_repeat(g["rel"].cast("double"), F.least(g["n"], F.lit(depth)).cast("int")),
        )
    )
    per_query = relevant.join(highest.groupBy(*on).agg(gains.alias("gains")), on, "left").withColumn(
        "gains", F.coalesce("gains", F.array().cast("array<double>"))
    )
    terms = F.transform(F.slice("gains", 1, depth), lambda g, i: g / _discount(i + F.lit(1)))

    def best(k: int) -> Column:
        return F.aggregate(F.slice(F.col("terms"), 1, k), F.lit(0.0), lambda a, b: a + b)

    return per_query.withColumn("terms", terms).select(*on, "relevant", *[best(k).alias(f"ideal_{k}") for k in ks])


def query_metrics(
    qrels: DataFrame, results: DataFrame, ks: list[int], *, ignore_identical_ids: bool = True
) -> DataFrame:
    """``(system, qid, k, ndcg, map, recall, precision)`` for every query with both results and judgements.

    ``qrels`` has ``qid, doc_id, rel``; ``results`` has ``system, qid, doc_id, score``; a ``dataset`` column, if both
    have one, scopes the query ids. Gains are linear with a log2 discount, the ideal is taken over all judgements of the
    query, MAP and recall divide by all relevant documents, precision divides by ``k``. A document whose id equals the
    query's is not a result (``ignore_identical_ids``). Of repeated judgements of one pair the highest counts, and of
    repeated results the best score.
    """
    scope = [c for c in ("dataset",) if c in qrels.columns and c in results.columns]
    on = [*scope, "qid"]
    qrels = qrels.groupBy(*on, "doc_id").agg(F.max("rel").alias("rel"))
    keys = [*scope, "system", "qid"]
    if ignore_identical_ids:
        results = results.filter(F.col("qid").cast("string") != F.col("doc_id").cast("string"))
    results = results.groupBy(*keys, "doc_id").agg(F.max("score").alias("score"))
    ranked = rank_results(results, max(ks), tuple(keys)).select(*keys, "doc_id", "rk")

    # Only hits contribute to a sum, so an inner join is enough and either side may be the broadcast one.
    hits = ranked.join(qrels.filter(F.col("rel") > 0).select(*on, "doc_id", "rel"), [*on, "doc_id"])
    so_far = F.row_number().over(W.Window.partitionBy(*keys).orderBy("rk"))  # at most max(ks) hits per query
    hits = hits.withColumn("precision_here", so_far / F.col("rk")).withColumn("gain", F.col("rel") / _discount(F.col("rk")))

    def upto(k: int, value: Column) -> Column:
        return F.sum(F.when(F.col("rk") <= k, value).otherwise(0.0))

    sums = hits.groupBy(*keys).agg(
        *[
            agg
            for k in ks
            for agg in (
                upto(k, F.lit(1.0)).alias(f"hits_{k}"),
                upto(k, F.col("gain")).alias(f"dcg_{k}"),
                upto(k, F.col("precision_here")).alias(f"ap_{k}"),
            )
        ]
    )
    scored = ranked.filter(F.col("rk") == 1).select(*keys).join(_ideal(qrels, on, ks), on).join(sums, keys, "left")

    def share(numerator: str, denominator: Column) -> Column:
        return F.coalesce(F.try_divide(F.col(numerator), denominator.cast("double")), F.lit(0.0))

    per_k = [
        F.struct(
            F.lit(k).alias("k"),
            share(f"dcg_{k}", F.col(f"ideal_{k}")).alias("ndcg"),
            share(f"ap_{k}", F.col("relevant")).alias("map"),
            share(f"hits_{k}", F.col("relevant")).alias("recall"),
            share(f"hits_{k}", F.lit(k)).alias("precision"),
        )
        for k in ks
    ]
    return scored.select(*keys, F.inline(F.array(*per_k)))


def ranking_metrics(qrels: DataFrame, results: DataFrame, ks: list[int], *, digits: int = 5, **options) -> DataFrame:
    """``(system, k, n_queries, ndcg, map, recall, precision)``: means over the scored queries, to ``digits`` places."""
    per_query = query_metrics(qrels, results, ks, **options)
    by = [c for c in ("dataset", "system", "k") if c in per_query.columns]
    return per_query.groupBy(*by).agg(
        F.count("*").alias("n_queries"), *[F.round(F.avg(m), digits).alias(m) for m in METRICS]
    )


def compare_systems(metrics: DataFrame, baseline: str = BASELINE, improved: str = RERANKED) -> DataFrame:
    """One row per dataset and cut-off with both systems' metrics side by side and the NDCG difference."""
    by = [c for c in ("dataset", "k") if c in metrics.columns]
    wide = metrics.groupBy(*by).agg(
        F.max("n_queries").alias("n_queries"),
        *[
            F.max(F.when(F.col("system") == system, F.col(m))).alias(f"{m}_{system}")
            for system in (baseline, improved)
            for m in METRICS
        ],
    )
    return wide.withColumn("ndcg_delta", F.col(f"ndcg_{improved}") - F.col(f"ndcg_{baseline}"))


def improvement_gate(
    comparison: DataFrame, baseline: str = BASELINE, improved: str = RERANKED, k: int = 10, eps: float = GATE_EPSILON
) -> DataFrame:
    """Per dataset at cut-off ``k``: both NDCG values and whether the improved system is really above the baseline.

    Equal values fail. A dataset without that cut-off counts as 0.0 on both sides, so it fails as well.
    """
    by = [c for c in ("dataset",) if c in comparison.columns]

    def at_k(system: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("k") == k, F.col(f"ndcg_{system}"))), F.lit(0.0))

    gate = comparison.groupBy(*by).agg(at_k(baseline).alias("ndcg_base"), at_k(improved).alias("ndcg_new"))
    return gate.withColumn("passed", F.col("ndcg_new") > F.col("ndcg_base") + eps)


class RegressionError(RuntimeError):
    """The second stage did not improve on the first."""

    exit_code = 2


def enforce_gate(gate: DataFrame, allow_regression: bool = False) -> list[str]:
    """Raise if a dataset fails the gate (one row per dataset), or return the failures when they are allowed."""
    failures = [
        f"{row.asDict().get('dataset', 'dataset')}: {row['ndcg_new']:.5f} <= {row['ndcg_base']:.5f}"
        for row in gate.filter(~F.col("passed")).collect()
    ]
    if failures and not allow_regression:
        raise RegressionError("no improvement in NDCG: " + "; ".join(failures))
    return failures


def comparison_document(comparison: DataFrame, parameters: DataFrame | None = None) -> DataFrame:
    """One record per dataset with both full metric sets as maps keyed ``ndcg@k`` and so on."""
    by = [c for c in ("dataset",) if c in comparison.columns]

    def metric_map(system: str) -> Column:
        entries = [
            F.struct(F.concat(F.lit(f"{m}@"), F.col("k").cast("string")).alias("key"), F.col(f"{m}_{system}").alias("value"))
            for m in METRICS
        ]
        return F.map_from_entries(F.flatten(F.collect_list(F.array(*entries))))  # one entry per cut-off and metric

    systems = [c.removeprefix("ndcg_") for c in comparison.columns if c.startswith("ndcg_") and c != "ndcg_delta"]
    records = comparison.groupBy(*by).agg(
        F.max("n_queries").alias("n_queries"), *[metric_map(s).alias(s) for s in systems]
    )
    return records if parameters is None else records.join(parameters, by, "left")
