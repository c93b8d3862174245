"""The jobs a user runs: export, quality report, findings, retrieval comparison, evaluation comparison."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import evalruns, export, fingerprint, quality, ranking, retrieval
from tallyloom.plans.recipe import Recipe, Source
from tallyloom.session import materialize
from tallyloom.sources import evaljson, exporter, readers, writers

EXPORT_SCHEMAS = {"sft": readers.SFT_EXPORT, "dpo": readers.DPO_EXPORT, "cpt": readers.CPT_EXPORT}


@dataclass(frozen=True)
class ExportResult:
    paths: dict[str, str]
    rows: dict[str, int]
    manifest_path: str
    descriptor_path: str


def _sources(spark: SparkSession, lines: list[tuple[str, Source, int, int]]) -> DataFrame:
    return spark.createDataFrame(
        [(role, s.location, s.config, s.split, s.revision, s.resolved, raw, exported) for role, s, raw, exported in lines],
        "role STRING, location STRING, config STRING, split STRING, revision_requested STRING, revision_resolved STRING, "
        "raw_rows BIGINT, exported_rows BIGINT",
    )


def _exports(spark: SparkSession, written: dict[str, list[exporter.File]]) -> DataFrame:
    rows = [
        (role, f"{role}.jsonl", str(sum(int(f.digest) for f in files)), sum(f.bytes for f in files), sum(f.rows for f in files),
         [(f.file, f.bytes, f.rows, f.sha256) for f in files])
        for role, files in written.items()
    ]
    return spark.createDataFrame(
        rows,
        "name STRING, path STRING, digest STRING, bytes BIGINT, rows BIGINT, "
        "files ARRAY<STRUCT<file: STRING, bytes: BIGINT, rows: BIGINT, sha256: STRING>>",
    )


def export_frames(
    spark: SparkSession,
    out: str,
    raws: dict[str, DataFrame],
    frames: dict[str, DataFrame],
    recipe: Recipe,
    allow_empty: bool = False,
    ordered: bool = True,
    git_commit: str | None = None,
    overwrite: bool = False,
) -> ExportResult:
    """Write and describe the exports of one folder (``frames`` by role, made from ``raws``), all or nothing.

    The folder is built beside ``out`` and takes its place when everything in it is written, the manifest last; an empty
    export or a failure leaves what was there before. Rows, bytes and hashes are those the writing tasks counted, so
    nothing is read back. ``overwrite`` replaces an earlier folder.
    """
    written, lines = {}, []
    with exporter.published(out, overwrite) as stage:
        for role, frame in frames.items():
            columns = [part.split()[0] for part in EXPORT_SCHEMAS[role].split(", ")]
            hashed = fingerprint.row_hash(*[F.col(c) for c in columns])
            files = exporter.write_lines(frame, f"{stage}/{role}.jsonl", hashed, columns=columns, order_by="pos" if ordered else None)
            exported = sum(f.rows for f in files)
            export.require_rows(exported, role, allow_empty)
            written[role] = files
            lines.append((role, recipe.sources.get(role, Source()), raws[role].count(), exported))
        document = fingerprint.manifest(
            spark,
            _sources(spark, lines),
            _exports(spark, written),
            recipe_id=recipe.recipe_id,
            min_chars=recipe.min_chars,
            max_chars=recipe.max_chars,
            policy_version=recipe.policy_version,
            git_commit=git_commit,
            recipe_path=recipe.path,
        )
        writers.write_descriptor({role: (role, f"{role}.jsonl") for role in frames}, f"{stage}/dataset_info.json")
        exporter.write_file(f"{stage}/manifest.json", fingerprint.as_json(document) + "\n")
    paths = {role: f"{out}/{role}.jsonl" for role in frames}
    rows = {role: sum(f.rows for f in files) for role, files in written.items()}
    return ExportResult(paths, rows, f"{out}/manifest.json", f"{out}/dataset_info.json")


def export_training_sets(
    spark: SparkSession,
    sft_raw: DataFrame,
    prefs_raw: DataFrame,
    recipe: Recipe,
    out: str,
    *,
    max_sft: int | None = None,
    max_dpo: int | None = None,
    allow_empty: bool = False,
    ordered: bool = True,
    git_commit: str | None = None,
    overwrite: bool = False,
) -> ExportResult:
    """Instruction and preference exports as JSONL with descriptor and manifest. A given cap overrides the recipe's."""
    frames = {
        "sft": export.sft_examples(
            sft_raw, recipe.min_chars, recipe.max_chars, recipe.max_sft_rows if max_sft is None else max_sft
        ),
        "dpo": export.dpo_pairs(
            prefs_raw, recipe.min_chars, recipe.max_chars, recipe.max_dpo_rows if max_dpo is None else max_dpo
        ),
    }
    raws = {"sft": sft_raw, "dpo": prefs_raw}
    return export_frames(spark, out, raws, frames, recipe, allow_empty, ordered, git_commit, overwrite)


def export_raw_text(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    *,
    source: Source = Source(),
    recipe_id: str = "cpt",
    min_chars: int = 80,
    max_chars: int | None = None,
    max_docs: int | None = None,
    ordered: bool = True,
    overwrite: bool = False,
) -> ExportResult:
    """Raw-text export for continued pretraining. An empty result is always an error here."""
    recipe = Recipe(recipe_id, min_chars, max_chars or export.NO_UPPER_BOUND, sources={"cpt": source})
    frames = {"cpt": export.cpt_corpus(raw, min_chars, max_chars, max_docs)}
    return export_frames(spark, out, {"cpt": raw}, frames, recipe, False, ordered, None, overwrite)


def quality_report(spark: SparkSession, sft_path: str, dpo_path: str) -> DataFrame:
    """The QA document of two written exports."""
    sft = quality.sft_report(readers.read_export(spark, sft_path, readers.SFT_EXPORT))
    dpo = quality.dpo_report(readers.read_export(spark, dpo_path, readers.DPO_EXPORT))
    return fingerprint.quality_document(sft, dpo, {"sft": sft_path, "dpo": dpo_path})


def findings(quality_doc: DataFrame) -> DataFrame:
    """Both reports of a QA document as readable lines."""
    return quality.findings_long(quality_doc.select("sft.*"), "sft").unionByName(
        quality.findings_long(quality_doc.select("dpo.*"), "dpo")
    )


@dataclass(frozen=True)
class RetrievalSettings:
    top_k: int = 1000
    rerank_pool: int = 100
    max_queries: int | None = None
    seed: int = 0


def retrieval_runs(
    query_vectors: DataFrame, doc_vectors: DataFrame, rerank_scores, settings: RetrievalSettings
) -> DataFrame:
    """``(system, qid, doc_id, score)`` of the dense ranking and of the reranked one.

    The search runs once; its bounded result is written to the shared folder, because both systems and the metrics read
    it. ``rerank_scores`` is a table, or a function from the ranking to one.
    """
    ranked = materialize(
        retrieval.cosine_topk(query_vectors, doc_vectors, retrieval.search_depth(settings.top_k)), "ranking"
    )
    second = rerank_scores(ranked) if callable(rerank_scores) else rerank_scores
    merged = retrieval.merge_rerank(ranked, second, settings.rerank_pool)
    columns = ["system", "qid", "doc_id", "score"]
    return (
        ranked.withColumn("system", F.lit(ranking.BASELINE))
        .select(*columns)
        .unionByName(merged.withColumn("system", F.lit(ranking.RERANKED)).select(*columns))
    )


def retrieval_comparison(
    dataset: str,
    queries: DataFrame,
    qrels: DataFrame,
    query_vectors: DataFrame,
    doc_vectors: DataFrame,
    rerank_scores,
    settings: RetrievalSettings = RetrievalSettings(),
) -> DataFrame:
    """Both systems' metrics per cut-off for one dataset."""
    queries, qrels = retrieval.subsample_queries(queries, qrels, settings.max_queries, settings.seed)
    vectors = query_vectors.join(queries.select("qid"), "qid", "left_semi")
    runs = retrieval_runs(vectors, doc_vectors, rerank_scores, settings)
    metrics = ranking.ranking_metrics(qrels, runs, ranking.k_grid(settings.top_k))
    return ranking.compare_systems(metrics).withColumn("dataset", F.lit(dataset))


def comparison_parameters(
    spark: SparkSession, dataset: str, n_corpus: int, settings: RetrievalSettings, bi_encoder: str, cross_encoder: str
) -> DataFrame:
    """The parameter columns of a comparison record."""
    return spark.createDataFrame(
        [
            (
                dataset, n_corpus, bi_encoder, cross_encoder, settings.top_k, settings.rerank_pool,
                settings.max_queries, settings.seed,
            )
        ],
        "dataset STRING, n_corpus BIGINT, bi_encoder STRING, cross_encoder STRING, first_stage_top_k INT, "
        "rerank_pool INT, max_queries INT, seed INT",
    )


def eval_comparison(spark: SparkSession, run_arguments: list[str]) -> DataFrame:
    """The comparison table of ``NAME=PATH`` result files, ordered by task."""
    runs = evaljson.parse_run_arguments(run_arguments)
    picked = evalruns.pick_metric(evaljson.read_eval_runs(spark, runs))
    evalruns.require_tasks(picked)
    return evalruns.compare_runs(picked, list(runs)).orderBy("task")


def eval_summary(spark: SparkSession, path: str, run: str = "run") -> DataFrame:
    """The summary of one result file."""
    return evalruns.summarise_run(evaljson.read_eval_runs(spark, {run: path}))
