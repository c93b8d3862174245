"""The registered queries: every operator on the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions.messages import last_assistant
from tallyloom.operators import batches, curate, digests, evalruns, export, fingerprint, margins, quality, ranking, retrieval, selection, synthetic
from tallyloom.plans import bindings as B
from tallyloom.plans import jobs
from tallyloom.plans.recipe import Recipe
from tallyloom.session import materialize, scratch_path
from tallyloom.sources import evaljson, lines, readers, writers

SFT_MIN, SFT_MAX = 200, 1500
DPO_MIN, DPO_MAX = 300, 3000
SFT_CAP, DPO_CAP, CPT_CAP = 100, 50, 500
CPT_MAX = 8000
EVENT_CAP = 1500
SHARE, FRACTION_SEED = 0.5, 7
LANG_QUOTA, BALANCE_SEED = 150, 3
RAREST_SHARE = 0.75
LONG_TEXT, ARM_DIGITS = 1500, 1
KEY_BUCKETS = 16
MAX_QUERIES, QUERY_SEED = 100, 0
SEARCH = jobs.RetrievalSettings(top_k=100, rerank_pool=20)
SFT_COLUMNS = ["instruction", "input", "output"]
DPO_COLUMNS = ["instruction", "input", "chosen", "rejected"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# --- exports ----------------------------------------------------------------------------------------------------


@query
def sft_examples(spark: SparkSession, folder: str) -> DataFrame:
    return export.sft_examples(B.sft_raw(spark, folder), SFT_MIN, SFT_MAX)


@query
def sft_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return export.sft_examples(B.sft_raw(spark, folder), SFT_MIN, SFT_MAX, SFT_CAP)


@query
def dpo_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return export.dpo_pairs(B.prefs_raw(spark, folder), DPO_MIN, DPO_MAX)


@query
def dpo_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return export.dpo_pairs(B.prefs_raw(spark, folder), DPO_MIN, DPO_MAX, DPO_CAP)


@query
def cpt_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return export.cpt_corpus(B.cpt_raw(spark, folder), max_chars=CPT_MAX)


@query
def cpt_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return export.cpt_corpus(B.cpt_raw(spark, folder), max_chars=CPT_MAX, cap=CPT_CAP)


@query
def drop_reasons(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        export.drop_reasons(rows, rules).select(F.lit(role).alias("role"), "reason", "rows")
        for role, rows, rules in _exports(spark, folder)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def row_accounting(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [export.row_accounting(role, rows, rules) for role, rows, rules in _exports(spark, folder)],
    )


def _exports(spark: SparkSession, folder: str):
    return [
        ("sft", export.project_sft(B.sft_raw(spark, folder)), export.sft_rules(SFT_MIN, SFT_MAX)),
        ("dpo", export.project_dpo(B.prefs_raw(spark, folder)), export.dpo_rules(DPO_MIN, DPO_MAX)),
        ("cpt", export.project_cpt(B.cpt_raw(spark, folder)), export.cpt_rules()),
    ]


@query
def last_assistant_text(spark: SparkSession, folder: str) -> DataFrame:
    prefs = B.prefs_raw(spark, folder)
    kind = prefs.schema["chosen"].dataType
    return prefs.select(
        "pos",
        last_assistant(F.col("chosen"), kind).alias("chosen"),
        last_assistant(F.col("rejected"), kind).alias("rejected"),
    )


@query
def chunked_content(spark: SparkSession, folder: str) -> DataFrame:
    messages = B.chunked_messages(spark, folder)
    return messages.select(
        "doc_id", last_assistant(F.col("messages"), messages.schema["messages"].dataType).alias("content")
    )


@query
def jsonl_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dpo.jsonl")
    writers.write_jsonl(dpo_pairs(spark, folder), path)
    return readers.read_export(spark, path, readers.DPO_EXPORT)


@query
def export_file_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "cpt.jsonl")
    writers.write_jsonl(cpt_corpus(spark, folder), path, max_rows_per_file=100)
    hashed = fingerprint.file_hashes(spark, path)
    return hashed.agg(F.sum("rows").alias("rows"), F.min(F.length("sha256")).alias("hash_length"))


def _exported(spark: SparkSession, folder: str) -> jobs.ExportResult:
    """The three exports of the given tables as one published folder."""
    raws = {"sft": B.sft_raw(spark, folder), "dpo": B.prefs_raw(spark, folder), "cpt": B.cpt_raw(spark, folder)}
    frames = {"sft": sft_examples(spark, folder), "dpo": dpo_pairs(spark, folder), "cpt": cpt_corpus(spark, folder)}
    return jobs.export_frames(spark, scratch_path(spark, "exports"), raws, frames, Recipe("tables"))


_WRITTEN = "exports ARRAY<STRUCT<name: STRING, digest: STRING, rows: BIGINT, files: ARRAY<STRUCT<file: STRING, bytes: BIGINT, rows: BIGINT, sha256: STRING>>>>"


@query
def manifest_files(spark: SparkSession, folder: str) -> DataFrame:
    """What the manifest says of an export's files, held against the files themselves."""
    done = _exported(spark, folder)
    listed = spark.read.schema(_WRITTEN).json(done.manifest_path).select(F.inline("exports")).select("name", "digest", F.inline("files"))
    found = reduce(DataFrame.unionByName, [fingerprint.file_hashes(spark, p) for p in done.paths.values()])
    found = found.select(F.regexp_extract("path", r"([^/]+)\.jsonl/[^/]+$", 1).alias("name"), F.regexp_extract("path", r"[^/]+$", 0).alias("file"), F.struct("bytes", "rows", "sha256").alias("own"))
    same = F.coalesce(F.col("own") == F.struct("bytes", "rows", "sha256"), F.lit(False))
    return listed.join(found, ["name", "file"], "full").groupBy("name").agg(
        F.max("digest").alias("digest"), F.sum("rows").alias("rows"), F.count_if(~same).alias("files_that_differ")
    )


@query
def export_descriptor(spark: SparkSession, folder: str) -> DataFrame:
    """The descriptor as a trainer reads it, with the rows of the files it names."""
    done = _exported(spark, folder)
    entry = "STRUCT<file_name: STRING, formatting: STRING, ranking: BOOLEAN, columns: MAP<STRING, STRING>>"
    text = spark.read.text(done.descriptor_path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", f"MAP<STRING, {entry}>")).alias("name", "e")).select("name", "e.*")
    rows = reduce(DataFrame.unionByName, [spark.read.text(p).select(F.lit(f"{k}.jsonl").alias("file_name")) for k, p in done.paths.items()])
    counted = rows.groupBy("file_name").agg(F.count("*").alias("rows"))
    return entries.join(counted, "file_name").select(
        "name", F.col("file_name").alias("file"), "formatting", "ranking", F.explode("columns").alias("role", "column"), "rows"
    )


# --- sources as files -------------------------------------------------------------------------------------------


def _as_json_lines(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    rows.write.json(path)
    return path


@query
def sft_from_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A capped export of JSON lines without a position field, written in order and read in small ranges."""
    path = scratch_path(spark, "sft-lines")
    writers.write_jsonl(B.sft_raw(spark, folder), path, max_rows_per_file=200)
    raw = lines.read_json_lines(spark, path, readers.SFT_SOURCE, split_bytes=1 << 20)
    return export.sft_examples(raw, SFT_MIN, SFT_MAX, SFT_CAP).drop("pos")


@query
def sft_from_files(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_json_lines(spark, B.sft_raw(spark, folder), "sft-source")
    return export.sft_examples(readers.read_sft(spark, path), SFT_MIN, SFT_MAX)


@query
def dpo_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The message lists come back as VARIANT."""
    path = _as_json_lines(spark, B.prefs_raw(spark, folder), "prefs-source")
    return export.dpo_pairs(readers.read_preferences(spark, path), DPO_MIN, DPO_MAX)


@query
def cpt_from_files(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_json_lines(spark, B.cpt_raw(spark, folder), "texts-source")
    return export.cpt_corpus(readers.read_texts(spark, path), max_chars=CPT_MAX)


@query
def judged_passages_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus, queries and judgements read back as a retrieval collection: what a reranker reads of each judged document."""
    tables = [B.corpus(spark, folder), B.label_queries(spark, folder), B.label_qrels(spark, folder)]
    paths = [_as_json_lines(spark, t, name) for t, name in zip(tables, ("corpus", "queries", "qrels"), strict=True)]
    corpus, queries, qrels = readers.read_retrieval(spark, *paths, fmt="json")
    known, judged = retrieval.subsample_queries(queries, qrels, None)
    asked = judged.join(known.select("qid"), "qid", "left_semi")
    return retrieval.passages(corpus).join(asked, "doc_id").select("qid", "doc_id", "rel", "passage")


# --- row features -----------------------------------------------------------------------------------------------


@query
def normalised_keys(spark: SparkSession, folder: str) -> DataFrame:
    return B.documents(spark, folder).select("doc_id", X.norm_key(F.col("text")).alias("norm_key"))


@query
def trigram_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = B.documents(spark, folder)
    return documents.select("doc_id", F.round(X.trigram_repetition(F.col("text")), 6).alias("score"))


@query
def stripped_text(spark: SparkSession, folder: str) -> DataFrame:
    """Strip under padding: every page between a no-break space, line ends and an ideographic space."""
    pages = B.table(spark, folder, "pages")
    padded = F.concat(F.lit(" \n\t"), F.col("html"), F.lit("　\x1f\n"))
    return pages.select("page_id", F.sha2(X.strip(padded), 256).alias("stripped"))


@query
def text_lengths(spark: SparkSession, folder: str) -> DataFrame:
    rows = export.project_sft(B.sft_raw(spark, folder))
    lengths = [F.length(c) for c in SFT_COLUMNS]
    return rows.select(
        "pos",
        lengths[2].alias("output_chars"),
        (lengths[0] + lengths[1] + lengths[2]).alias("total_chars"),
        export.sft_length().alias("filter_chars"),
    )


@query
def pair_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    pairs = quality.pair_diagnostics(dpo_pairs(spark, folder))
    return pairs.select("pos", "len_diff", "chosen_longer", "shared_prefix")


@query
def document_passages(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.passages(B.corpus(spark, folder))


# --- quality ----------------------------------------------------------------------------------------------------


@query
def length_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.length_report(B.table(spark, folder, "documents"), F.length("text"))
    return rounded(report, "p50", "p90", "p95", "p99", "mean")


@query
def duplicate_rate(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.duplicate_stats(B.documents(spark, folder), X.norm_key_bytes(F.col("text")))
    return rounded(stats, "duplicate_fraction")


@query
def sft_quality(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.findings_long(quality.sft_report(sft_examples(spark, folder)), "sft"), "value")


@query
def dpo_quality(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.findings_long(quality.dpo_report(dpo_pairs(spark, folder)), "dpo"), "value")


@query
def part_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every source and all of them, from stored histograms: the documents are read once, part by part."""
    path = scratch_path(spark, "cells")
    quality.store_cells(quality.text_cells(B.table(spark, folder, "documents"), part=F.col("source")), path)
    reports = quality.union_reports(quality.stored_cells(spark, path), F.array("part", F.lit("all")), quality.text_findings())
    return rounded(quality.findings_long(reports, F.col("of")), "value")


@query
def content_digests(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        ("sft", sft_examples, SFT_COLUMNS),
        ("dpo", dpo_pairs, DPO_COLUMNS),
        ("cpt", cpt_corpus, ["text"]),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            fingerprint.content_digest(build(spark, folder), cols).select(F.lit(role).alias("role"), "rows", "digest")
            for role, build, cols in parts
        ],
    )


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.manifest(
        spark,
        row_accounting(spark, folder),
        content_digests(spark, folder),
        recipe_id="tables",
        min_chars=SFT_MIN,
        max_chars=SFT_MAX,
    )


@query
def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    document = _manifest(spark, folder)
    sources = document.select("recipe_id", "schema_version", F.inline("sources"))
    exports = document.select(F.inline("exports")).select("role", "digest")
    return sources.join(exports, "role")


@query
def metrics_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    report = fingerprint.quality_document(
        quality.sft_report(sft_examples(spark, folder)), quality.dpo_report(dpo_pairs(spark, folder))
    )
    shot = fingerprint.snapshot(report, _manifest(spark, folder))
    flat = shot.select(
        "export.recipe_id",
        "export.sft_rows",
        "export.dpo_rows",
        F.col(f"sft.{quality.OUTPUT_LENGTH}.mean").alias("sft_output_mean"),
        F.col(f"dpo.{quality.CHOSEN_LENGTH}.p95").alias("dpo_chosen_p95"),
        F.col(f"dpo.{quality.CHOSEN_LONGER}").alias("dpo_chosen_longer"),
    )
    return rounded(flat, "sft_output_mean", "dpo_chosen_p95", "dpo_chosen_longer")


# --- retrieval --------------------------------------------------------------------------------------------------


@query
def sampled_queries(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.subsample_queries(
        B.label_queries(spark, folder), B.label_qrels(spark, folder), MAX_QUERIES, QUERY_SEED
    )[0]


@query
def sampled_qrels(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.subsample_queries(
        B.label_queries(spark, folder), B.label_qrels(spark, folder), MAX_QUERIES, QUERY_SEED
    )[1]


@query
def cosine_topk(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.cosine_topk(
        B.query_vectors(spark, folder), B.doc_vectors(spark, folder), retrieval.search_depth(SEARCH.top_k)
    )


@query
def reranked(spark: SparkSession, folder: str) -> DataFrame:
    ranked = materialize(cosine_topk(spark, folder), "ranking")
    return rounded(retrieval.merge_rerank(ranked, B.rerank_scores(ranked), SEARCH.rerank_pool), "score")


def load_letter_scorer():
    """A stated scorer in place of a model: the share of a passage's characters that occur in the query."""

    def score(texts: list[str], passages: list[str]) -> list[float]:
        return [sum(p.count(c) for c in set(q)) / (1 + len(p)) for q, p in zip(texts, passages, strict=True)]

    return score


@query
def scored_heads(spark: SparkSession, folder: str) -> DataFrame:
    """The heads of the ranking scored from query and passage text inside the engine."""
    ranked = materialize(cosine_topk(spark, folder), "ranking")
    queries, corpus = B.topic_queries(spark, folder), B.vector_passages(spark, folder)
    return rounded(retrieval.score_pairs(ranked, queries, corpus, SEARCH.rerank_pool, load_letter_scorer), "score")


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    runs = jobs.retrieval_runs(B.query_vectors(spark, folder), B.doc_vectors(spark, folder), B.rerank_scores, SEARCH)
    return ranking.ranking_metrics(B.topic_qrels(spark, folder), runs, ranking.k_grid(SEARCH.top_k))


@query
def ranking_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics(spark, folder)


def _comparison(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.retrieval_comparison(
        "topics",
        B.topic_queries(spark, folder),
        B.topic_qrels(spark, folder),
        B.query_vectors(spark, folder),
        B.doc_vectors(spark, folder),
        B.rerank_scores,
        SEARCH,
    )


@query
def system_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_comparison(spark, folder), "ndcg_delta", digits=5)


@query
def comparison_records(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison document of each dataset, its metric sets as lines."""
    records = ranking.comparison_document(_comparison(spark, folder))
    sets = [F.struct(F.lit(s).alias("system"), F.col(s).alias("metrics")) for s in (ranking.BASELINE, ranking.RERANKED)]
    one = records.select("dataset", "n_queries", F.explode(F.array(*sets)).alias("s"))
    return one.select("dataset", "n_queries", "s.system", F.explode("s.metrics").alias("metric", "value"))


@query
def improvement_gate(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.improvement_gate(_comparison(spark, folder))


# --- evaluation runs --------------------------------------------------------------------------------------------


def _eval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaljson.eval_metrics(B.eval_documents(spark, folder))


@query
def eval_numbers(spark: SparkSession, folder: str) -> DataFrame:
    metrics = _eval_metrics(spark, folder).filter(F.col("number").isNotNull())
    return rounded(metrics.select("run", "model_args", "task", "pos", "metric", "number"), "number")


@query
def eval_files(spark: SparkSession, folder: str) -> DataFrame:
    """Result files written below the shared folder, two generations of each run; the newest of each is found again,
    and all are read by one scan."""
    root = scratch_path(spark, "eval")
    documents = materialize(B.eval_documents(spark, folder), "eval-documents")
    stale = documents.select("run", F.regexp_replace("document", '"acc', '"stale').alias("document"))
    stale.write.partitionBy("run").text(root)
    documents.write.mode("append").partitionBy("run").text(root)
    newest = writers.newest_files(spark, root, r"/run=([^/]+)/part-[^/]*$")
    runs = {row.stem: row.path for row in newest.collect()}  # one short line per run
    picked = evalruns.pick_metric(evaljson.read_eval_runs(spark, runs))
    return rounded(picked.select("run", "task", "metric", "value"), "value")


@query
def eval_pick_strict(spark: SparkSession, folder: str) -> DataFrame:
    picked = evalruns.pick_metric(_eval_metrics(spark, folder), strict=True)
    return rounded(picked.select("run", "task", "metric", "value"), "value")


@query
def eval_summary(spark: SparkSession, folder: str) -> DataFrame:
    return evalruns.summarise_run(_eval_metrics(spark, folder)).select("run", "task", "metric", "display")


@query
def eval_comparison(spark: SparkSession, folder: str) -> DataFrame:
    picked = evalruns.pick_metric(_eval_metrics(spark, folder))
    compared = evalruns.compare_runs(picked, B.EVAL_RUNS)
    return rounded(compared, *[f"{r}_value" for r in B.EVAL_RUNS], "delta_last_minus_first")


# --- curation ---------------------------------------------------------------------------------------------------


@query
def event_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A cap of more than a thousand rows, over positions with ties (users) that the event id breaks."""
    events = B.table(spark, folder, "events").select("user_id", "event_id")
    return selection.first_n(events, EVENT_CAP, "user_id", ["event_id"])


@query
def deduplicated_documents(spark: SparkSession, folder: str) -> DataFrame:
    return curate.deduplicate(B.documents(spark, folder), X.norm_key_bytes(F.col("text")), "doc_id").select("doc_id")


@query
def deduplicated_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in two batches by document number, each deduplicated against what was kept before it."""
    rows = B.documents(spark, folder)
    middle = rows.agg(F.expr("(min(doc_id) + max(doc_id)) div 2")).first()[0] or 0
    table = f"kept_{uuid.uuid4().hex}"
    batches.create_key_table(spark, table, scratch_path(spark, "keys"), KEY_BUCKETS)
    key = X.norm_key_bytes(F.col("text"))
    halves = [rows.filter(F.col("doc_id") <= middle), rows.filter(F.col("doc_id") > middle)]
    found = [batches.add_batch(half, key, table, str(i), "doc_id").select("doc_id") for i, half in enumerate(halves)]
    spark.sql(f"DROP TABLE {table}")  # of the catalogue; its files are the shared folder's
    return found[0].unionByName(found[1])


@query
def half_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = B.table(spark, folder, "documents").select("doc_id", "lang")
    return selection.stable_fraction(documents, "doc_id", SHARE, FRACTION_SEED)


@query
def balanced_languages(spark: SparkSession, folder: str) -> DataFrame:
    documents = B.table(spark, folder, "documents").select("doc_id", "lang")
    return curate.balance(documents, "lang", "doc_id", LANG_QUOTA, BALANCE_SEED)


@query
def balanced_margins(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per language and per source of a corpus balanced along both: three quarters of the rarest language's rows
    for every language, and as many for every source."""
    documents = B.table(spark, folder, "documents").select("doc_id", "lang", "source")
    per_lang = documents.groupBy("lang").count().agg(F.min("count").alias("least"), F.count("*").alias("n")).first()
    total = int(RAREST_SHARE * (per_lang.least or 0)) * per_lang.n
    kept = margins.balance_margins(documents, "lang", "source", "doc_id", total, seed=BALANCE_SEED)
    axes = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in ("lang", "source")]))
    return kept.select(axes.alias("a")).groupBy("a.axis", "a.value").agg(F.count("*").alias("rows"))


@query
def arm_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against those that deduplication leaves."""

    def findings(rows: DataFrame) -> DataFrame:
        report = quality.length_report(rows.select("text"), F.length("text"))
        return quality.findings_long(report, "documents")

    rows = B.documents(spark, folder)
    kept = curate.deduplicate(rows, X.norm_key_bytes(F.col("text")), "doc_id")
    compared = curate.compare_arms({"before": findings(rows), "after": findings(kept)}, ("metric",))
    return rounded(compared, "before", "after", "delta")


@query
def arm_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that a deduplicated arm, with the language of its long texts taken back, does not share with all documents."""
    rows = B.table(spark, folder, "documents")
    kept = curate.deduplicate(rows, X.norm_key_bytes(F.col("text")), "doc_id")
    lang = F.when(F.length("text") > LONG_TEXT, F.lit(None)).otherwise(F.col("lang")).alias("lang")
    before, after = scratch_path(spark, "arm"), scratch_path(spark, "arm")
    cols = ["doc_id", "lang", "source"]
    digests.store_arm(rows.select(*cols), cols, before, ARM_DIGITS)
    digests.store_arm(kept.select("doc_id", lang, "source"), cols, after, ARM_DIGITS)
    return digests.compare_stored(spark, before, after, "doc_id bigint, lang string, source string", ARM_DIGITS)


@query
def seed_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Mean length per source as the metric of a run, languages as recipes, document numbers as seeds."""
    run = F.concat("lang", F.lit("_seed"), (F.col("doc_id") % 3).cast("string"))
    documents = B.table(spark, folder, "documents").select(run.alias("run"), F.col("source").alias("task"), "n_chars")
    picked = documents.groupBy("run", "task").agg(F.avg("n_chars").alias("value"))
    return rounded(evalruns.seed_statistics(picked), "mean", "spread")


# --- generated pairs --------------------------------------------------------------------------------------------


@query
def synthetic_pairs(spark: SparkSession, folder: str) -> DataFrame:
    numbers = B.table(spark, folder, "documents").select(F.col("doc_id").alias("i"))
    return synthetic.synthetic_pairs(numbers)
