"""Command line of the jobs: ``spark-submit`` this file or run ``python -m tallyloom``.

Results are folders of JSON lines. Exit code 2 means an empty export, no tasks, or a second stage that did not improve.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import evalruns, export, fingerprint, quality, ranking, synthetic
from tallyloom.plans import jobs
from tallyloom.plans.recipe import Recipe
from tallyloom.session import materialize
from tallyloom.sources import evaljson, readers, writers


def load_recipe(path: str) -> Recipe:
    """A recipe from a JSON file, or from YAML where a YAML parser is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise SystemExit("a YAML recipe needs the yaml package; JSON recipes need nothing") from missing
        return Recipe.from_mapping(yaml.safe_load(text), path)
    return Recipe.from_mapping(json.loads(text), path)


def _source(spark: SparkSession, read, path: str, args) -> DataFrame:
    if args.order == "file" or args.order == "scan" and args.format != "json":
        return readers.read_in_file_order(spark, path)
    return read(spark, path, args.format, order="lines" if args.order == "scan" else "field")


def _export(spark: SparkSession, args) -> None:
    jobs.export_training_sets(
        spark,
        _source(spark, readers.read_sft, args.sft, args),
        _source(spark, readers.read_preferences, args.prefs, args),
        load_recipe(args.recipe),
        args.out,
        max_sft=args.max_sft,
        max_dpo=args.max_dpo,
        allow_empty=args.allow_empty,
        ordered=not args.unordered,
        overwrite=args.overwrite,
        git_commit=args.git_commit,
    )


def _export_text(spark: SparkSession, args) -> None:
    jobs.export_raw_text(
        spark,
        _source(spark, readers.read_texts, args.text, args),
        args.out,
        min_chars=args.min_chars,
        max_chars=args.max_chars,
        max_docs=args.max_docs,
        ordered=not args.unordered,
        overwrite=args.overwrite,
    )


def _quality(spark: SparkSession, args) -> None:
    report = jobs.quality_report(spark, f"{args.export}/sft.jsonl", f"{args.export}/dpo.jsonl")
    writers.write_document(report, args.out)


def _findings(spark: SparkSession, args) -> None:
    report = spark.read.json(args.quality)
    manifest = spark.read.json(args.manifest) if args.manifest else None
    writers.write_document(fingerprint.snapshot(report, manifest), f"{args.out}/snapshot.json")
    writers.write_document(jobs.findings(report), f"{args.out}/findings.json")


def _synthetic(spark: SparkSession, args) -> None:
    pairs = synthetic.synthetic_pairs(synthetic.question_numbers(spark, args.n), args.seed)
    writers.write_jsonl(pairs, f"{args.out}/synthetic.jsonl")
    writers.write_descriptor({"synthetic": ("dpo", "synthetic.jsonl")}, f"{args.out}/dataset_info.json")


def _compare_runs(spark: SparkSession, args) -> None:
    writers.write_document(jobs.eval_comparison(spark, args.run), args.out)


def _summarise_run(spark: SparkSession, args) -> None:
    metrics = evaljson.read_eval_runs(spark, {"run": args.path})
    labels = evalruns.model_labels(metrics)
    writers.write_document(evalruns.summarise_run(metrics).join(labels, "run").drop("run").orderBy("task"), args.out)


def _compare_retrieval(spark: SparkSession, args) -> None:
    corpus, queries, qrels = readers.read_retrieval(spark, args.corpus, args.queries, args.qrels, args.format)
    settings = jobs.RetrievalSettings(args.top_k, args.rerank_pool, args.max_queries, args.seed)

    def vectors(path: str, name: str) -> DataFrame:
        rows = spark.read.schema(readers.VECTORS).format(args.format).load(path)
        return rows.withColumnRenamed("id", name)

    scores = spark.read.schema(readers.RERANK_SCORES).format(args.format).load(args.rerank_scores)
    compared = jobs.retrieval_comparison(
        args.dataset, queries, qrels, vectors(args.query_vectors, "qid"), vectors(args.doc_vectors, "doc_id"), scores, settings
    )
    compared = materialize(compared, "comparison")
    parameters = jobs.comparison_parameters(
        spark, args.dataset, corpus.count(), settings, args.bi_encoder, args.cross_encoder
    )
    writers.write_document(ranking.comparison_document(compared, parameters), args.out)
    ranking.enforce_gate(ranking.improvement_gate(compared), args.allow_regression)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallyloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, action, *, source: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(action=action)
        sub.add_argument("--out", required=True)
        if source:
            sub.add_argument("--format", default="json", choices=["json", "parquet"])
            sub.add_argument("--order", default="pos", choices=["pos", "file", "scan"], help="where the row order comes from")
            sub.add_argument("--overwrite", action="store_true", help="replace the files of an earlier run")
            sub.add_argument("--unordered", action="store_true", help="write without the ordering shuffle")
        return sub

    sub = command("export", _export, source=True)
    for name in ("--recipe", "--sft", "--prefs"):
        sub.add_argument(name, required=True)
    sub.add_argument("--max-sft", type=int)
    sub.add_argument("--max-dpo", type=int)
    sub.add_argument("--allow-empty", action="store_true")
    sub.add_argument("--git-commit")

    sub = command("export-text", _export_text, source=True)
    sub.add_argument("--text", required=True)
    sub.add_argument("--max-docs", type=int)
    sub.add_argument("--min-chars", type=int, default=80)
    sub.add_argument("--max-chars", type=int)

    command("quality", _quality).add_argument("--export", required=True)

    sub = command("findings", _findings)
    sub.add_argument("--quality", required=True)
    sub.add_argument("--manifest")

    sub = command("synthetic", _synthetic)
    sub.add_argument("--n", type=int, default=256)
    sub.add_argument("--seed", type=int, default=13)

    command("compare-runs", _compare_runs).add_argument("--run", action="append", required=True, metavar="NAME=PATH")
    command("summarise-run", _summarise_run).add_argument("path")

    sub = command("compare-retrieval", _compare_retrieval)
    for name in ("--dataset", "--corpus", "--queries", "--qrels", "--query-vectors", "--doc-vectors", "--rerank-scores"):
        sub.add_argument(name, required=True)
    sub.add_argument("--format", default="parquet", choices=["json", "parquet"])
    sub.add_argument("--top-k", type=int, default=1000)
    sub.add_argument("--rerank-pool", type=int, default=100)
    sub.add_argument("--max-queries", type=int)
    sub.add_argument("--seed", type=int, default=0)
    sub.add_argument("--bi-encoder")
    sub.add_argument("--cross-encoder")
    sub.add_argument("--allow-regression", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tallyloom {args.command}").getOrCreate()
    try:
        args.action(spark, args)
    except (export.EmptyExportError, evalruns.NoTasksError, ranking.RegressionError) as refused:
        print(refused, file=sys.stderr)
        return refused.exit_code
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
