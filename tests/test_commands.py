"""The command line over files, end to end."""

import json

import pytest

from tallyloom.__main__ import main


def lines(path):
    parts = [path] if path.is_file() else sorted(path.glob("part-*"))
    return [json.loads(x) for p in parts for x in p.read_text(encoding="utf-8").splitlines()]


def jsonl(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_export_quality_findings(spark, tmp_path):
    recipe = {"schema_version": 1, "recipe_id": "r", "sources": {"sft": {}, "dpo": {}}, "filters": {"min_chars": 3}}
    (tmp_path / "recipe.json").write_text(json.dumps(recipe))
    sft = jsonl(tmp_path / "sft.json", [{"instruction": f"i{i}", "output": f"é {i}"} for i in range(9)])
    side = lambda text: [{"role": "user", "content": "q"}, {"role": "assistant", "content": text}]
    prefs = jsonl(
        tmp_path / "prefs.json",
        [{"prompt": f"p{i}", "chosen": side("same" if i == 4 else f"c{i}"), "rejected": side("same")} for i in range(7)],
    )
    out = tmp_path / "out"
    args = ["export", "--recipe", str(tmp_path / "recipe.json"), "--sft", sft, "--prefs", prefs, "--order", "scan"]
    assert main([*args, "--out", str(out), "--max-sft", "4"]) == 0
    assert [r["output"] for r in lines(out / "sft.jsonl")] == ["é 0", "é 1", "é 2", "é 3"]
    assert [r["instruction"] for r in lines(out / "dpo.jsonl")] == ["p0", "p1", "p2", "p3", "p5", "p6"]
    assert main([*args, "--out", str(tmp_path / "none"), "--max-sft", "0"]) == 2
    assert main(["quality", "--export", str(out), "--out", str(tmp_path / "qa")]) == 0
    report = lines(tmp_path / "qa")[0]
    assert report["sft"]["rows"] == 4 and report["dpo"]["fraction_chosen_longer_than_rejected"] == 0.0
    found = ["findings", "--quality", str(tmp_path / "qa"), "--manifest", str(out / "manifest.json")]
    assert main([*found, "--out", str(tmp_path / "found")]) == 0
    assert lines(tmp_path / "found" / "snapshot.json")[0]["export"]["recipe_id"] == "r"
    assert {r["dataset"] for r in lines(tmp_path / "found" / "findings.json")} == {"sft", "dpo"}


def test_export_text_in_file_order(spark, tmp_path):
    spark.createDataFrame([("x" * n,) for n in (90, 10, 100)], "text STRING").coalesce(1).write.parquet(str(tmp_path / "in"))
    args = ["export-text", "--text", str(tmp_path / "in"), "--order", "file", "--format", "parquet"]
    assert main([*args, "--out", str(tmp_path / "out"), "--max-chars", "95"]) == 0
    assert [len(r["text"]) for r in lines(tmp_path / "out" / "cpt.jsonl")] == [90, 95]


def test_synthetic(spark, tmp_path):
    assert main(["synthetic", "--n", "20", "--out", str(tmp_path / "s")]) == 0
    assert len(lines(tmp_path / "s" / "synthetic.jsonl")) == 20
    assert lines(tmp_path / "s" / "dataset_info.json") == [
        {
            "synthetic": {
                "file_name": "synthetic.jsonl",
                "formatting": "alpaca",
                "ranking": True,
                "columns": {"prompt": "instruction", "query": "input", "chosen": "chosen", "rejected": "rejected"},
            }
        }
    ]


def test_runs(spark, tmp_path):
    a = tmp_path / "a.json"
    a.write_text(json.dumps({"results": {"t": {"acc": 1}}, "config": {"model_args": "m"}}))
    assert main(["compare-runs", "--run", f"a={a}", "--out", str(tmp_path / "c")]) == 0
    assert lines(tmp_path / "c")[0]["delta_last_minus_first"] == 0.0
    assert main(["summarise-run", str(a), "--out", str(tmp_path / "d")]) == 0
    assert lines(tmp_path / "d") == [{"task": "t", "metric": "acc", "value": 1.0, "display": "1", "model_args": "m"}]
    a.write_text("{}")
    assert main(["compare-runs", "--run", f"a={a}", "--out", str(tmp_path / "e")]) == 2


@pytest.mark.parametrize("second,code", [(5.0, 0), (-5.0, 2)])
def test_retrieval(spark, tmp_path, second, code):
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    docs = [(f"d{i}", [1.0, i / 10]) for i in range(20)]
    args = [
        "compare-retrieval", "--dataset", "toy", "--top-k", "20", "--rerank-pool", "10",
        "--corpus", table("corpus", [(d, "", "t") for d, _ in docs], "doc_id STRING, title STRING, text STRING"),
        "--queries", table("queries", [("q", "text")], "qid STRING, text STRING"),
        "--qrels", table("qrels", [("q", "d5", 1)], "qid STRING, doc_id STRING, rel INT"),
        "--query-vectors", table("qv", [("q", [1.0, 0.0])], "id STRING, embedding ARRAY<FLOAT>"),
        "--doc-vectors", table("dv", docs, "id STRING, embedding ARRAY<FLOAT>"),
        "--rerank-scores",
        table("rs", [("q", d, second if d == "d5" else 0.0) for d, _ in docs[:10]], "qid STRING, doc_id STRING, score DOUBLE"),
        "--out", str(tmp_path / "out"),
    ]
    assert main(args) == code
    record = lines(tmp_path / "out")[0]
    assert record["n_corpus"] == 20 and record["dense"]["ndcg@10"] == 0.35621
    assert record["rerank"]["ndcg@10"] == (1.0 if code == 0 else 0.28906)
