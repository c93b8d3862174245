"""Evaluation files: typing, document order, both picks, formatting, comparison."""

import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.jsonvalues import format_metric, quote_nonfinite
from tallyloom.operators import evalruns, synthetic
from tallyloom.plans import jobs
from tallyloom.sources import evaljson

DOCUMENT = """{"results": {
  "t1": {"alias": "t1", "acc_norm,none": 0.5, "acc,none": NaN},
  "t2": {"z": true, "y": "0.7", "x,none": 2, "a": 3},
  "t3": {"alias": "x"},
  "t4": 5,
  "t5": {"acc,none": "N/A", "acc": 0.25},
  "t6": {"acc": null, "big": 123456789012345678901234567890, "small": 1e-7},
  "t7": {"acc": -Infinity, "n": "a \\"NaN\\", b", "list": [NaN, 1], "last": -3}
}, "config": {"model_args_string": "", "model_args": "m=1"}}"""


@pytest.fixture(scope="module")
def metrics(spark):
    return evaljson.eval_metrics(spark.createDataFrame([("r", DOCUMENT)], "run STRING, document STRING")).cache()


def picks(metrics, strict):
    return {r.task: (r.metric, r.value, r.text) for r in evalruns.pick_metric(metrics, strict).collect()}


def test_strict_pick(metrics):
    got = {t: p[:2] for t, p in picks(metrics, True).items()}
    assert got == {
        "t1": ("acc_norm,none", 0.5),
        "t2": ("x,none", 2.0),
        "t5": ("acc", 0.25),
        "t6": ("big", 123456789012345678901234567890.0),
        "t7": ("last", -3.0),
    }


def test_lenient_pick(metrics):
    got = {t: (m, text) for t, (m, _, text) in picks(metrics, False).items()}
    assert got["t1"] == ("acc,none", "nan") and got["t2"] == ("x,none", "2") and got["t5"] == ("acc,none", "N/A")
    assert got["t6"] == ("acc", "None") and got["t7"] == ("acc", "-inf")
    assert set(got) == {"t1", "t2", "t5", "t6", "t7"}


def test_model_args(metrics):
    assert evalruns.model_labels(metrics).first().model_args == "m=1"


@pytest.mark.parametrize(
    "config,expected",
    [('{"model_args_string":"s","model_args":"m"}', "s"), ('"text"', None), ("[]", None), ("{}", None), ("null", None)],
)
def test_model_args_fallbacks(spark, config, expected):
    document = f'{{"config": {config}, "results": {{"t": {{"acc": 1}}}}}}'
    df = evaljson.eval_metrics(spark.createDataFrame([("r", document)], "run STRING, document STRING"))
    assert df.first().model_args == expected


@pytest.mark.parametrize("document", ['{"results": {"t": {"acc": 1}', "nothing", '{"results": 5}'])
def test_a_broken_document_is_an_error(spark, document):
    with pytest.raises(Exception, match="(?i)malformed"):
        evaljson.eval_metrics(spark.createDataFrame([("r", document)], "run STRING, document STRING")).collect()


@pytest.mark.parametrize("document", ["{}", '{"results": null}', '{"results": {}, "config": [1]}', '{"results": {"t": [1], "u": null}}'])
def test_documents_without_metrics(spark, document):
    df = spark.createDataFrame([("r", document)], "run STRING, document STRING")
    assert evaljson.eval_metrics(df).collect() == []


def test_quoting_leaves_text_alone(spark):
    raw = r'{"a": NaN, "b": "NaN, \"NaN\": NaN", "c": [Infinity, -Infinity, "\\"], "NaN": 1}'
    got = spark.createDataFrame([(raw,)], "s STRING").select(quote_nonfinite(F.col("s"))).first()[0]
    assert json.loads(got) == {"a": "nan", "b": 'NaN, "NaN": NaN', "c": ["inf", "-inf", "\\"], "NaN": 1}


@pytest.mark.parametrize(
    "number,text,expected",
    [(1.0, "1.0", "1"), (0.25, "0.25", "0.2500"), (-2.0, "", "-2"), (None, "N/A", "N/A"), (1234.5, "", "1234.5000"), (0.0, "", "0")],
)
def test_format(spark, number, text, expected):
    df = spark.createDataFrame([(number, text)], "n DOUBLE, t STRING")
    assert df.select(format_metric(F.col("n"), F.col("t"))).first()[0] == expected


def test_format_rounds_the_binary_value(spark):
    numbers = [0.33335, 0.00015, 0.12345, 0.55625, 0.5 / 1024, 2.00005, -0.00006, 1e-9]  # a bare 5e-5 is a tie to Java
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i INT, n DOUBLE").orderBy("i")
    got = [r[0] for r in df.select(format_metric(F.col("n"), F.lit(""))).collect()]
    assert got == [f"{n:.4f}" for n in numbers]


def test_run_arguments():
    assert evaljson.parse_run_arguments([" a = /x=y.json ", "b=z"]) == {"a": "/x=y.json", "b": "z"}
    for bad in (["plain"], ["=x"], ["a="], ["a=1", "a=2"]):
        with pytest.raises(ValueError):
            evaljson.parse_run_arguments(bad)


def write(tmp_path, name, results):
    path = tmp_path / name
    path.write_text(json.dumps({"results": results}, indent=2), encoding="utf-8")
    return str(path)


def test_comparison_of_files(spark, tmp_path):
    runs = [
        "base=" + write(tmp_path, "a file.json", {"t1": {"acc,none": 0.5}, "t2": {"acc": 1}, "t5": {"acc": 0.1}}),
        "mid=" + write(tmp_path, "b.json", {"t2": {"f1": 0.5}}),
        "new=" + write(tmp_path, "c.json", {"t1": {"acc,none": 0.75}, "t3": {"f1": 2}, "t5": {"f1": 0.4}}),
    ]
    rows = {r.task: r for r in jobs.eval_comparison(spark, runs).collect()}
    assert list(rows) == ["t1", "t2", "t3", "t5"]
    assert rows["t1"].delta_last_minus_first == 0.25 and rows["t1"].same_metric
    assert rows["t2"].delta_last_minus_first is None and rows["t2"].mid_value == 0.5
    assert rows["t3"].base_value is None and rows["t3"].new_metric == "f1"
    assert rows["t5"].delta_last_minus_first == pytest.approx(0.3) and rows["t5"].same_metric is False
    only = jobs.eval_comparison(spark, runs[:1]).first()
    assert only.delta_last_minus_first == 0.0


def test_missing_file_and_no_tasks(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        jobs.eval_comparison(spark, [f"a={tmp_path}/none.json"])
    with pytest.raises(evalruns.NoTasksError):
        jobs.eval_comparison(spark, ["a=" + write(tmp_path, "e.json", {"t": {"alias": "x"}})])
    with pytest.raises(evalruns.NoTasksError):
        jobs.eval_comparison(spark, ["a=" + write(tmp_path, "f.json", None)])


def test_summary_of_a_file(spark, tmp_path):
    path = write(tmp_path, "s.json", {"b": {"acc": 1.0}, "a": {"acc,none": "N/A", "x": 3}, "c": {"f": 0.12345}})
    got = [(r.task, r.metric, r.display) for r in jobs.eval_summary(spark, path).collect()]
    assert got == [("a", "acc,none", "N/A"), ("b", "acc", "1"), ("c", "f", "0.1235")]


def test_synthetic_pairs(spark):
    pairs = synthetic.synthetic_pairs(synthetic.question_numbers(spark))
    rows = sorted(pairs.collect())
    assert len(rows) == 256 and rows == sorted(synthetic.synthetic_pairs(synthetic.question_numbers(spark).repartition(7)).collect())
    topics = [next(t for t in synthetic.TOPICS if f" {t} " in r.instruction) for r in rows]
    assert set(topics) == set(synthetic.TOPICS) and min(topics.count(t) for t in synthetic.TOPICS) > 40
    assert rows[5].instruction.endswith("(question #5).") and rows[0].input == ""
    assert rows != sorted(synthetic.synthetic_pairs(synthetic.question_numbers(spark), seed=14).collect())


def test_a_string_that_looks_like_an_object_is_no_task(spark):
    text = '{"results": {"note": "{\\"acc\\": 0.9}", "t": {"z": 1, "acc": 0.5}}, "config": {}}'
    rows = evaljson.eval_metrics(spark.createDataFrame([("r", text)], "run string, document string")).collect()
    assert [(r.task, r.metric) for r in sorted(rows, key=lambda r: r.pos)] == [("t", "z"), ("t", "acc")]


def test_many_runs_are_one_scan(spark, tmp_path):
    runs = {}
    for i in range(300):
        file = tmp_path / f"run {i} 50%=a+b.json"
        file.write_text(json.dumps({"results": {"t": {"acc": i / 8}}, "config": {}}))
        runs[f"r{i}"] = str(file)
    runs["again"] = runs["r7"]
    metrics = evaljson.read_eval_runs(spark, runs)
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("binaryFile") == 1 and "Union" not in plan
    got = {r.run: r.number for r in metrics.collect()}
    assert got == {f"r{i}": i / 8 for i in range(300)} | {"again": 7 / 8}


def test_a_run_that_is_no_file_is_an_error(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "a.json").write_text('{"results":{}}')
    with pytest.raises(Exception, match="not a file: .*folder"):
        evaljson.read_eval_runs(spark, {"x": str(tmp_path / "folder")}).collect()
