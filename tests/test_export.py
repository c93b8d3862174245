"""Exports: message extraction, filters in order, caps, accounting, sinks."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.messages import last_assistant, stringify_content
from tallyloom.operators import export, selection
from tallyloom.plans import jobs
from tallyloom.plans.recipe import Recipe
from tallyloom.sources import readers, writers
from tallyloom.streaming.incremental import start_jsonl_export

MESSAGES = "ARRAY<STRUCT<role: STRING, content: STRING>>"


def sft(spark, rows):
    return spark.createDataFrame(rows, "pos BIGINT, instruction STRING, input STRING, output STRING")


def prefs(spark, rows):
    return spark.createDataFrame(rows, f"pos BIGINT, prompt STRING, chosen {MESSAGES}, rejected {MESSAGES}")


def said(*texts):
    return [("user", "q"), *[("assistant", t) for t in texts]]


# --- messages ---------------------------------------------------------------------------------------------------

CONTENT = [
    ('[{"type":"text","text":"x"},{"text":null},"y"]', "xy"),
    ('"[1]"', "[1]"),
    ('"plain"', "plain"),
    ("null", ""),
    ("[]", ""),
    ("7", "7"),
    ("true", "True"),
    ('[{"kind":"image"},3,null]', '{"kind":"image"}3None'),
    ('[{"text":5},{"text":0},{"text":""}]', "5"),
]


@pytest.mark.parametrize("raw,expected", CONTENT)
def test_stringify_variant(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "j STRING").select(F.parse_json("j").alias("v"))
    assert df.select(stringify_content(F.col("v"), T.VariantType())).first()[0] == expected


def test_stringify_typed_chunks(spark):
    df = spark.createDataFrame([([("a",), (None,), ("b",)],), (None,)], "c ARRAY<STRUCT<text: STRING>>")
    kind = df.schema["c"].dataType
    assert [r[0] for r in df.select(stringify_content(F.col("c"), kind)).collect()] == ["ab", ""]


@pytest.mark.parametrize(
    "messages,expected",
    [
        ([("user", "q"), ("assistant", "a"), ("user", "r")], "a"),
        ([("assistant", "a"), ("assistant", "b")], "b"),
        ([("assistant", "a"), ("assistant", "")], ""),
        ([("assistant", "a"), ("assistant", None)], ""),
        ([("user", "q")], ""),
        ([], ""),
        (None, ""),
    ],
)
def test_last_assistant(spark, messages, expected):
    df = spark.createDataFrame([(messages,)], f"m {MESSAGES}")
    assert df.select(last_assistant(F.col("m"), df.schema["m"].dataType)).first()[0] == expected
    as_json = None if messages is None else json.dumps([{"role": r, "content": c} for r, c in messages])
    v = spark.createDataFrame([(as_json,)], "j STRING").select(F.parse_json("j").alias("m"))
    assert v.select(last_assistant(F.col("m"), T.VariantType())).first()[0] == expected


@pytest.mark.parametrize("raw", ['"text"', "5", "{}", '[7,"x",null]'])
def test_no_message_list_counts_as_missing(spark, raw):
    v = spark.createDataFrame([(raw,)], "j STRING").select(F.parse_json("j").alias("m"))
    assert v.select(last_assistant(F.col("m"), T.VariantType())).first()[0] == ""


# --- filters ----------------------------------------------------------------------------------------------------


def test_sft_filters(spark):
    raw = sft(
        spark,
        [
            (1, "i", None, "  \n"),
            (2, "i", None, None),
            (3, None, None, " kept  \n"),
            (4, "ab", "", "cd"),
            (5, "ab", "", "cde"),
            (6, "a", "", "b"),
        ],
    )
    kept = {r.pos: r for r in export.sft_examples(raw, 4, 6).collect()}
    assert set(kept) == {3, 4, 6}
    assert kept[3].output == " kept  \n" and kept[3].instruction == "" and kept[3].input == ""


def test_dpo_filters_and_reasons(spark):
    raw = prefs(
        spark,
        [
            (1, " 　", said("a"), said("b")),
            (2, None, said("a"), said("b")),
            (3, " p ", said("c"), said("r")),
            (4, "p", said(" "), said("x")),
            (5, "p", said(""), said("x")),
            (6, "p", said("same"), said("same")),
            (7, "p", None, said("x")),
            (8, "p", said("x" * 100), said("y")),
            (9, "p", [], []),
        ],
    )
    kept = {r.pos: r for r in export.dpo_pairs(raw, 5, 50).collect()}
    assert set(kept) == {3, 4}
    assert (kept[3].instruction, kept[3].input, kept[3].chosen, kept[3].rejected) == ("p", "", "c", "r")
    reasons = {r.reason: r.rows for r in export.drop_reasons(export.project_dpo(raw), export.dpo_rules(5, 50)).collect()}
    # the length test comes before the empty and equal tests: row 9 is one character long
    assert reasons == {"empty_prompt": 2, "length": 2, "empty_side": 2, "identical_sides": 1, "kept": 2}


def test_cpt_strip_then_test_then_cut(spark):
    raw = spark.createDataFrame(
        [(1, "a" * 79 + " " * 50), (2, "  " + "b" * 80), (3, "😀" + "c" * 9000), (4, None)], "pos BIGINT, text STRING"
    )
    kept = {r.pos: r.text for r in export.cpt_corpus(raw, max_chars=8000).collect()}
    assert len(export.cpt_corpus(raw).filter("pos = 3").first().text) == 9001
    assert kept == {2: "b" * 80, 3: "😀" + "c" * 7999}


def test_accounting_adds_up(spark, small):
    from tallyloom.plans import bindings

    rows, rules = export.project_cpt(bindings.cpt_raw(spark, small)), export.cpt_rules()
    line = export.row_accounting("cpt", rows, rules).first()
    reasons = {r.reason: r.rows for r in export.drop_reasons(rows, rules).collect()}
    assert line.raw_rows == sum(reasons.values()) and line.exported_rows == reasons["kept"]
    assert export.row_accounting("cpt", rows, rules, cap=5).first().exported_rows == 5


# --- first n ----------------------------------------------------------------------------------------------------


def test_cap_takes_the_first_passing_rows(spark):
    raw = sft(spark, [(5, "i", "", "five"), (1, "i", "", "one"), (2, "i", "", " "), (3, "i", "", "three")])
    assert [r.pos for r in export.sft_examples(raw, cap=2).orderBy("pos").collect()] == [1, 3]
    assert export.sft_examples(raw, cap=0).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 999, 5000, 9999, 10_000, 20_000])
def test_caps_agree_with_a_plain_limit(spark, n):
    df = spark.range(10_000).select((F.col("id") * F.col("id") * 37 - 10**9).alias("pos")).repartition(7)
    got = sorted(r.pos for r in selection.first_n(df, n).collect())
    assert got == sorted(i * i * 37 - 10**9 for i in range(10_000))[:n]


def test_caps_with_ties(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("pos"), "id").repartition(5)
    got = sorted((r.pos, r.id) for r in selection.first_n(df, 250, "pos", ["id"]).collect())
    assert got == sorted((i % 10, i) for i in range(1000))[:250]


def test_first_n_without_a_tie_key_is_stable(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("pos"), "id")
    one = {r.id for r in selection.first_n(df.repartition(3), 1500).collect()}
    assert len(one) == 1500 and one == {r.id for r in selection.first_n(df.repartition(6), 1500).collect()}
    same = spark.range(2000).select(F.lit(1).cast("bigint").alias("pos"), F.lit("x").alias("t"))
    assert selection.first_n(same, 1234).count() == 1234


@pytest.mark.parametrize("n", [2, 3])
def test_first_n_of_extreme_positions(spark, n):
    df = spark.createDataFrame([(5 * 10**18,), (-5 * 10**18,), (0,), (9 * 10**18,)], "pos long")
    assert sorted(r.pos for r in selection.first_n(df, n).collect()) == [-5 * 10**18, 0, 5 * 10**18][:n]


@pytest.mark.parametrize("n", [1, 2000])
def test_a_row_without_a_position_is_an_error(spark, n):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "pos long, t string")
    with pytest.raises(Exception, match="a row has no pos"):
        selection.first_n(df, n).collect()


# --- sources and sinks ------------------------------------------------------------------------------------------


def test_preferences_from_json_of_mixed_shape(spark, tmp_path):
    lines = [
        {"pos": 1, "prompt": "p", "chosen": [{"role": "assistant", "content": "a"}], "rejected": "oops"},
        {
            "pos": 2,
            "prompt": "p",
            "chosen": [{"role": "assistant", "content": [{"type": "text", "text": "é😀"}]}],
            "rejected": [{"role": "assistant", "content": "b"}],
        },
    ]
    (tmp_path / "in.json").write_text("\n\n".join(json.dumps(x) for x in lines) + "\n \n", encoding="utf-8")
    pairs = export.dpo_pairs(readers.read_preferences(spark, str(tmp_path / "in.json"))).collect()
    assert [(r.pos, r.chosen, r.rejected) for r in pairs] == [(2, "é😀", "b")]


def test_jsonl_keeps_order_text_and_empty_fields(spark, tmp_path):
    rows = [(i, f"ü😀 {i}\n", "", f"o{i}") for i in range(50)]
    df = sft(spark, rows).repartition(9)
    writers.write_jsonl(df, str(tmp_path / "out"), max_rows_per_file=10)
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*")):
        lines += part.read_text(encoding="utf-8").splitlines()
    assert [json.loads(x) for x in lines] == [{"instruction": a, "input": b, "output": c} for _, a, b, c in rows]
    assert "ü😀" in lines[0]
    back = readers.read_export(spark, str(tmp_path / "out"), readers.SFT_EXPORT)
    assert back.count() == 50


def test_blank_lines_are_skipped_and_bad_lines_raise(spark, tmp_path):
    (tmp_path / "ok.jsonl").write_text('{"text":"a"}\n\n   \n{"text":"b"}\n')
    assert readers.read_export(spark, str(tmp_path / "ok.jsonl"), readers.CPT_EXPORT).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"text":"a"}\n{"text":\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_export(spark, str(tmp_path / "bad.jsonl"), readers.CPT_EXPORT).collect()


def test_file_order(spark, tmp_path, monkeypatch):
    for name, start in (("b", 100), ("a", 0)):
        spark.range(start, start + 40).coalesce(1).write.parquet(str(tmp_path / name))
    monkeypatch.setattr(readers, "_FILES_PER_SCAN", 1)
    df = readers.read_in_file_order(spark, [str(tmp_path / "b"), str(tmp_path / "a")])
    assert [r.id for r in df.orderBy("pos").collect()] == [*range(40), *range(100, 140)]
    assert df.select("pos").distinct().count() == 80


def test_newest_file_per_stem(spark, tmp_path):
    import os

    for name, when in (("run_a_1.json", 100), ("run_a_2.json", 300), ("run_a_3.json", 200), ("run_b_1.json", 5), ("x.txt", 9)):
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (when, when))
    found = {r.stem: r.path.rsplit("/", 1)[1] for r in writers.newest_files(spark, str(tmp_path), r"/(run_\w)_[^/]*\.json$").collect()}
    assert found == {"run_a": "run_a_2.json", "run_b": "run_b_1.json"}


def test_export_job(spark, tmp_path):
    recipe = Recipe.from_mapping(
        {
            "schema_version": 1,
            "recipe_id": "r1",
            "sources": {"sft": {"location": "here", "revision": ""}, "dpo": None},
            "filters": {"min_chars": 2, "max_chars": 100},
            "limits": {"max_sft_rows": 1},
        }
    )
    s = sft(spark, [(1, "i", "", "o"), (2, "i", "", "p"), (3, "i", "", " ")])
    p = prefs(spark, [(1, "p", said("c"), said("r")), (2, "p", said("c"), said("c"))])
    done = jobs.export_training_sets(spark, s, p, recipe, str(tmp_path / "out"), git_commit="abc")
    assert done.rows == {"sft": 1, "dpo": 1}
    manifest = json.loads((tmp_path / "out" / "manifest.json").read_text())
    assert manifest["recipe_id"] == "r1" and manifest["filters"] == {"min_chars": 2, "max_chars": 100}
    assert manifest["environment"]["git_commit"] == "abc"
    assert {x["role"]: (x["raw_rows"], x["exported_rows"]) for x in manifest["sources"]} == {"sft": (3, 1), "dpo": (2, 1)}
    assert {x["name"]: x["rows"] for x in manifest["exports"]} == {"sft": 1, "dpo": 1}
    report = jobs.quality_report(spark, done.paths["sft"], done.paths["dpo"])
    lines = {(r.dataset, r.metric, r.stat): r.value for r in jobs.findings(report).collect()}
    assert lines["sft", "rows", "value"] == 1 and lines["dpo", "chosen_char_len", "p50"] == 1
    with pytest.raises(export.EmptyExportError):
        jobs.export_training_sets(spark, s, p.limit(0), recipe, str(tmp_path / "empty"))
    assert not (tmp_path / "empty").exists()
    assert jobs.export_training_sets(spark, s, p, recipe, str(tmp_path / "empty")).rows == {"sft": 1, "dpo": 1}
    with pytest.raises(AnalysisException):
        jobs.export_training_sets(spark, s, p, recipe, str(tmp_path / "out"))
    more = s.union(sft(spark, [(4, "i", "", "q")]))
    again = jobs.export_training_sets(spark, more, p, recipe, str(tmp_path / "out"), max_sft=5, overwrite=True)
    assert again.rows == {"sft": 3, "dpo": 1}
    assert spark.read.json(again.paths["sft"]).count() == 3
    allowed = jobs.export_training_sets(spark, s.limit(0), p, recipe, str(tmp_path / "allowed"), allow_empty=True)
    assert allowed.rows["sft"] == 0


def test_raw_text_job(spark, tmp_path):
    raw = spark.createDataFrame([(i, "x" * (70 + i)) for i in range(30)], "pos BIGINT, text STRING")
    done = jobs.export_raw_text(spark, raw, str(tmp_path / "out"), max_docs=5)
    assert done.rows == {"cpt": 5}
    with pytest.raises(export.EmptyExportError):
        jobs.export_raw_text(spark, raw, str(tmp_path / "none"), min_chars=1000)
    assert not (tmp_path / "none").exists()


@pytest.mark.parametrize(
    "change",
    [
        {"schema_version": 2},
        {"recipe_id": ""},
        {"sources": {"sft": {}}},
        {"filters": {"min_chars": 5, "max_chars": 4}},
    ],
)
def test_bad_recipes(change):
    good = {"schema_version": 1, "recipe_id": "r", "sources": {"sft": {}, "dpo": {}}}
    Recipe.from_mapping(good)
    with pytest.raises(ValueError):
        Recipe.from_mapping({**good, **change})


def test_descriptor(spark):
    rows = writers.export_descriptor(spark, {"pairs": ("dpo", "dpo.jsonl"), "text": ("cpt", "c.jsonl")}).collect()
    by_name = {r.name: r for r in rows}
    assert by_name["pairs"].ranking and by_name["pairs"].columns["prompt"] == "instruction"
    assert by_name["text"].columns == {"prompt": "text"}


def test_exports_run_on_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    batch = sft(spark, [(1, "i", None, "o"), (2, "i", None, " ")])
    batch.write.json(str(source), mode="append")
    stream = spark.readStream.schema(readers.SFT_SOURCE).json(str(source))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    start_jsonl_export(export.sft_examples(stream), out, state).awaitTermination(60)
    sft(spark, [(3, "i", None, "late")]).write.json(str(source), mode="append")
    start_jsonl_export(export.sft_examples(stream), out, state).awaitTermination(60)
    assert sorted(r.output for r in readers.read_export(spark, out, readers.SFT_EXPORT).collect()) == ["late", "o"]
