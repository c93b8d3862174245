"""The pipeline stage by stage against brute force on the small table, and its contract."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import pii
from test_text_operators import plain_score, plain_spans, plain_tokens


@pytest.fixture(scope="module")
def stages(spark, small):
    from tallyloom.session import materialize

    docs = corpus_pipeline.table(spark, small, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], small), name))
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "pii", "source_mix"]
    assert all(s.columns == corpus_pipeline.COLUMNS for s in stages[:-1])


def test_language_stage_keeps_everything_with_letters(stages):
    assert set(rows(stages[1])) == {i for i, r in rows(stages[0]).items() if any(map(str.isalpha, r.text or ""))}


def test_one_document_of_each_class_stays(stages, helpers):
    before = rows(stages[1])
    sets = {i: helpers["shingles"](r.text) for i, r in before.items()}
    want = helpers["classes"](list(sets), lambda a, b: helpers["similar"](sets[a], sets[b]))
    assert set(rows(stages[2])) == set(want.values())


def test_benchmark_copies_go(spark, small, stages):
    items = [plain_tokens(r.text) for r in corpus_pipeline.table(spark, small, "benchmark").collect()]
    kept = rows(stages[3])
    for i, r in rows(stages[2]).items():
        passage = plain_tokens(r.text)
        worst = max((plain_score(x, passage) for x in items if len(set(x) & set(passage)) >= 0.4 * len(set(x))), default=0)
        assert (i in kept) == (worst < 0.5)


def test_personal_data_goes_and_documents_stay(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for i, r in before.items():
        spans = plain_spans(r.text)
        assert (after[i].text != r.text) == bool(spans)
        assert after[i].n_chars == len(after[i].text)
    assert stages[4].select(F.size(pii.pii_spans(F.col("text"))).alias("n")).filter("n > 0").count() == 0


def test_mix_takes_whole_documents(stages, helpers):
    before, after = rows(stages[4]), rows(stages[5])
    assert set(before) == set(after)
    assert all(r.size == len(helpers["words"](before[i].text)) and r.taken in (0, r.size, 2 * r.size, 3 * r.size) for i, r in after.items())


def test_edge_rows(spark, small, docs):
    text = "the " + " ".join(f"word{i}" for i in range(30))
    given = docs([(1, text, "en", "a", 1), (1, text, "en", "a", 1), (None, text, "en", "a", 1), (2, None, None, None, None), (3, "", "en", None, 0), (4, text + " x", "en", None, 2)],
                 "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:2]:
        given = stage(spark, given, small)
    assert sorted(map(str, (r.doc_id for r in given.collect()))) == ["1", "None"]


def test_run_on_an_empty_table(spark, small, tmp_path):
    import os

    for name in ("documents", "benchmark"):
        source = corpus_pipeline.table(spark, small, name)
        (source.limit(0) if name == "documents" else source).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
