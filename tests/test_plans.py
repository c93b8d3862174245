"""Plan shape: what must not appear in any query, and what must appear in some."""

import re

import pytest

from tallyloom.operators import export
from tallyloom.plans import bindings
from tallyloom.plans.catalog import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def without_broadcasts(spark):
    """Plan as for large tables: nothing is small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_forced_broadcasts(spark, small, without_broadcasts, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|BroadcastExchange|BatchEvalPython", text)


@pytest.mark.parametrize("name", ["cpt_corpus", "normalised_keys", "trigram_scores", "stripped_text", "synthetic_pairs"])
def test_row_local_work_has_no_keyed_shuffle(spark, small, name):
    assert "hashpartitioning" not in plan(QUERIES[name](spark, small))


def test_scans_read_only_what_they_need(spark, small):
    assert "ReadSchema: struct<text:string>" in plan(QUERIES["length_percentiles"](spark, small))
    turns = plan(QUERIES["sft_examples"](spark, small))
    assert "EqualTo(role,assistant)" in turns and "EqualTo(role,user)" in turns


@pytest.mark.parametrize("cap", [5, 50])
def test_a_cap_is_a_pushed_filter(spark, small, cap):
    documents = bindings.table(spark, small, "documents").selectExpr("doc_id AS pos", "text")
    text = plan(export.cpt_corpus(documents, cap=cap))
    assert "LessThanOrEqual(doc_id," in text and "hashpartitioning" not in text


def test_one_exchange_of_cells_per_report(spark, small):
    text = plan(QUERIES["length_percentiles"](spark, small))
    assert text.count("hashpartitioning") == 1
