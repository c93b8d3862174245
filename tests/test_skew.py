"""The registered queries on tables where one key, label or text holds a third of all rows or more."""

import duckdb
import pytest

import __spark_entry__ as contract
import oracle_check
from tallyloom.plans.catalog import QUERIES

HOT = {
    # one long conversation
    "conversations": """
        SELECT * FROM src UNION ALL
        SELECT 7000, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END, 'turn ' || i || repeat(' word', i % 90)
        FROM range(200) t(i)""",
    # one text copied under new ids, in variants that normalise to the same key
    "documents": """
        SELECT * FROM src UNION ALL
        SELECT 90000 + i, repeat(' ', i % 3) || 'Same  TEXT again and again and again' || repeat(chr(10), i % 2) || repeat('x', 80),
          'en', 'src0', 0 FROM range(200) t(i)""",
    # one label, and one vector copied
    "embeddings": """
        SELECT vec_id, embedding, CASE WHEN vec_id % 2 = 0 THEN 3 ELSE label END AS label FROM src UNION ALL
        SELECT 50000 + i, (SELECT embedding FROM src WHERE vec_id = 4), 3 FROM range(300) t(i)""",
    "events": "SELECT event_id, ts, user_id, CASE WHEN event_id % 2 = 0 THEN 'click' ELSE event_type END, value, props FROM src",
}

NAMES = [
    "sft_examples", "dpo_pairs", "dpo_first_rows", "cpt_corpus", "drop_reasons", "duplicate_rate", "sft_quality",
    "dpo_quality", "content_digests", "trigram_scores", "cosine_topk", "reranked", "ranking_metrics", "eval_comparison",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, small):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in oracle_check.TABLES:
        source = f"read_parquet('{small}/{name}.parquet')"
        select = HOT.get(name, "SELECT * FROM src")
        columns = [c[0] for c in con.execute(f"SELECT * FROM {source} LIMIT 0").description]
        con.execute(
            f"COPY (WITH src AS (SELECT * FROM {source}), hot({', '.join(columns)}) AS ({select}) SELECT * FROM hot) "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql_under_skew(spark, skewed, name):
    con = oracle_check.connect(skewed)
    assert oracle_check.differences(QUERIES[name](spark, skewed), con, contract.oracle_sql()[name]) == []
