"""Deduplication against earlier batches: the rows of one run over all, reruns, and what the plan shuffles."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import batches, curate

SCHEMA = "pos long, k string"
ROWS = [(i, f"k{i % 37}") for i in range(150)] + [(200 + i, "hot") for i in range(300)] + [(600, None), (601, None), (602, ""), (603, "new")]


@pytest.fixture
def table(spark, tmp_path):
    name = f"kept_{uuid.uuid4().hex}"
    batches.create_key_table(spark, name, str(tmp_path / "keys"), 4)
    yield name
    spark.sql(f"DROP TABLE {name}")


def add(spark, table, name, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(r.pos for r in batches.add_batch(frame, F.col("k"), table, name).collect())


def test_batches_keep_what_one_run_keeps(spark, table):
    whole = sorted(r.pos for r in curate.deduplicate(spark.createDataFrame(ROWS, SCHEMA), F.col("k")).collect())
    got = [add(spark, table, str(i), ROWS[a:b]) for i, (a, b) in enumerate([(0, 20), (20, 20), (20, 300), (300, 451), (451, 500)])]
    assert sorted(p for rows in got for p in rows) == whole and got[1] == []
    assert got[4] == [602, 603]  # a NULL key came before, the empty one is another


def test_a_batch_may_be_run_again(spark, table):
    first = add(spark, table, "a", ROWS[:40])
    second = add(spark, table, "b", ROWS[30:300])
    assert add(spark, table, "b", ROWS[30:300]) == second and add(spark, table, "a", ROWS[:40]) == first
    assert add(spark, table, "c", ROWS[:300]) == []


def test_a_batch_without_positions_is_an_error(spark, table):
    with pytest.raises(Exception, match="a row has no pos"):
        add(spark, table, "a", [(None, "x")])


def test_the_kept_side_is_not_shuffled(spark, table):
    add(spark, table, "a", ROWS[:40])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame = spark.createDataFrame(ROWS[30:200], SCHEMA)
        plan = batches.new_rows(frame, F.col("k"), table, "b")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    lines = plan.splitlines()
    anti = next(i for i, line in enumerate(lines) if "LeftAnti" in line)
    scan = next(i for i, line in enumerate(lines) if "kept_key" in line and "FileScan" in line)
    depth = lambda line: len(re.match(r"[ :+\-]*", line).group())
    right = max(i for i in range(anti + 1, scan) if depth(lines[i]) == depth(lines[anti]) + 3)
    assert not any("Exchange" in line for line in lines[right : scan + 1]), plan
    assert "Bucketed: true" in lines[scan] and "Exchange" in "\n".join(lines[anti:right])
