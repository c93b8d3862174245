"""First N against sorting everything."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import selection


def test_ranges_rise_with_values_and_know_their_bounds(spark):
    rng = random.Random(1)
    values = sorted({0, 1, -1, 2047, 2048, 2049, -2048, -2049, 2**63 - 1, -(2**63)} | {rng.getrandbits(rng.randrange(1, 64)) * rng.choice([1, -1]) for _ in range(500)})
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", selection._range_of(F.col("v")).alias("own")).orderBy("v").collect()
    assert [r.own for r in rows] == sorted(r.own for r in rows)
    for r in rows:
        low, high = selection._bounds(r.own)
        assert low <= r.v <= high


@pytest.mark.parametrize("few", [4096, 3])
def test_every_n_with_wide_and_tied_positions(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "_FEW", few)
    rng = random.Random(2)
    names = ["", "a", "a\0", "ab", "é", "abcdefgh", "abcdefghi", "abcdefgh\0", None]
    rows = [(rng.choice([5, 5, 5, -(2**62), 2**62, rng.getrandbits(60), rng.randrange(9000)]), rng.choice(names), i) for i in range(300)]
    df = spark.createDataFrame(rows, "pos long, name string, id int").repartition(4)
    ordered = sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode(), r[2]))
    for n in (1, 2, 40, 77, 150, 299, 300, 301):
        got = selection.first_n(df, n, "pos", ["name", "id"]).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, ordered[:n]))


def test_a_position_that_holds_most_rows(spark):
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, id, 7L) AS pos", "id % 3 AS kind", "CAST(id AS STRING) AS text")
    got = selection.first_n(df, 9_000, "pos", ["text"])
    rows = [(r.pos, r.text) for r in got.collect()]
    want = sorted(((i if i % 10 == 0 else 7, str(i)) for i in range(20_000)))[:9_000]
    assert sorted(rows) == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_positions_are_whole_numbers(spark):
    with pytest.raises(TypeError):
        selection.first_n(spark.range(3).selectExpr("CAST(id AS STRING) AS pos"), 1)
    with pytest.raises(TypeError):
        selection.first_n(spark.sql("SELECT 1L AS pos, 1.5D AS x UNION ALL SELECT 1L, 2.5D"), 1, "pos", ["x"])
