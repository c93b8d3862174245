"""Deduplication, balancing, stable fractions, arms and seeds against plain Python."""

import pytest

from tallyloom.operators import curate, evalruns, selection
from pyspark.sql import functions as F


def test_deduplicate_keeps_the_lowest_position(spark):
    rows = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, None), (4, None)], "pos long, k string")
    assert sorted(r.pos for r in curate.deduplicate(rows, F.col("k")).collect()) == [1, 2, 4]


def test_deduplicate_goes_by_key_and_position(spark):
    rows = spark.createDataFrame([(1, "a"), (0, "b"), (1, "b"), (2, "a")], "pos long, k string")
    assert sorted((r.pos, r.k) for r in curate.deduplicate(rows, F.col("k")).collect()) == [(0, "b"), (1, "a")]


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "a")], [(1, "a"), (None, "a")]])
def test_deduplicate_without_an_order_is_an_error(spark, rows):
    with pytest.raises(Exception, match="share pos 1|a row has no pos"):
        curate.deduplicate(spark.createDataFrame(rows, "pos long, k string"), F.col("k")).collect()


def test_balance_needs_keys(spark):
    with pytest.raises(Exception, match="a row has no id"):
        curate.balance(spark.createDataFrame([(1, "g"), (None, "g")], "id long, g string"), "g", "id", 5).collect()


def test_balance_takes_the_first_of_each_group(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "rare").alias("g"))
    ranks = {r.id: (r.r, r.id, r.g) for r in rows.select("id", "g", selection.seeded_rank(F.col("id"), 4).alias("r")).collect()}
    want = {i for g in ("hot", "rare", None) for i in [x[1] for x in sorted(v for v in ranks.values() if v[2] == g)][:700]}
    got = curate.balance(rows, "g", "id", 700, 4).collect()
    assert {r.id for r in got} == want and len(got) == len(want)


def test_stable_fraction(spark):
    ids = spark.range(4000)
    half = {r.id for r in selection.stable_fraction(ids, "id", 0.5, 1).collect()}
    assert half == {r.id for r in selection.stable_fraction(ids.repartition(9), "id", 0.5, 1).collect()}
    assert 1850 < len(half) < 2150 and {r.id for r in selection.stable_fraction(ids, "id", 0.25, 1).collect()} < half


def test_arms(spark):
    a = spark.createDataFrame([("m", "p50", 2.0), ("n", "p50", 1.0)], "metric string, stat string, value double")
    b = spark.createDataFrame([("m", "p50", 5.0)], "metric string, stat string, value double")
    got = {r.metric: (r.x, r.y, r.delta) for r in curate.compare_arms({"x": a, "y": b}).collect()}
    assert got == {"m": (2.0, 5.0, 3.0), "n": (1.0, None, None)}


def test_seed_statistics(spark):
    rows = [("a_seed1", "t", 1.0), ("a_seed22", "t", 3.0), ("b_seed1", "t", 2.0), ("c", "t", 9.0)]
    got = {r.id: (r.n_seeds, r.mean, r.spread) for r in evalruns.seed_statistics(spark.createDataFrame(rows, "run string, task string, value double")).collect()}
    assert got["b"] == (1, 2.0, None) and got["a"][:2] == (2, 2.0) and abs(got["a"][2] - 2**0.5) < 1e-9 and set(got) == {"a", "b"}
