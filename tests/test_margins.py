"""Balancing along two axes: fitted quotas, exact margins, and rows by hash order, against plain definitions."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import margins, selection


def sums(quotas, axis):
    out = {}
    for cell, n in quotas.items():
        out[cell[axis]] = out.get(cell[axis], 0) + n
    return out


def test_apportion():
    assert margins.apportion([10, 10, 10], [1, 1, 1], 10) == [4, 3, 3]
    assert margins.apportion([2, 100, 100], [5, 1, 1], 40) == [2, 19, 19]
    assert margins.apportion([5, 5], [1, 0], 5) == [5, 0]
    with pytest.raises(ValueError, match="11 rows wanted of 10"):
        margins.apportion([5, 5], [1, 1], 11)


def test_fitting_keeps_the_odds_ratio():
    rows, cols = np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])
    counts = np.array([4000, 1000, 2000, 3000])
    x = margins.fit(rows, cols, counts, np.array([100, 100]), np.array([100, 100]))
    assert x[0] + x[1] == pytest.approx(100, abs=1e-2) and x[0] + x[2] == pytest.approx(100, abs=1e-2)
    assert x[0] * x[3] / (x[1] * x[2]) == pytest.approx(6, rel=1e-3)


@pytest.mark.parametrize("seed", range(25))
def test_margins_are_met_whenever_they_can_be(seed):
    rng = np.random.default_rng(seed)
    names = [("a", "b", None), ("x", "y")]
    counts = {c: int(rng.integers(0, 5)) for c in itertools.product(*names)}
    counts = {c: n for c, n in counts.items() if n}
    total = int(rng.integers(0, sum(counts.values()) + 1))
    wanted = []
    for axis in (0, 1):
        sizes = sums(counts, axis)
        values = margins._in_order(set(sizes))
        wanted.append(dict(zip(values, margins.apportion([sizes[v] for v in values], [1] * len(values), total), strict=True)))
    possible = any(
        [sums(dict(zip(counts, q, strict=True)), axis) for axis in (0, 1)] == [{v: w[v] for v in sums(counts, axis)} for axis, w in enumerate(wanted)]
        for q in itertools.product(*[range(n + 1) for n in counts.values()])
    )
    if not possible:
        with pytest.raises(ValueError, match="cannot be met"):
            margins.cell_quotas(counts, total)
        return
    quotas = margins.cell_quotas(counts, total)
    assert all(0 <= n <= counts[c] for c, n in quotas.items())
    assert [sums(quotas, 0), sums(quotas, 1)] == wanted


def test_rows_are_the_first_of_their_cells(spark):
    rows = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 1, "rare").alias("lang"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("site"),
    )
    got = margins.balance_margins(rows, "lang", "site", "id", 900, {"hot": 1, "rare": 1, None: 2}, seed=4).collect()
    assert len(got) == 900 == len({r.id for r in got})
    per = lambda i: {v: sum(1 for r in got if r[i] == v) for v in {r[i] for r in got}}
    assert per(1) == {"hot": 225, "rare": 225, None: 450} and set(per(2).values()) == {225}
    ranks = rows.select("id", "lang", "site", selection.seeded_rank(F.col("id"), 4).alias("r")).collect()
    for cell in {(r.lang, r.site) for r in got}:
        taken = {r.id for r in got if (r.lang, r.site) == cell}
        order = sorted((r.r, r.id) for r in ranks if (r.lang, r.site) == cell)
        assert taken == {i for _, i in order[: len(taken)]}


def test_edges(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, None)], "id long, lang string, site string")
    assert margins.balance_margins(rows.limit(0), "lang", "site", "id", 0).count() == 0
    assert margins.balance_margins(rows, "lang", "site", "id", 0).count() == 0
    assert margins.balance_margins(rows, "lang", "site", "id", 3).count() == 3
    with pytest.raises(ValueError, match="more than 2 pairs"):
        margins.balance_margins(rows, "lang", "site", "id", 3, max_cells=2)
    with pytest.raises(ValueError, match="rows wanted of 3"):
        margins.balance_margins(rows, "lang", "site", "id", 4)
