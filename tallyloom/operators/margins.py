"""Balancing a corpus along two axes at once: cell quotas by proportional fitting, rows by seeded hash order.

The rows are counted per cell (a pair of values) by Spark and only that table is fitted; the rows themselves never leave
their tasks. Both axes are short lists of categories (languages, domains): ``max_cells`` states how many pairs may be
fitted, and more are an error that names the axis pair, because every quota depends on every other.
"""

from __future__ import annotations

from collections import deque
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.curate import first_of_groups

_ROUNDS, _HALVINGS, _CLOSE = 500, 60, 1e-7


def apportion(sizes: list[int], weights: list[float], total: int) -> list[int]:
    """Whole-number shares of ``total`` in proportion to ``weights``, none above its size.

    What a full share cannot take is shared anew among the others; left-over units go to the largest fractions, equal
    fractions in the order given. A total beyond the sizes is an error.
    """
    if total > sum(size for size, w in zip(sizes, weights, strict=True) if w > 0):
        raise ValueError(f"{total} rows wanted of {sum(sizes)}")
    weight = [Fraction(str(w)) for w in weights]
    shares = [Fraction(0)] * len(sizes)
    rest, open_weight = Fraction(total), sum(weight)
    # Shares reach their size in the order of size per weight.
    for i in sorted((i for i, w in enumerate(weight) if w > 0), key=lambda i: sizes[i] / weight[i]):
        shares[i] = min(Fraction(sizes[i]), rest * weight[i] / open_weight)
        rest -= shares[i]
        open_weight -= weight[i]
    whole = [int(s) for s in shares]
    by_fraction = sorted(range(len(sizes)), key=lambda i: (whole[i] - shares[i], i))
    for i in by_fraction[: total - sum(whole)]:
        whole[i] += 1
    return whole


def _scales(at: np.ndarray, counts: np.ndarray, other: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Per line of an axis, the least factor with which ``counts * min(1, factor * other)`` adds up to ``wanted``."""
    n = len(wanted)
    most = np.zeros(n)
    np.maximum.at(most, at, np.divide(1.0, other, out=np.zeros_like(other), where=other > 0))
    low, high = np.full(n, -200.0), np.log2(np.maximum(most, 1e-60))
    for _ in range(_HALVINGS):
        middle = (low + high) / 2
        enough = np.bincount(at, counts * np.minimum(1.0, np.exp2(middle)[at] * other), n) >= wanted
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)
    return np.where(wanted > 0, np.exp2(high), 0.0)


def fit(rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, row_totals: np.ndarray, col_totals: np.ndarray) -> np.ndarray:
    """Fractional quotas of the cells with both margins, as close to the cells' proportions as their sizes allow.

    Iterative proportional fitting in which a cell stops at its size: each round solves one axis exactly for its factors
    and then the other. Margins that cannot be met leave the second one short.
    """
    second = np.ones(len(col_totals))
    for _ in range(_ROUNDS):
        first = _scales(rows, counts, second[cols], row_totals)
        second = _scales(cols, counts, first[rows], col_totals)
        quotas = counts * np.minimum(1.0, first[rows] * second[cols])
        if np.abs(np.bincount(rows, quotas, len(row_totals)) - row_totals).max(initial=0) < _CLOSE * max(1, counts.sum()):
            break
    return quotas


def round_to_margins(
    rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, quotas: np.ndarray, row_totals: np.ndarray, col_totals: np.ndarray
) -> np.ndarray:
    """Whole quotas with exactly the two margins, starting from the fractional ones rounded down.

    Missing units go to the largest fractions first; the rest by alternating paths (one cell up, another of its column
    down, and so on), which find a whole solution whenever there is one. If there is none, the error says how much is missing.
    """
    whole = np.minimum(np.floor(quotas + 1e-6), counts).astype(np.int64)
    for at, totals in ((rows, row_totals), (cols, col_totals)):
        over = np.bincount(at, whole, len(totals)).astype(np.int64) - totals
        for cell in np.flatnonzero(over[at] > 0):
            down = min(int(whole[cell]), max(0, int(over[at[cell]])))
            whole[cell] -= down
            over[at[cell]] -= down
    row_needs = row_totals - np.bincount(rows, whole, len(row_totals)).astype(np.int64)
    col_needs = col_totals - np.bincount(cols, whole, len(col_totals)).astype(np.int64)
    for cell in np.argsort(-(quotas - whole), kind="stable"):
        i, j = rows[cell], cols[cell]
        if quotas[cell] > whole[cell] and whole[cell] < counts[cell] and row_needs[i] > 0 and col_needs[j] > 0:
            whole[cell] += 1
            row_needs[i] -= 1
            col_needs[j] -= 1
    of_row = [np.flatnonzero(rows == i) for i in range(len(row_totals))]
    of_col = [np.flatnonzero(cols == j) for j in range(len(col_totals))]
    for i in np.flatnonzero(row_needs > 0):
        while row_needs[i] > 0:
            came: dict = {("row", i): None}
            queue, end = deque([("row", i)]), None
            while queue and end is None:
                kind, line = node = queue.popleft()
                if kind == "row":
                    steps = [(("col", cols[c]), c) for c in of_row[line] if whole[c] < counts[c]]
                elif col_needs[line] > 0:
                    end = node
                    break
                else:
                    steps = [(("row", rows[c]), c) for c in of_col[line] if whole[c] > 0]
                for step, cell in steps:
                    if step not in came:
                        came[step] = (node, cell)
                        queue.append(step)
            if end is None:
                raise ValueError(f"both margins cannot be met: {int(row_needs.clip(0).sum())} rows are missing")
            col_needs[end[1]] -= 1
            row_needs[i] -= 1
            while came[end] is not None:
                before, cell = came[end]
                whole[cell] += 1 if end[0] == "col" else -1
                end = before
    return whole


def _in_order(values: set) -> list:
    return sorted(v for v in values if v is not None) + [None] * (None in values)


def cell_quotas(
    counts: dict[tuple, int], total: int, first_weights: dict | None = None, second_weights: dict | None = None
) -> dict[tuple, int]:
    """Rows to take of each (first, second) cell; a missing weight table means equal shares, a missing value weight 0."""
    cells = [(a, b) for a in _in_order({a for a, _ in counts}) for b in _in_order({b for _, b in counts}) if (a, b) in counts]
    axes, totals, places = [], [], []
    for axis, weights in ((0, first_weights), (1, second_weights)):
        values = _in_order({c[axis] for c in cells})
        index = {v: i for i, v in enumerate(values)}
        place = np.array([index[c[axis]] for c in cells], dtype=np.int64)
        sizes = np.bincount(place, [counts[c] for c in cells], len(values)).astype(np.int64).tolist()
        share = [1 if weights is None else weights.get(v, 0) for v in values]
        axes.append(values)
        places.append(place)
        totals.append(np.array(apportion(sizes, share, total), dtype=np.int64))
    size = np.array([counts[c] for c in cells], dtype=np.int64)
    if not total:
        return dict.fromkeys(cells, 0)
    whole = round_to_margins(*places, size, fit(*places, size, *totals), *totals)
    return {c: int(n) for c, n in zip(cells, whole, strict=True)}


def balance_margins(
    rows: DataFrame,
    first: str,
    second: str,
    key: str,
    total: int,
    first_weights: dict | None = None,
    second_weights: dict | None = None,
    seed: int = 0,
    max_cells: int = 100_000,
) -> DataFrame:
    """``total`` rows whose shares of ``first`` and of ``second`` both are the wanted ones, exactly.

    Shares are equal, or in proportion to the weights; a value with fewer rows than its share gives all of them and the
    others take over. Within the margins, cells keep their proportions (dependence between the axes stays as it is) as
    far as their sizes allow. NULL is a value of its own on either axis. Of each cell the first rows in a seeded hash
    order of ``key`` are taken; a row without a key is an error, and so are margins that cannot be met together.
    """
    lines = rows.groupBy(first, second).count().limit(max_cells + 1).collect()
    if len(lines) > max_cells:
        raise ValueError(f"more than {max_cells} pairs of {first} and {second}")
    quotas = cell_quotas({(r[0], r[1]): r[2] for r in lines}, total, first_weights, second_weights)
    types = [rows.schema[c].dataType.simpleString() for c in (first, second)]
    table = rows.sparkSession.createDataFrame(
        [(a, b, n) for (a, b), n in quotas.items() if n], f"_first {types[0]}, _second {types[1]}, _quota long"
    )

    def with_quota(bins: DataFrame) -> DataFrame:
        same = F.col(first).eqNullSafe(F.col("_first")) & F.col(second).eqNullSafe(F.col("_second"))
        return bins.join(table, same).drop("_first", "_second")

    return first_of_groups(rows, [first, second], key, with_quota, seed)
