"""Digest trees: differences of two stored arms against counters, and how much of them is read."""

from collections import Counter

import pytest

from tallyloom.operators import digests

SCHEMA = "id long, name string"


def stored(spark, tmp_path, name, rows, digits=1):
    path = str(tmp_path / name)
    digests.store_arm(spark.createDataFrame(rows, SCHEMA), ["id", "name"], path, digits)
    return path


def changes(spark, a, b, digits=1):
    got = digests.compare_stored(spark, a, b, SCHEMA, digits).collect()
    return Counter({(r.id, r.name): r.rows if r.change == "added" else -r.rows for r in got})


BASE = [(i, f"n{i % 7}") for i in range(2000)] + [(5, None)] * 900 + [(None, None)] * 3


@pytest.mark.parametrize(
    "other",
    [
        BASE,
        BASE[::-1],
        BASE[:-1],
        BASE + [(5, None), (1, "new"), (1, "new")],
        [r for r in BASE if r[0] != 17] + [(17, None)],
        [],
        [(i + 10_000, "other") for i in range(50)],
    ],
)
def test_changes_against_counters(spark, tmp_path, other):
    a, b = stored(spark, tmp_path, "a", BASE), stored(spark, tmp_path, "b", other)
    want = Counter(other)
    want.subtract(Counter(BASE))
    assert changes(spark, a, b) == {row: n for row, n in want.items() if n}


def test_only_differing_folders_are_read(spark, tmp_path):
    """Every other folder's files are spoilt after storing: a scan of one of them would fail."""
    a, b = stored(spark, tmp_path, "a", BASE, 2), stored(spark, tmp_path, "b", BASE[:-1] + [(9, "x")], 2)
    parts = digests.differing_parts(spark, a, b, 2)
    assert 1 <= len(parts) <= 2
    spoilt = 0
    for arm in ("a", "b"):
        for file in (tmp_path / arm / "rows").glob("_part=*/*.parquet"):
            if int(file.parent.name.removeprefix("_part=")) not in parts:
                file.write_bytes(b"spoilt")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
                spoilt += 1
    assert spoilt > 400
    assert changes(spark, a, b, 2) == {(None, None): -1, (9, "x"): 1}


def test_equal_arms_and_empty_arms(spark, tmp_path):
    a, b = stored(spark, tmp_path, "a", []), stored(spark, tmp_path, "b", [])
    assert digests.differing_parts(spark, a, b, 1) == [] and not changes(spark, a, b)
