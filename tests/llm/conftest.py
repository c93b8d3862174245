import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def classes(ids, linked):
    """Least id reachable, by plain union of all pairs."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(a, b):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def similar(a, b):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= 80 * (len(a) + len(b) - common)


@pytest.fixture
def docs(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def helpers():
    return {"words": words, "shingles": shingles, "classes": classes, "similar": similar}
