"""Text expressions: traps, and independent Python definitions over real and random text."""

import hashlib
import re
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import text as X

CODE_POINTS = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]


def values(spark, strings, *exprs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i INT, s STRING")
    rows = df.select("i", *[e.alias(f"c{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    return [r[1] if len(exprs) == 1 else tuple(r)[1:] for r in rows]


def py_norm_key(s):
    return hashlib.sha256(re.sub(r"\s+", " ", s.strip().lower()).encode()).hexdigest()


def py_trigram(s):
    words = re.findall(r"\w+", s.lower())
    grams = list(zip(words, words[1:], words[2:]))
    return sum(grams.count(g) > 1 for g in grams) / len(grams) if grams else 0.0


def test_whitespace_is_pythons_over_all_code_points(spark):
    df = spark.range(sys.maxunicode + 1).filter("id < 55296 OR id > 57343")
    after_x = F.decode(F.unhex(F.concat(F.lit("00000078"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32")
    chars = df.select("id", after_x.alias("ch"))
    found = {r[0] for r in chars.filter(F.col("ch").rlike("^x" + X.WHITESPACE_CLASS + r"\z")).collect()}
    assert found == {c for c in CODE_POINTS if re.match(r"\s", chr(c))}
    stripped = {r[0] for r in chars.filter(X.strip(F.col("ch")) == "x").collect()}
    assert stripped == {c for c in CODE_POINTS if chr(c).strip() == ""}


@pytest.mark.parametrize(
    "raw", ["", " ", "a", "\n a \n", "a\n", "  a b　", "\x1c\x1fx\x1d", "​x", "x﻿", "a\r\n\r\n"]
)
def test_strip_edges(spark, raw):
    assert values(spark, [raw], X.strip(F.col("s"))) == [raw.strip()]


def test_long_whitespace_runs_are_linear(spark):
    raw = ("a" + " " * 200_000) * 5 + "b"
    assert values(spark, [raw], F.length(X.normalise(F.col("s")))) == [11]


def test_norm_key_joins_trivial_variants(spark):
    keys = values(spark, ["A  b", " a B\n", "ab"], X.norm_key(F.col("s")))
    assert keys[0] == keys[1] != keys[2]
    assert values(spark, ["A b"], F.hex(X.norm_key_bytes(F.col("s"))))[0].lower() == keys[0]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t　\x1cß.0_", max_size=40), min_size=1, max_size=20))
def test_text_features_match_python(spark, strings):
    col = F.col("s")
    got = values(spark, strings, X.strip(col), X.norm_key(col), X.trigram_repetition(col), F.length(col))
    assert got == [(s.strip(), py_norm_key(s), pytest.approx(py_trigram(s)), len(s)) for s in strings]


@pytest.mark.parametrize(
    "raw,score",
    [("a b c a b c", 0.5), ("a b", 0.0), ("", 0.0), ("a b c", 0.0), ("été là été là été", 2 / 3), ("x " * 10, 1.0)],
)
def test_trigram_repetition(spark, raw, score):
    assert values(spark, [raw], X.trigram_repetition(F.col("s"))) == [pytest.approx(score)]


def test_trigrams_of_real_documents(spark, small):
    rows = (
        spark.read.parquet(f"{small}/documents.parquet")
        .select("text", X.trigram_repetition(F.col("text")).alias("t"), X.norm_key(F.col("text")).alias("k"))
        .collect()
    )
    for r in rows:
        words = re.findall(r"\w+", r.text.lower())
        seen = {}
        for g in zip(words, words[1:], words[2:]):
            seen[g] = seen.get(g, 0) + 1
        total = sum(seen.values())
        assert r.t == (sum(n for n in seen.values() if n > 1) / total if total else 0.0)
        assert r.k == py_norm_key(r.text)


def test_joined_length_keeps_inner_newlines(spark):
    df = spark.createDataFrame([("ab", "", "cd")], "a STRING, b STRING, c STRING")
    assert df.select(X.joined_length(F.col("a"), F.col("b"), F.col("c"))).first()[0] == 6


def test_truncate_counts_code_points(spark):
    assert values(spark, ["😀" + "a" * 8000], F.length(X.truncate(F.col("s"), 8000))) == [8000]


@pytest.mark.parametrize("a,b,expected", [("abc", "ab", True), ("ab", "ab c", True), ("", "x", False), ("ab", "ac", False)])
def test_shared_prefix(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a STRING, b STRING")
    assert df.select(X.shares_whole_prefix(F.col("a"), F.col("b"))).first()[0] is expected


@pytest.mark.parametrize(
    "title,text,expected",
    [(" T ", " x ", "T x"), ("  ", " x ", "x"), (None, "x", "x"), ("T", None, "T"), (None, None, "")],
)
def test_passage(spark, title, text, expected):
    df = spark.createDataFrame([(title, text)], "title STRING, text STRING")
    assert df.select(X.passage(F.col("title"), F.col("text"))).first()[0] == expected
