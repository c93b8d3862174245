"""Reports: exact percentiles, duplicates, pair diagnostics, digests, and independence of partitioning."""

import statistics

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.operators import fingerprint, quality
from tallyloom.plans import catalog

LENGTHS = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]


def quantile(xs, p):
    xs = sorted(xs)
    at = (len(xs) - 1) * p
    low = int(at)
    high = min(low + 1, len(xs) - 1)
    return xs[low] + (xs[high] - xs[low]) * (at - low)


def texts(spark, strings):
    return spark.createDataFrame([(s,) for s in strings], "s STRING")


def sft(spark, outputs):
    return spark.createDataFrame([("i", None, o) for o in outputs], "instruction STRING, input STRING, output STRING")


def dpo(spark, pairs):
    return spark.createDataFrame([("p", "", c, r) for c, r in pairs], "instruction STRING, input STRING, chosen STRING, rejected STRING")


def test_percentiles(spark):
    got = quality.length_report(texts(spark, ["x" * n for n in LENGTHS]), F.length("s")).first()
    assert got.rows == 11
    assert (got.p50, got.p90, got.p95, got.p99) == pytest.approx((4.0, 6.0, 7.5, 8.7))
    assert got.mean == pytest.approx(statistics.mean(LENGTHS))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 1000])
def test_percentiles_match_the_definition(spark, n):
    xs = [(i * i * 31) % 257 for i in range(n)]
    got = quality.length_report(texts(spark, ["x" * x for x in xs]).repartition(5), F.length("s")).first()
    for name, p in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)):
        assert got[name] == pytest.approx(quantile(xs, p))


def test_empty_inputs(spark):
    got = quality.length_report(texts(spark, []), F.length("s")).first()
    assert (got.rows, got.p50, got.mean) == (0, None, 0.0)
    report = quality.sft_report(sft(spark, [])).first()
    assert report.rows == 0 and report.output_char_len.p99 is None and report.output_char_len["mean"] == 0.0
    assert report[quality.DUPLICATE_FRACTION] == 0.0 and report[quality.TRIGRAM_MEAN] == 0.0
    pairs = quality.dpo_report(dpo(spark, [])).first()
    assert pairs[quality.CHOSEN_LONGER] == 0.0 and pairs[quality.SHARED_PREFIX] == 0.0
    assert quality.duplicate_stats(texts(spark, []), F.col("s")).first().duplicate_fraction == 0.0


def test_duplicates(spark):
    got = quality.duplicate_stats(texts(spark, ["A  b", " a B\n", "ab"]), X.norm_key_bytes(F.col("s"))).first()
    assert (got.rows, got.unique_keys) == (3, 2) and got.duplicate_fraction == pytest.approx(1 / 3)


def test_sft_report(spark):
    report = quality.sft_report(sft(spark, ["a b c a b c", "A b  c a b c", "xyz"])).first()
    assert report.rows == 3 and report[quality.UNIQUE_KEYS] == 2
    assert report[quality.DUPLICATE_FRACTION] == pytest.approx(1 / 3)
    assert report[quality.TRIGRAM_MEAN] == pytest.approx(1 / 3)
    assert report.output_char_len.p50 == 11 and report.total_char_len.p50 == 12


def test_dpo_report(spark):
    report = quality.dpo_report(dpo(spark, [("abc", "ab"), ("ab", "ab c"), ("", "x"), ("xy", "zz")])).first()
    assert report[quality.CHOSEN_LONGER] == 0.25 and report[quality.SHARED_PREFIX] == 0.5
    assert report.len_diff_chosen_minus_rejected["mean"] == pytest.approx((1 - 2 - 1 + 0) / 4)
    assert report.len_diff_chosen_minus_rejected.p50 == pytest.approx(-0.5)


def test_identical_rows_in_one_hot_key(spark):
    hot = sft(spark, ["same text here"] * 3000 + [f"text {i}" for i in range(6000)]).repartition(16)
    report = quality.sft_report(hot).first()
    assert report.rows == 9000 and report[quality.UNIQUE_KEYS] == 6001


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_reports_do_not_depend_on_partitioning(spark, small, partitions):
    pairs = catalog.dpo_pairs(spark, small)
    assert quality.dpo_report(pairs.repartition(partitions)).collect() == quality.dpo_report(pairs).collect()
    cols = catalog.DPO_COLUMNS
    assert (
        fingerprint.content_digest(pairs.repartition(partitions), cols).first()
        == fingerprint.content_digest(pairs, cols).first()
    )


def test_digest_sees_copies_nulls_and_column_borders(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a STRING, b STRING")
        return fingerprint.content_digest(df, ["a", "b"]).first().digest

    variants = [[("ab", "c")], [("a", "bc")], [("ab", None)], [("ab", "")], [("ab", "c")] * 2, [("ab", "c"), ("ab", "d")]]
    assert len({digest(v) for v in variants}) == len(variants)
    assert digest([("x", "y"), ("z", "w")]) == digest([("z", "w"), ("x", "y")])


def test_snapshot_without_a_manifest(spark):
    document = fingerprint.quality_document(
        quality.sft_report(sft(spark, ["abc"])), quality.dpo_report(dpo(spark, [("a", "b")])), {"sft": "s", "dpo": "d"}
    )
    shot = fingerprint.snapshot(document).first()
    assert shot.export.recipe_id is None and shot.export.git_commit_at_export is None
    assert (shot.export.sft_rows, shot.export.dpo_rows, shot.export.sft_jsonl) == (1, 1, "s")


def test_file_hashes(spark, tmp_path):
    import hashlib

    texts(spark, ["a", "é"]).coalesce(1).write.json(str(tmp_path / "out"))
    row = fingerprint.file_hashes(spark, str(tmp_path / "out")).first()
    raw = next((tmp_path / "out").glob("part-*")).read_bytes()
    assert (row.sha256, row.bytes, row.rows) == (hashlib.sha256(raw).hexdigest(), len(raw), 2)


def parted(spark):
    rows = [(p, "i", None, "x " * (i % 9) + str(i % 5)) for i, p in enumerate(["a", "b", None, "", "c/d=e"] * 40)]
    return spark.createDataFrame([*rows, ("f", "i", "", None)], "p STRING, instruction STRING, input STRING, output STRING")


def test_stored_parts_add_up_to_the_report_of_their_rows(spark, tmp_path):
    rows = parted(spark)
    quality.store_cells(quality.sft_cells(rows, F.col("p")), f"{tmp_path}/cells")
    unions = {"all": ["a", "b", None, "", "c/d=e", "f"], "two": [None, "c/d=e"], "odd": ["", "f", "a"], "f": ["f"]}
    names = F.filter(F.array(*[F.when(F.array_contains(F.array(*map(F.lit, ps)), F.coalesce("part", F.lit("?"))) if None not in ps
                     else F.col("part").isNull() | F.col("part").isin([p for p in ps if p is not None]), F.lit(n)) for n, ps in unions.items()]), lambda x: x.isNotNull())
    got = {r.of: r.asDict(True) for r in quality.union_reports(quality.stored_cells(spark, f"{tmp_path}/cells"), names, quality.sft_findings()).collect()}
    assert set(got) == set(unions)
    for name, parts in unions.items():
        own = rows.filter(F.col("p").isin([p for p in parts if p is not None]) | (F.col("p").isNull() & F.lit(None in parts)))
        want = quality.sft_report(own).first().asDict(True)
        got[name].pop("of")
        assert got[name].pop(quality.TRIGRAM_MEAN) == pytest.approx(want.pop(quality.TRIGRAM_MEAN))
        assert got[name] == want


def test_a_part_stored_again_is_replaced_and_others_stay(spark, tmp_path):
    path, rows = f"{tmp_path}/cells", parted(spark)
    quality.store_cells(quality.sft_cells(rows, F.col("p")), path)
    quality.store_cells(quality.sft_cells(rows.filter("p = 'a'").limit(3), F.col("p")), path)
    reports = quality.union_reports(quality.stored_cells(spark, path), F.array("part"), quality.sft_findings()).collect()
    assert {r.of: r.rows for r in reports} == {"a": 3, "b": 40, None: 40, "": 40, "c/d=e": 40, "f": 1}
    only = quality.stored_cells(spark, path, ["b", None])
    assert {r.part for r in only.select("part").distinct().collect()} == {"b", None}
    assert len(only.inputFiles()) and "PartitionFilters: [folder" in only._jdf.queryExecution().executedPlan().toString()


def test_stored_parts_of_nothing(spark, tmp_path):
    quality.store_cells(quality.text_cells(texts(spark, []), "s", F.lit("x")), f"{tmp_path}/cells")
    assert quality.union_reports(quality.stored_cells(spark, f"{tmp_path}/cells"), F.array("part"), quality.text_findings()).count() == 0
