"""All-or-nothing exports: what is written, what a failure leaves, and what the manifest says of the files."""

import hashlib
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyloom.operators import export, fingerprint
from tallyloom.plans import jobs
from tallyloom.plans.recipe import Recipe, Source
from tallyloom.sources import exporter, readers, writers

def hashed():
    return fingerprint.row_hash(F.col("text"))



def texts(spark, n, parts=4):
    return spark.createDataFrame([(i, f"é😀 {i}\n\"" if i % 7 else None) for i in range(n)], "pos BIGINT, text STRING").repartition(parts)


def test_files_in_order_with_hashes(spark, tmp_path):
    df = texts(spark, 500, 9)
    files = exporter.write_lines(df, str(tmp_path / "out"), hashed(), columns=["text"], rows_per_file=30)
    found = sorted((tmp_path / "out").iterdir())
    assert [p.name for p in found] == [f.file for f in files]
    assert [hashlib.sha256(p.read_bytes()).hexdigest() for p in found] == [f.sha256 for f in files]
    assert [p.stat().st_size for p in found] == [f.bytes for f in files] and max(f.rows for f in files) <= 30
    lines = [json.loads(x) for p in found for x in p.read_text().splitlines()]
    assert [x["text"] for x in lines] == [r.text for r in df.orderBy("pos").collect()]
    assert fingerprint.content_digest(df, ["text"]).first() == (500, str(sum(int(f.digest) for f in files)))
    writers.write_jsonl(df, str(tmp_path / "plain"))
    plain = [x for p in sorted((tmp_path / "plain").glob("part-*")) for x in p.read_text().splitlines()]
    assert plain == [x for p in found for x in p.read_text().splitlines()]


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    df = texts(spark, 400).withColumn("text", F.when(F.col("pos") == 399, F.raise_error(F.lit("broken row"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken row"):
        exporter.write_lines(df, str(tmp_path / "out"), hashed(), columns=["text"], order_by=None, rows_per_file=5)
    assert list(tmp_path.iterdir()) == []


def test_the_commit_removes_files_of_other_attempts(tmp_path):
    (tmp_path / "out").mkdir()
    for name in ("part-00000-00000-1.jsonl", "part-00000-00000-2.jsonl"):
        (tmp_path / "out" / name).write_text("x\n")
    kept = exporter.File("part-00000-00000-2.jsonl", 2, 1, "s", "0")
    exporter._Writer(str(tmp_path / "out"), 10).commit([None, exporter.Receipt(0, [kept])])
    assert [p.name for p in (tmp_path / "out").iterdir()] == [kept.file]


def test_a_failed_job_leaves_what_was_there(spark, tmp_path):
    out, recipe = str(tmp_path / "out"), Recipe("r", sources={"cpt": Source("here", revision="main", resolved="abc", config="en")}, path="r.json")
    good = texts(spark, 50)
    done = jobs.export_frames(spark, out, {"cpt": good}, {"cpt": good}, recipe)
    before = sorted((str(p.relative_to(tmp_path)), p.read_bytes()) for p in tmp_path.rglob("*") if p.is_file())
    broken = good.withColumn("text", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        jobs.export_frames(spark, out, {"sft": good, "cpt": broken}, {"cpt": broken}, recipe, overwrite=True)
    with pytest.raises(export.EmptyExportError):
        jobs.export_frames(spark, out, {"cpt": good}, {"cpt": good.filter("false")}, recipe, overwrite=True)
    with pytest.raises(AnalysisException):
        jobs.export_frames(spark, out, {"cpt": good}, {"cpt": good}, recipe)
    assert before == sorted((str(p.relative_to(tmp_path)), p.read_bytes()) for p in tmp_path.rglob("*") if p.is_file())
    manifest = json.loads((tmp_path / "out" / "manifest.json").read_text())
    source = manifest["sources"][0]
    assert (source["revision_requested"], source["revision_resolved"], source["config"], manifest["recipe_path"]) == ("main", "abc", "en", "r.json")
    assert json.loads((tmp_path / "out" / "dataset_info.json").read_text()) == {"cpt": {"file_name": "cpt.jsonl", "columns": {"prompt": "text"}}}
    again = jobs.export_frames(spark, out, {"cpt": good}, {"cpt": good.limit(3)}, recipe, overwrite=True)
    assert (done.rows, again.rows) == ({"cpt": 50}, {"cpt": 3}) and sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    assert readers.read_export(spark, again.paths["cpt"], readers.CPT_EXPORT).count() == 3


def test_named_configurations(spark, tmp_path):
    for name in ("en", "de"):
        texts(spark, 3).withColumn("text", F.lit(name)).write.json(str(tmp_path / name))
    assert {r.text for r in readers.read_texts(spark, str(tmp_path), config="de").collect()} == {"de"}
