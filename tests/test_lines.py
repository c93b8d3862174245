"""Positions of lines: the same for every split, and named when a line is bad."""

import json
import random

import pytest

from tallyloom.operators import export
from tallyloom.sources import lines, readers


def write(folder, name, texts, end="\n"):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(texts) + end, encoding="utf-8")


def plain(folder):
    out = []
    for number, path in enumerate(sorted(p for p in folder.rglob("*") if p.is_file() and not p.name.startswith("_"))):
        at = 0
        for line in path.read_bytes().splitlines(keepends=True):
            out.append(((number << lines.OFFSET_BITS) + at, line.decode().rstrip("\n")))
            at += len(line)
    return out


@pytest.mark.parametrize("read", [3, 64, 1 << 20])
def test_every_split_gives_the_same_lines(tmp_path, monkeypatch, read):
    monkeypatch.setattr(lines, "READ_BYTES", read)
    rng = random.Random(read)
    for name in ("b.jsonl", "a/x.jsonl", "a/_skipped", "c.jsonl"):
        write(tmp_path, name, ["é" * rng.randrange(0, 30) for _ in range(40)], rng.choice(["", "\n", "\n\n"]))
    (tmp_path / "d.jsonl").write_text("")
    want = plain(tmp_path)
    for split in (1, 2, 7, 50, 1000, 10**6):
        reader = lines._Reader([str(tmp_path)], split)
        got = [(p, t.rstrip("\n")) for part in reader.partitions() for b in reader.read(part) for p, t in zip(b.column(0).to_pylist(), b.column(3).to_pylist())]
        assert got == want


def test_caps_without_a_position_field(spark, tmp_path):
    rows = [{"instruction": f"i{i}", "output": "x" * (i % 50)} for i in range(500)]
    write(tmp_path, "in/2.jsonl", [json.dumps(r) for r in rows[:250]])
    write(tmp_path, "in/10.jsonl", [json.dumps(r) + "\r" for r in rows[250:]] + ["", "  "])
    want = [r["instruction"] for r in [*rows[250:], *rows[:250]] if len(r["output"]) > 20][:40]
    for split in (100, 5000, 1 << 20):
        raw = lines.read_json_lines(spark, str(tmp_path / "in"), readers.SFT_SOURCE, split)
        got = export.sft_examples(raw, min_chars=25, cap=300).orderBy("pos").select("instruction", "output").collect()
        assert [r.instruction for r in got if len(r.output) > 20][:40] == want
    assert [r.instruction for r in export.sft_examples(readers.read_sft(spark, str(tmp_path / "in"), order="lines"), cap=3).orderBy("pos").collect()] == ["i251", "i252", "i253"]


def test_a_bad_line_is_named(spark, tmp_path):
    write(tmp_path, "x.jsonl", ['{"text": "é"}', "", '{"text": '])
    raw = readers.read_texts(spark, str(tmp_path / "x.jsonl"), order="lines")
    with pytest.raises(Exception, match=r"malformed line in .*x\.jsonl at byte 16"):
        raw.collect()
    write(tmp_path, "y.jsonl", ['{"text": "a"}', "[1]"])
    with pytest.raises(Exception, match=r"malformed line in .*y\.jsonl at byte 14"):
        readers.read_texts(spark, str(tmp_path / "y.jsonl"), order="lines").collect()


def test_preferences_with_content_of_both_kinds(spark, tmp_path):
    say = lambda content: [{"role": "user", "content": "q"}, {"role": "assistant", "content": content}]
    write(tmp_path, "p.jsonl", [json.dumps({"prompt": "p", "chosen": say("a"), "rejected": say([{"text": "b"}, {"text": "c"}])})])
    pair = export.dpo_pairs(readers.read_preferences(spark, str(tmp_path / "p.jsonl"), order="lines")).first()
    assert (pair.pos, pair.chosen, pair.rejected) == (0, "a", "bc")


def test_empty_and_missing_sources(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert readers.read_texts(spark, str(tmp_path / "none"), order="lines").count() == 0
    with pytest.raises(Exception, match="nowhere"):
        readers.read_texts(spark, str(tmp_path / "nowhere"), order="lines").count()
