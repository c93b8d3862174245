"""Vectors, archives, pages, mixes, chats and components against plain definitions."""

import hashlib
import html
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import chat, components, embedding_dedup, htmltext, mixing, pagegen, warc


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for p in links if p[0] != p[1] for x in p}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_vectors(rows):
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(i, j):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        if la is None or la != lb or rows[i][0] is None or rows[j][0] is None or not ok(a) or not ok(b) or len(a) != len(b):
            return False
        x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
        return x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98

    return [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]


@pytest.mark.parametrize("tile", [1024, 3])
def test_embedding_links(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    rows = [(i, (centres[i % 6] + rng.normal(size=24) * rng.choice([0, 0.05, 0.14])).tolist(), int(i % 6 % 3)) for i in range(90)]
    rows += [(100, [0.0] * 24, 1), (101, None, 1), (102, [None] + [1.0] * 23, 1), (103, [float("nan")] * 24, 1), (104, rows[0][1], None)]
    rows += [(105, rows[0][1], 0), (None, rows[0][1], 0), (106, [1.0, 0.0], 0), (107, [2.0, 0.0], 0), (108, [1.0], 0), (109, [3.0], 0), (110, [], 0)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r.vec_id: r.n_links for r in got} == {r[0]: n for r, n in zip(rows, plain_vectors(rows))}
    assert {r.vec_id: r.kept for r in got}[None] is False and {r.vec_id: r.component_id for r in got}[105] == 0
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_archives(spark, tmp_path):
    long = "<p>é" + "x" * 1200 + "\r\n\r\nWARC/1.1\r\n\r\nfiledesc://\n</p>"
    rows = [(1, "http://a/ b", long), (2, None, long), (3, "http://c", "short"), (4, "http://d", "short"), (5, "u", None), (None, "u", long), (2, "x", long), (6, "u", "")]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    size, digest = len(long.encode()), hashlib.sha1(long.encode()).hexdigest()
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got))) == sorted(
        map(str, [(1, size, "revisit", 2), (2, size, "response", None), (2, size, "response", None), (3, 5, "response", None), (4, 5, "response", None), (5, 0, "response", None), (6, 0, "response", None), (None, size, "response", None)])
    )
    assert {r.payload_digest for r in got if r.page_id == 1} == {digest}
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_arc_headers_by_version():
    import gzip

    one = b"filedesc://x 0.0.0.0 19960101000000 text/plain 74\n1 0 o\nURL IP-address Archive-date Content-type Archive-length\nxxxxxxxxxx\n\n"
    body = b"1 0 o\nURL IP-address Archive-date Content-type Archive-length\n"
    two_body = b"2 0 o\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    one = b"filedesc://x 0.0.0.0 19960101000000 text/plain %d\n" % len(body) + body + b"\nhttp://a 1.1.1.1 19970102030405 text/html 5\nab\ncd\n"
    two = b"filedesc://y 0.0.0.0 19960101000000 text/plain 200 - - 0 y %d\n" % len(two_body) + two_body + b"\ndns:a 1.1.1.1 19970102030405 text/dns 200 c - 9 y 3\nxyz\n"
    found = list(warc.arc_records(gzip.compress(one) + gzip.compress(two)))
    assert [(r["url"], r["version"], r["body"]) for r in found if not r["opens"]] == [("http://a", 1, b"ab\ncd"), ("dns:a", 2, b"xyz")]
    with pytest.raises(ValueError):
        list(warc.arc_records(gzip.compress(one[:-3])))


@pytest.fixture(scope="module")
def forest(spark):
    return htmltext.train(spark)


def test_main_text_of_the_given_pages(spark, small, forest):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: r for r in htmltext.extract_text(pages, forest).collect()}
    exact = 0
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") : r.html.index("</article>")].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|article)>", inner))
        exact += got[r.page_id].text == " ".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert exact >= 0.95 * len(got)


def test_main_text_of_unseen_layouts(forest):
    kept = wanted = both = 0
    for seed in range(10**6, 10**6 + 60):
        root, blocks = htmltext.parse(pagegen.Writer(seed).page())
        nodes, x = htmltext.features(root)
        chosen = {id(n) for n, k in zip(nodes, htmltext.decode(nodes, forest.logits(x))) if k}
        for node, text in blocks:
            main, own = False, node
            while own is not None:
                main, own = main or own.keep, own.parent
            wanted += main * len(text)
            kept += (id(node) in chosen) * len(text)
            both += (main and id(node) in chosen) * len(text)
    assert both / kept > 0.97 and both / wanted > 0.97


def test_pages_without_text_and_bad_markup(spark, forest):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<html><script>x</p>"), (4, "u", "a < b &lt; <!-- <p> c"), (5, "u", "</div></p><p>x<p"), (6, "u", "<div>" * 3000 + "deep text here" + "</div>" * 10)]
    got = {r.page_id: r for r in htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"), forest).collect()}
    assert len(got) == 6 and [got[i].text for i in (1, 2, 3)] == [""] * 3
    assert htmltext.extract_text(spark.createDataFrame([], "page_id long, url string, html string"), forest).count() == 0


def test_decoding_never_contradicts_itself(forest):
    root, _ = htmltext.parse(pagegen.Writer(5).page())
    nodes, _ = htmltext.features(root)
    for seed in range(20):
        kept = htmltext.decode(nodes, np.random.default_rng(seed).normal(size=len(nodes)) * 3)
        state = {id(n): k for n, k in zip(nodes, kept)}
        assert all(not state[id(n)] or n.parent is None or state[id(n.parent)] for n in nodes)


def test_parser_blocks():
    _, blocks = htmltext.parse("<p><b>One</b>&amp;two<br>three<p>four<ul><li>five<li>six</ul><td>a<!-- x -->b")
    assert [t for _, t in blocks] == ["One&two three", "four", "five", "six", "ab"]


def test_targets_stop_at_their_bound():
    got = mixing.targets({"a": 10, "b": 1000, "c": 1000, None: 500})
    assert got["a"] == 30 and abs(sum(got.values()) - 2510) < 1e-6
    assert all(got[s] <= 3 * n + 1e-9 for s, n in {"a": 10, "b": 1000, "c": 1000, None: 500}.items())


def test_flow_serves_overlapping_sources_at_least_cost():
    patterns = {("a",): 100, ("a", "b"): 100, ("b",): 10}
    flow = mixing.route(patterns, {"a": 200, "b": 130})
    taken = {p: sum(f.values()) for p, f in flow.items()}
    assert sum(f.get("a", 0) for f in flow.values()) == 200 and sum(f.get("b", 0) for f in flow.values()) == 130
    assert all(taken[p] <= 3 * n for p, n in patterns.items())
    cost = sum(max(0, min(t, 2 * patterns[p]) - patterns[p]) + 2 * max(0, t - 2 * patterns[p]) for p, t in taken.items())
    assert cost == 120


def test_flow_reroutes():
    flow = mixing.route({("a", "b"): 10, ("a",): 10}, {"a": 10, "b": 10})
    assert {p: sum(f.values()) for p, f in flow.items()} == {("a", "b"): 10, ("a",): 10}


def repetition_cost(taken, patterns):
    return sum(max(0, t - k * patterns[p]) for p, t in taken.items() for k in (1, 2))


@pytest.mark.parametrize("seed", range(40))
def test_flow_against_every_flow(seed):
    rng = np.random.default_rng(seed)
    kinds = [("a",), ("b",), ("a", "b"), (None, "a")]
    patterns = {kinds[i]: int(rng.integers(0, 4)) for i in rng.permutation(4)[:3]}
    quotas = {s: int(rng.integers(0, 9)) for s in ("a", "b", None)}
    choices = []
    for p, size in patterns.items():
        parts = itertools.product(range(3 * size + 1), repeat=len(p))
        choices.append([(p, part) for part in parts if sum(part) <= 3 * size])
    best = (1, 0)
    for flows in itertools.product(*choices):
        got = dict.fromkeys(quotas, 0)
        for p, part in flows:
            for s, amount in zip(p, part, strict=True):
                got[s] += amount
        if all(got[s] <= quotas[s] for s in quotas):
            best = min(best, (-sum(got.values()), repetition_cost({p: sum(part) for p, part in flows}, patterns)))
    flow = mixing.route(patterns, quotas)
    taken = {p: sum(f.values()) for p, f in flow.items()}
    assert all(sum(f.get(s, 0) for f in flow.values()) <= quotas[s] for s in quotas)
    assert all(amount >= 0 and s in p for p, f in flow.items() for s, amount in f.items())
    assert (-sum(taken.values()), repetition_cost(taken, patterns)) == best


def test_flow_over_many_patterns_is_not_quadratic():
    patterns = {(f"s{i}",): 5 for i in range(20_000)} | {(f"s{i}", f"s{i + 1}"): 5 for i in range(20_000)}
    start = time.monotonic()
    flow = mixing.route(patterns, {f"s{i}": 12 for i in range(20_001)})
    assert sum(sum(f.values()) for f in flow.values()) == 12 * 20_001 and time.monotonic() - start < 20


def test_the_mix_takes_what_the_flow_routes(spark, monkeypatch):
    rows = [(i, "w w", "xyz"[i % 3]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "route", lambda patterns, quotas: {p: {p[0]: 20} for p in patterns})
    taken = {r.source: r.taken for r in frame.join(mixing.mix_by_source(frame).select("doc_id", "taken"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    assert taken == {"x": 20, "y": 20, "z": 20}


def test_mix_edge_cases(spark):
    rows = [(i, "w " * (i % 7 + 1), s) for i, s in enumerate(["x", "y", "z", None] * 50)] + [(None, None, "x"), (3, "", "y"), (3, "a b", "y"), (3, "a b", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_by_source(frame).collect()
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    again = mixing.mix_by_source(frame.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    source = {row[0]: row[2] for row in rows[4:200]}
    for name in ("x", "y", "z", None):
        own = [r for r in got if source.get(r.doc_id, "?") == name]
        assert len({r.target for r in own}) == 1 and abs(sum(r.taken for r in own) - own[0].target) <= 20
    assert mixing.mix_by_source(frame.limit(0)).count() == 0


def test_perspectives(spark, monkeypatch):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, None, "é"), (1, 4, "ann", "bye"), (2, 0, "system", "x"), (None, 1, "ann", "y"), (3, None, "a", "1"), (3, 5, "a", "2"), (3, 5, "a", "2")]
    got = {(r.conv_id, r.speaker): r for r in chat.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (3, "a")}
    ann = got[1, "ann"]
    assert ann.rendered == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi <\\|im_end|><|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n"
        "<|im_start|>user name=unknown\né<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    )
    spans = [tuple(map(int, s.split(":"))) for s in ann.mask.split(",")]
    assert [ann.rendered[a:b] for a, b in spans] == ["hi <\\|im_end|><|im_end|>", "bye<|im_end|>"]
    assert ann.n_learn == sum(b - a for a, b in spans) and got[3, "a"].n_turns == 3
    monkeypatch.setattr(chat, "TURNS", 2)
    long = spark.createDataFrame([(1, i, "ab"[i % 2], str(i)) for i in range(31)], "conv_id long, turn long, role string, text string")
    blocks = sorted((r.block, r.rendered) for r in chat.perspectives(long).collect() if r.speaker == "a")
    monkeypatch.setattr(chat, "TURNS", 64)
    assert "".join(b for _, b in blocks) == next(r.rendered for r in chat.perspectives(long).collect() if r.speaker == "a")
    assert chat.perspectives(long.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page", ["<a ", "<a", "<a \"", "<a \"x\" '", "</b", "<script/>", "<b>", "<p><button><b><div>", "<!-", "<x class=\"", "<i></b>", "</script", "<div a='>"]
)
@pytest.mark.parametrize("end", ["", ">", "\">"])
def test_broken_pages_are_parsed_in_linear_time(page, end):
    begun = time.perf_counter()
    htmltext.parse("<p>one" + page * (1_000_000 // len(page)) + end)
    assert time.perf_counter() - begun < 20


def test_slashes_close_void_and_foreign_elements_alone():
    def blocks(page):
        return [(n.tag, t) for n, t in htmltext.parse(page)[1]]

    assert blocks("a<script src='x.js'/>var leak=1;</script>b") == [("#document", "ab")]
    assert blocks("a<style/>p {}</STYLE >b<svg/>c<svg>d</svg>e<br/>f") == [("#document", "abce f")]
    assert blocks("<div class='ad'/>buy now</div>x") == [("div", "buy now"), ("#document", "x")]
    assert blocks("a<object data=x/>b") == [("#document", "ab")] and blocks("a<script>b") == [("#document", "a")]


def test_quotes_in_tags():
    def blocks(page):
        return [t for _, t in htmltext.parse(page)[1]]

    assert blocks("<p title='a>b'>x</p><p title=\"it's>\">y</p>") == ["x", "y"]
    assert blocks("<p don't>x</p><p>y</p>") == ["x", "y"] and blocks("a <b") == ["a <b"]


@pytest.mark.parametrize("seed", range(40))
def test_decoding_against_all_labellings_of_small_trees(seed):
    rng = np.random.default_rng(seed)
    page, depth = "", 0
    for _ in range(int(rng.integers(1, 9))):
        page, depth = (page + "<div>t", depth + 1) if depth == 0 or rng.random() < 0.6 else (page + "</div>", depth - 1)
    nodes, _ = htmltext.features(htmltext.parse(page)[0])
    logits = rng.normal(size=len(nodes)) * 2
    number = {id(n): i for i, n in enumerate(nodes)}
    up = [number[id(n.parent)] if n.parent is not None else None for n in nodes]
    yes, no = -np.logaddexp(0, -logits), -np.logaddexp(0, logits)

    def score(kept):  # a node under a dropped one is dropped for certain
        if any(k and up[i] is not None and not kept[up[i]] for i, k in enumerate(kept)):
            return -np.inf
        return sum(yes[i] if k else no[i] for i, k in enumerate(kept) if up[i] is None or kept[up[i]])

    best = max(map(score, itertools.product((False, True), repeat=len(nodes))))
    assert abs(score([bool(k) for k in htmltext.decode(nodes, logits)]) - best) < 1e-9
