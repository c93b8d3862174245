"""Operators on texts against plain definitions: hand-made edge cases and brute force on the small tables."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import decontam, langid, ngram_join, pii, tokencount

WORDS = [f"w{i}" for i in range(400)]


def near_copies(seed):
    """Texts of a few originals with one to four changed words, plus copies, short, blank and null texts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(6):
        base = rng.choices(WORDS, k=rng.choice([6, 30, 80]))
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            texts.append(" ".join(own))
    shared = " ".join(rng.choices(WORDS, k=55))
    texts += [shared + " " + " ".join(rng.choices(WORDS, k=rng.choice([5, 60]))) for _ in range(20)]
    return [*texts, "", None, " \n", "One two", "one  TWO", "one two three", "É a b c d", "é a b c d"]


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_against_all_pairs(docs, helpers, seed):
    rows = list(enumerate(near_copies(seed)))
    sets = {i: helpers["shingles"](t) for i, t in rows}
    want = helpers["classes"](list(sets), lambda a, b: helpers["similar"](sets[a], sets[b]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_classes(docs(rows)).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_ngram_join_splits_large_blocks(docs, helpers, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    rows = list(enumerate(near_copies(3)))
    sets = {i: helpers["shingles"](t) for i, t in rows}
    want = helpers["classes"](list(sets), lambda a, b: helpers["similar"](sets[a], sets[b]))
    got = {r.doc_id: r.component_id for r in ngram_join.similar_classes(docs(rows)).collect()}
    assert got == want


@pytest.mark.parametrize("n", [256, 2048])
def test_ngram_join_of_one_template(docs, monkeypatch, n):
    """Notices that differ in one word: pairs left to verify do not grow with the square of the group."""
    monkeypatch.setattr(ngram_join, "CHUNK", 64)
    open_pairs, counted = ngram_join._open_pairs, []
    monkeypatch.setattr(ngram_join, "_open_pairs", lambda cand, comp: counted.append(open_pairs(cand, comp).count()) or open_pairs(cand, comp))
    notice = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*notice[:60], f"name{i}", *notice[61:]])) for i in range(n)]
    got = ngram_join.similar_classes(docs(rows)).collect()
    assert {(r.n_shingles, r.component_id) for r in got} == {(116, 0)} and len(got) == n
    assert counted[0] <= 4 * n


def test_ngram_join_over_many_flushes(docs, helpers, monkeypatch):
    monkeypatch.setattr(ngram_join, "FLUSH_TOKENS", 300)
    rows = list(enumerate(near_copies(4)))
    sets = {i: helpers["shingles"](t) for i, t in rows}
    want = helpers["classes"](list(sets), lambda a, b: helpers["similar"](sets[a], sets[b]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_classes(docs(rows)).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_ngram_join_sends_a_common_shingle_once_per_flush():
    sets = [np.array(sorted({5, 1000 + i, 2000 + i // 2}), np.uint64) << np.uint64(52) for i in range(50)]
    known = [(i, False, i, True, 3, i, i) for i in range(50)]
    packed = pa.Table.from_batches([ngram_join._pack(known, sets, 4, flush) for flush in (0, 1)])
    sent = np.concatenate([ngram_join._grow(t, np.uint64, steps=True) for t in packed.column("toks").to_pylist() if t])
    assert sorted(sent >> np.uint64(52)) == sorted(2 * [5, *range(1000, 1050), *range(2000, 2025)])
    buckets = sorted(set(packed.column("bucket").to_pylist()))
    counted = pa.concat_tables([ngram_join._count_bucket(packed.filter(pc.equal(packed.column("bucket"), b))) for b in buckets])
    for flush in (0, 1):
        got = ngram_join._assemble(counted.filter(pc.equal(counted.column("flush"), flush)))
        assert got.column("doc_id").to_pylist() == list(range(50))
        assert [np.frombuffer(t, np.uint64).tolist() for t in got.column("toks").to_pylist()] == [s.tolist() for s in sets]
        assert got.column("prefix").to_pylist() == [[(1000 + i) << 52] for i in range(50)]


def test_ngram_join_packs_values_without_loss():
    draw = np.random.default_rng(3)
    for kind in (np.uint32, np.int32, np.uint64):
        for size in (0, 1, 2, 1000):
            values = draw.integers(0, np.iinfo(kind).max, size, dtype=kind, endpoint=True)
            for steps in (False, True):
                assert np.array_equal(ngram_join._grow(ngram_join._shrink(values, steps), kind, steps), values)
                assert np.array_equal(ngram_join._grow(ngram_join._shrink(np.sort(values), steps), kind, steps), np.sort(values))


def test_ngram_join_ids_and_columns(docs):
    text = " ".join(WORDS[:40])
    rows = [(None, text, "x"), (7, text, "y"), (7, text, "z"), (3, text + " w1", None), (None, "lonely words", "q")]
    got = ngram_join.similar_classes(docs(rows, "doc_id long, text string, rep string"))
    assert sorted(map(str, ((r.doc_id, r.component_id) for r in got.collect()))) == sorted(map(str, [(None, 3), (7, 3), (7, 3), (3, 3), (None, None)]))
    assert ngram_join.similar_classes(docs([])).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


PERSONAL = [
    None,
    "",
    "é mail a@b.c%x@d.e and x.y@sub-1.host.org. or z@host, q@h..com @a.b a@.b",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 000.255.10.9, 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111--1111 1111 1111, 1234567890123456789012345",
    "call +1 (988) 555-2485 or +1 ((((2 or +12 or +441234567890123456",
    "IBAN GB82WEST12345698765432 and DE89370400440532013000 but DE00370400440532013000",
    "\x01a.b@c\x01d.ef 1\x011",
    "1" * 60_000 + " a.b" * 20_000 + " 1.1" * 20_000 + " +1" * 1000 + "a." * 20_000 + "@x" + ".y" * 20_000,
]


def test_pii_spans(docs):
    rng = random.Random(5)
    noise = ["".join(rng.choices("0123456789+ -().@abZ", k=rng.randrange(1, 120))) for _ in range(400)]
    rows = list(enumerate(PERSONAL + noise))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii] for r in pii.find_pii(docs(rows)).collect()}
    for i, text in rows:
        assert [s for s in got[i] if s[0] != "iban"] == plain_spans(text), repr(text)[:200]
    assert [s[0] for s in got[6]] == ["iban", "iban"]
    assert pii.find_pii(docs([])).count() == 0


def test_pii_context_and_redaction(docs):
    rows = [(1, "mail me: é a@b.co now"), (2, "zzz +1 988 555 2485 zzz"), (3, None), (4, "clean"), (5, "+1; 4111 1111 1111 1111 x"), (6, "+4111 1111 1111 1111 x")]
    found = pii.find_pii(docs(rows)).select("doc_id", "pii.confidence").collect()
    assert {r.doc_id: r.confidence for r in found}[1] == [95] and {r.doc_id: r.confidence for r in found}[2] == [60]
    texts = {r.doc_id: r.text for r in pii.redact_pii(docs(rows)).collect()}
    assert texts == {1: "mail me: é [EMAIL] now", 2: "zzz [PHONE] zzz", 3: None, 4: "clean", 5: "+1; [CARD] x", 6: "+[CARD] x"}


def test_pii_of_many_matches_in_one_text(docs):
    n = 100_000
    text = "mail " + " ".join(f"a{i}@b{i % 7}.org" + " xyz" * (i % 3) for i in range(n)) + " end"
    begun = time.perf_counter()
    found = pii.find_pii(docs([(1, text), (1, text), (2, "x@y.z" * 400)]).select("*", F.lit("kept").alias("__PII")))
    assert found.filter("doc_id = 1").select(F.size("pii").alias("n"), F.sha2(pii.span_text(F.col("pii")), 256)).distinct().collect()[0].n == n
    spans = found.filter("doc_id = 1").select("pii").first().pii
    assert [(s.kind, s.start, s.end) for s in spans] == plain_spans(text) and [s.confidence for s in spans[:2]] == [95, 95]
    kept = pii.redact_pii(docs([(1, text), (3, None)]).select("*", F.lit("kept").alias("__PII"))).collect()
    assert kept[0].text == re.sub(r"a\d+@b\d\.org", "[EMAIL]", text) and kept[0]["__PII"] == "kept" and kept[1].text is None
    assert time.perf_counter() - begun < 120


def test_pii_context_is_of_whole_words(docs):
    rng = random.Random(8)
    words = ["mail", "email", "hotel", "tel", "trip", "ip", "ship", "a@b.co", "c.d@e.fr", "10.0.0.1", "+1 988 555 2485", "é", "vvvvvvvvvvvvvvvvvv", "host."]
    rows = [(i, rng.choice(["", " "]).join(rng.choices(words, k=12)) if i % 5 else " ".join(rng.choices(words, k=40))) for i in range(300)]
    for r in pii.find_pii(docs(rows)).collect():
        for s in r.pii:
            around = r.text[max(0, s.start - 40) : s.start] + " " + r.text[s.end : s.end + 40]
            rule = pii.RULES[s.kind]
            assert s.confidence == rule.base + 15 * bool(re.search(rule.words, around.lower())), (r.text, s)


def test_language_mixture(spark, small, docs):
    table = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.train(table.filter(~langid.held_out()))
    scored = langid.predict(table.filter(langid.held_out()), model)
    assert scored.filter("lang = lang_pred").count() / scored.count() > 0.95
    by_lang = {r.lang: r.text for r in table.filter("length(text) > 2000").dropDuplicates(["lang"]).collect()}
    mixed = by_lang["en"][:1500] + " " + by_lang["de"][:900]
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, mixed), (5, "x" * 200_000)]
    got = {r.doc_id: r for r in langid.predict(docs(rows), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert got[4].n_langs == 2 and 0.5 < got[4].score < 0.75
    assert all(0 <= r.score <= 1 for r in got.values())
    clash = docs([(1, "the", "a", 5)], "doc_id long, text string, lang_pred string, score int")
    assert langid.predict(clash, model).columns == ["doc_id", "text", "lang_pred", "score", "n_langs"]
    assert langid.predict(docs([]), model).count() == 0
    assert langid.predict(docs([(1, "abc")]), langid.train(table.limit(0))).first().lang_pred == "und"


def test_token_counts_are_the_library_s(spark, small, docs):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", None, " ", "  a", "a ", "a  b\tc\nd ", "▁x ▁", "<s> </s><unk>", "ﬁ ① 漢字　x", "x" * 20_000, "a b " * 9000]
    texts += [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: r for r in tokencount.token_counts(docs(list(enumerate(texts))), path).collect()}
    for i, text in enumerate(texts):
        want = len(model.encode(text or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len((text or "").encode()), want > 4096)
        if want > 4096:
            assert len(model.encode(text[: got[i].fit_chars])) <= 4096 < len(model.encode(text[: got[i].fit_chars + 1]))
    own = tokencount.PrefixCounter(path)
    for text in ("a  document about\n tokens ", "▁ x", "Überraschung"):
        assert own.every_prefix(text) == [len(model.encode(text[:i])) for i in range(len(text) + 1)]


def test_token_cache_is_bounded(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokencount, "CACHE_SEGMENTS", 5)
    own = tokencount.PrefixCounter(public_tokenizers.path("piece_bpe_32k.model"))
    text = " ".join(f"word{i}" for i in range(40))
    assert own.count(text) == len(own.model.encode(text)) and own.count(text) == own.table(text)[1][-1]


def plain_score(item, passage):
    """Smith-Waterman by its definition."""
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if a == b else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best / (2 * len(item))


def plain_tokens(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def test_decontamination_against_alignment_of_everything(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").filter("length(text) < 1500")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    want = set()
    for d in docs.collect():
        passage = plain_tokens(d.text)
        for b in items.collect():
            item = plain_tokens(b.text)
            if len(set(item) & set(passage)) >= 0.4 * len(set(item)) and plain_score(item, passage) >= decontam.MIN_SCORE:
                want.add((d.doc_id, b.item_id))
    assert {(r.doc_id, r.item_id) for r in decontam.benchmark_matches(docs, items).collect()} == want and want


def test_decontamination_of_edited_copies(docs):
    rng = random.Random(4)
    item = rng.choices(WORDS, k=40)
    edited = list(item)
    edited[10], edited[11] = "new", "words"
    del edited[25]
    noise = rng.choices([f"n{i}" for i in range(500)], k=200)
    rows = [
        (1, " ".join([*noise, *edited, *noise])), (2, " ".join(noise)), (3, None), (4, ""), (5, ", ".join(item).upper()), (5, ", ".join(item)),
        (6, " ".join([*noise[:50], *item[:8], *noise[:90]])),
    ]
    bench = docs([(9, " ".join(item)), (8, None), (7, ""), (6, "xx yy"), (None, "n1 n2")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.benchmark_matches(docs(rows), bench).collect())
    assert got == [(1, 9), (5, 9), (5, 9)]
    clean = decontam.without_matches(docs([(i, t, i) for i, t in rows], "doc_id long, text string, score int"), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 6] and clean.columns == ["doc_id", "text", "score"]
    assert decontam.benchmark_matches(docs([]), bench).count() == 0
    assert decontam.benchmark_matches(docs(rows), docs([], "item_id long, text string")).count() == 0


def test_benchmark_blocks_cover_every_item(docs, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 100)
    items = [(i, " ".join(random.Random(i).choices(WORDS, k=20))) for i in range(12)]
    got = decontam.benchmark_matches(docs(items), docs(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(i, i) for i in range(12)}


def test_luhn_and_mod97(spark):
    row = spark.createDataFrame([("4111111111111111", "GB82WEST12345698765432")], "c string, i string").select(
        pii.luhn(F.col("c")).alias("c"), pii.mod97(F.col("i")).alias("i")
    ).first()
    assert row.c and row.i


def plain_mixture(text, likelihood):
    """Expectation maximisation over every n-gram one by one, then the set of the best penalised likelihood."""
    counts = {}
    folded = re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode() + b" ")
    for k, n in enumerate(langid.NGRAMS):
        for i in range(len(folded) - n + 1):
            code = 0
            for byte in folded[i : i + n]:
                code = (code * 257 + byte) % (1 << 32)
            feature = (code * 2654435761 % (1 << 32) >> (32 - langid.FEATURE_BITS)) + (k << langid.FEATURE_BITS)
            counts[feature] = counts.get(feature, 0) + 1
    features, count = np.array(list(counts)), np.array(list(counts.values()), float)
    like = likelihood[features].astype(float)

    def fitted(langs, start):
        share = start / start.sum()
        for _ in range(langid.STEPS):
            weighted = share * like[:, langs]
            share = (weighted / weighted.sum(axis=1, keepdims=True) * count[:, None]).sum(axis=0) / count.sum()
        return share, (count * np.log((share * like[:, langs]).sum(axis=1))).sum()

    alone = (count[:, None] * np.log(like)).sum(axis=0)
    rough = np.sort(np.argsort(-alone, kind="stable")[: langid.ROUGH])
    share, _ = fitted(rough, np.ones(len(rough)))
    best, score = {int(alone.argmax()): 1.0}, alone.max()
    for k in range(2, langid.LARGEST_SET + 1):
        chosen = np.argsort(-share, kind="stable")[:k]
        found, fit = fitted(rough[chosen], np.maximum(share[chosen], 1e-6))
        if fit - (k - 1) * langid.PENALTY * np.log(count.sum()) > score:
            best, score = dict(zip(rough[chosen].tolist(), found.tolist(), strict=True)), fit - (k - 1) * langid.PENALTY * np.log(count.sum())
    return best


@pytest.mark.parametrize("n_langs", [4, 40])
def test_language_mixtures_against_a_plain_estimate(small, n_langs):
    import duckdb

    rows = duckdb.sql(f"SELECT text, lang FROM '{small}/documents.parquet' WHERE lang IS NOT NULL AND length(text) BETWEEN 200 AND 3000").fetchall()
    batch = pa.record_batch({"text": [t for t, _ in rows], "lang": [x for _, x in rows]})
    names, tables = sorted({x for _, x in rows}), {}
    for part in langid._counted(iter([batch])):
        for name, at, counts in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            tables.setdefault(name, np.zeros((langid.SLICES, langid.FEATURES // langid.SLICES)))[at] += np.frombuffer(counts, np.int64)
    table = np.stack([tables[n].reshape(len(langid.NGRAMS), -1) for n in names]) + langid.SMOOTHING
    own = (table / table.sum(axis=2, keepdims=True)).reshape(len(names), -1).T
    mixed = [own * np.random.default_rng(i).uniform(0.3, 1, own.shape) for i in range(n_langs // 4 - 1)]
    likelihood = np.concatenate([own, *mixed], axis=1).astype(np.float32)
    texts = [t for t, _ in rows[:25]] + [rows[i][0] + " " + rows[-1 - i][0] for i in range(10)]
    got = langid.mixtures(texts, likelihood)
    for text, shares in zip(texts, got, strict=True):
        want = plain_mixture(text, likelihood)
        assert {i for i, s in enumerate(shares) if s > 0} == set(want)
        assert all(abs(shares[i] - s) < 1e-3 for i, s in want.items())


def test_language_of_long_texts_in_pieces(monkeypatch):
    text = "Où est-ce que l'été, ΣΑΣ? " * 400 + "the end"
    whole = np.zeros(langid.FEATURES, np.int64)
    features, count, _ = langid._counts([text])
    whole[features] = count
    monkeypatch.setattr(langid, "PIECE", 37)
    assert np.array_equal(whole, langid._long_counts(text))


def test_language_memory_does_not_follow_languages_and_length():
    """Peak of a fresh process: 1 MB of text in 200 languages, then one text of 50 MB."""
    import subprocess
    import sys

    code = """
import resource, numpy as np
from tallyloom.llm import langid
from tallyloom.llm.words import chunks
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
words = np.random.default_rng(1).choice([f"{a}{b}{c}" for a in "abcde" for b in "aeiou" for c in "xyzst"], 260_000)
texts = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
likelihood = np.random.default_rng(2).uniform(1e-6, 1e-3, (langid.FEATURES, 200)).astype(np.float32)
before = peak()
for lo, hi in chunks(texts, langid.PIECE):
    langid.mixtures(texts[lo:hi], likelihood)
langs = peak() - before
langid.mixtures([" ".join(texts) * 50], likelihood)
print(langs, peak() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=str(langid.__file__).rsplit("/tallyloom/", 1)[0])
    langs, long = map(float, out.stdout.split())
    assert langs < 150 and long < 250
