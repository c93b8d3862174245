"""Languages of a document as a mixture, by expectation maximisation over n-gram likelihoods.

Training counts hashed byte n-grams of lower-cased letters per language over all labelled rows, inside the tasks; only
the summed tables reach the driver (languages x FEATURES numbers, whatever the corpus). A document's language
proportions are then estimated by expectation maximisation, the set of languages is the one of the best penalised
likelihood among the largest one, two or three proportions, and the prediction is the largest share in that set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import chunks

NGRAMS = (2, 4)
FEATURE_BITS = 15
FEATURES = len(NGRAMS) << FEATURE_BITS
PIECE = 1 << 18  # characters worked on at a time; a longer text is counted in pieces
SLICES = 64
SMOOTHING = 0.05
STEPS = 6
PENALTY = 4.0  # times log(n-grams), for each language beyond the first
LARGEST_SET = 3
ROUGH = 8  # languages that enter the estimate, by their own likelihood
UNDETERMINED = "und"

_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _codes(folded: np.ndarray, n: int) -> np.ndarray:
    code = np.zeros(max(0, len(folded) - n + 1), np.uint32)
    for i in range(n):
        code = code * np.uint32(257) + folded[i : i + len(code)]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)


def _long_counts(text: str) -> np.ndarray:
    """How often each feature occurs in one text, counted piece by piece; pieces end at spaces, where there are some."""
    counts, tail, start = np.zeros(FEATURES, np.int64), np.array([], np.uint32), 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            end = max(text.rfind(" ", start + 1, end), 0) or end
        raw = text[start:end].lower().encode("utf-8", "replace")
        start = end
        folded = _FOLD[np.frombuffer(raw + b" " * (end >= len(text)), np.uint8)]
        last = tail[-1] if len(tail) else 0
        folded = folded[(folded != 32) | (np.concatenate(([last], folded[:-1])) != 32)]
        for k, n in enumerate(NGRAMS):
            lead = tail[max(0, len(tail) - n + 1) :]
            counts[k << FEATURE_BITS : (k + 1) << FEATURE_BITS] += np.bincount(_codes(np.concatenate((lead, folded)), n), minlength=1 << FEATURE_BITS)
        tail = np.concatenate((tail, folded))[1 - max(NGRAMS) :]
    return counts


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, how often each occurs, and the text it belongs to, text by text. Runs of
    anything but letters count as one space."""
    if len(texts) == 1 and len(texts[0]) > PIECE:
        counts = _long_counts(texts[0])
        features = np.flatnonzero(counts)
        return features, counts[features], np.zeros(len(features), np.int64)
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    folded = _FOLD[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    owner = np.repeat(np.arange(len(raw), dtype=np.uint32), [len(r) + 1 for r in raw])
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    folded, owner = folded[keep], owner[keep]
    keys = []
    for k, n in enumerate(NGRAMS):
        code = _codes(folded, n)
        same = owner[: len(code)] == owner[n - 1 : n - 1 + len(code)]
        keys.append(owner[: len(code)][same].astype(np.int64) * FEATURES + code[same] + (k << FEATURE_BITS))
    keys = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[first] % FEATURES, np.diff(np.append(first, len(keys))), keys[first] // FEATURES


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in chunks(texts, PIECE):
            features, count, owner = _counts(texts[lo:hi])
            own = np.array(langs[lo:hi], object)[owner]
            for name in set(langs[lo:hi]):
                table = tables.setdefault(name, np.zeros(FEATURES, np.int64))
                np.add.at(table, features[own == name], count[own == name])
    width = FEATURES // SLICES
    rows = [(n, i, t[i * width : (i + 1) * width].astype(np.int64).tobytes()) for n, t in tables.items() for i in range(SLICES)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["lang", "slice", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"lang": table.column("lang")[:1], "slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()])})


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names and the likelihood of every feature in each. Rows without a text or a language teach nothing."""
    source = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counted = source.mapInArrow(_counted, "lang string, slice long, counts binary")
    rows = counted.groupBy("lang", "slice").applyInArrow(_summed, "lang string, slice long, counts binary").collect()
    names = sorted({r.lang for r in rows})
    tables = np.zeros((len(names), SLICES, FEATURES // SLICES))
    for r in rows:
        tables[names.index(r.lang), r.slice] = np.frombuffer(r.counts, np.int64)
    tables = tables.reshape(len(names), len(NGRAMS), 1 << FEATURE_BITS) + SMOOTHING
    return names, (tables / tables.sum(axis=2, keepdims=True)).reshape(len(names), FEATURES).T.astype(np.float32)


def _estimate(like: np.ndarray, count: np.ndarray, starts: np.ndarray, owner: np.ndarray, total: np.ndarray, share: np.ndarray, steps: int):
    """Expectation maximisation for all documents at once; a share of zero stays zero. Returns shares and likelihoods."""
    for _ in range(steps):
        weighted = share[owner] * like
        weighted *= (count / weighted.sum(axis=1))[:, None]
        share = np.add.reduceat(weighted, starts) / total[:, None]
    mixed = np.einsum("ij,ij->i", share[owner], like)
    return share, np.add.reduceat(count * np.log(mixed), starts)


def mixtures(texts: list[str], likelihood: np.ndarray) -> np.ndarray:
    """Language shares of each text, zero outside the selected set. Every text must have a letter.

    Each text goes on with the ``ROUGH`` languages that explain it best alone, found over a few languages at a time, so the
    memory does not follow the number of languages.
    """
    features, count, owner = _counts(texts)
    count = count.astype(np.float32)
    starts = np.searchsorted(owner, np.arange(len(texts)))
    total = np.add.reduceat(count, starts)
    n_langs = likelihood.shape[1]
    if n_langs <= ROUGH:
        return _selected(likelihood[features], count, starts, owner, total)
    rough = np.concatenate(
        [np.add.reduceat(count[:, None] * np.log(likelihood[features, k : k + ROUGH]), starts) for k in range(0, n_langs, ROUGH)], axis=1
    )
    langs = np.sort(np.argsort(-rough, axis=1, kind="stable")[:, :ROUGH], axis=1)
    best = np.zeros((len(texts), n_langs), np.float32)
    np.put_along_axis(best, langs, _selected(likelihood[features[:, None], langs[owner]], count, starts, owner, total), axis=1)
    return best


def _selected(like: np.ndarray, count: np.ndarray, starts: np.ndarray, owner: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Shares of the languages of the columns of ``like`` in each text, zero outside the selected set."""
    like /= like.max(axis=1, keepdims=True)
    alone = np.add.reduceat(count[:, None] * np.log(like), starts)
    n_langs = like.shape[1]
    share = np.full(alone.shape, 1.0 / n_langs, np.float32)
    share, joint = _estimate(like, count, starts, owner, total, share, STEPS)
    best = np.zeros_like(share)
    best[np.arange(len(alone)), alone.argmax(axis=1)] = 1.0
    score = alone.max(axis=1)
    penalty = PENALTY * np.log(total)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    open_docs = np.flatnonzero(joint - penalty > score)
    if len(open_docs):
        inside = np.isin(owner, open_docs)
        sub_owner = np.searchsorted(open_docs, owner[inside])
        sub_starts = np.searchsorted(sub_owner, np.arange(len(open_docs)))
        for k in range(2, min(LARGEST_SET, n_langs) + 1):
            start = np.where(rank[open_docs] < k, np.maximum(share[open_docs], 1e-6), 0)
            start /= start.sum(axis=1, keepdims=True)
            found, fit = _estimate(like[inside], count[inside], sub_starts, sub_owner, total[open_docs], start, STEPS)
            fit = fit - (k - 1) * penalty[open_docs]
            better = fit > score[open_docs]
            best[open_docs[better]] = found[better]
            score[open_docs[better]] = fit[better]
    return best


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` (``und`` for null texts, texts without a letter, or an empty model), ``score`` (the share of
    that language, 0 to 1) and ``n_langs`` (size of the selected set) to ``docs``; columns of those names are replaced."""
    names, likelihood = model
    added = ["lang_pred", "score", "n_langs"]
    kept = docs.drop(*added)
    place = kept.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(likelihood)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            lang, score, size = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int32)
            sure = [i for i, t in enumerate(texts) if names and has_letter(t)]
            known = [texts[i] for i in sure]
            for lo, hi in chunks(known, PIECE):
                found = mixtures(known[lo:hi], shared.value)
                for i, row in zip(sure[lo:hi], found, strict=True):
                    lang[i], score[i], size[i] = names[int(row.argmax())], min(1.0, float(row.max())), int((row > 0).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang), pa.array(score), pa.array(size)], [*batch.schema.names, *added]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double, n_langs int")


def held_out(id_col: str = "doc_id"):
    """The documents no model learns from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
