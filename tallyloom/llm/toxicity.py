"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is folded to lower-case words, a word to its character n-grams, an n-gram to one of ``1 << BITS`` vectors. The vectors of
a window of ``WINDOW`` words are averaged, and a linear softmax over the average says how likely the window is toxic. Vectors and
softmax are learned together, in numpy, so a misspelling that was never seen is scored by the n-grams it shares with words that
were. Only documents are labelled: after a first round over all windows, a toxic document teaches by its worst windows alone.
A document's score is a logistic function of its worst window and its number of windows, fitted on labelled documents that the
embedding did not learn from.

The model is fitted on a bounded sample: the ``SAMPLE_DOCS`` labelled documents of at most ``SAMPLE_TEXT_BYTES`` bytes that come
first by a hash of their id; vectors are learned from their windows, until there are ``SAMPLE_WINDOWS``. Every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import chunks

BITS = 16
NGRAMS = (3, 4, 5)
WINDOW = 16
LONGEST_WORD = 64  # bytes; a longer run of letters counts as several words
DIMENSIONS = 8
ROUNDS = 6
RATE = 0.2
BATCH = 256
SAMPLE_DOCS = 4_000
MARGIN = 2  # labelled documents looked at for each one of the sample; some are too long or missing
SAMPLE_TEXT_BYTES = 32_768
SAMPLE_WINDOWS = 120_000
CALIBRATION_SHARE = 0.25
RIDGE = 1.0
PIECE_BYTES = 1 << 18

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per n-gram: its vector against the difference of the two softmax rows
    bias: float
    scale: tuple[float, float, float]  # of the worst window, of the log number of windows, constant
    prior: float  # of a text without a word


def _single_spaced(folded: np.ndarray) -> np.ndarray:
    """Folded bytes with single spaces between words, one before the first, and breaks inside overlong words."""
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    out = folded[keep]
    spaces = np.flatnonzero(out == 32)
    runs = np.diff(np.append(spaces, len(out))) - 1
    if len(runs) and runs.max() > LONGEST_WORD:
        cuts = [s + 1 + np.arange(LONGEST_WORD, n, LONGEST_WORD) for s, n in zip(spaces, runs, strict=True) if n > LONGEST_WORD]
        out = np.insert(out, np.concatenate(cuts), 32)
    return out


def _grams(spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams inside words (the spaces around a word included), and the number of the word each belongs to."""
    before = np.concatenate(([0], np.cumsum(spaced == 32)))  # spaces before each place
    found, words = [], []
    for n in NGRAMS:
        size = len(spaced) - n + 1
        if size <= 0:
            continue
        code = np.full(size, n, np.uint32)
        for i in range(n):
            code = (code ^ spaced[i : i + size]) * np.uint32(16777619)
            code ^= code >> np.uint32(15)
        whole = before[n - 1 : n - 1 + size] == before[1 : 1 + size]
        found.append((code[whole] >> np.uint32(32 - BITS)).astype(np.int64))
        words.append(before[1 : 1 + size][whole] - 1)
    return (np.concatenate(found), np.concatenate(words)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def _pieces(text: bytes) -> Iterator[np.ndarray]:
    """A text as single-spaced pieces of whole windows, so memory does not follow the length of a text."""
    rest = np.array([32], np.uint8)
    for start in range(0, len(text), PIECE_BYTES):
        spaced = _single_spaced(np.concatenate((rest, _FOLD[np.frombuffer(text, np.uint8, min(PIECE_BYTES, len(text) - start), start)])))
        if start + PIECE_BYTES >= len(text):
            rest = spaced
            break
        spaces = np.flatnonzero(spaced == 32)
        cut = spaces[(len(spaces) - 1) // WINDOW * WINDOW]  # the words before it are complete windows
        if cut:
            yield spaced[: cut + 1]
        rest = spaced[cut:]
    if rest[-1] != 32:
        rest = np.append(rest, np.uint8(32))
    if len(rest) > 1:
        yield rest


def window_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, the window of each, and the text of each window. A window has at least one n-gram."""
    found, windows, owners, base = [], [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            grams, word = _grams(piece)
            if len(grams):
                used, window = np.unique(word // WINDOW, return_inverse=True)
                found.append(grams)
                windows.append(window + base)
                owners.append(np.full(len(used), i))
                base += len(used)
    if not found:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(found), np.concatenate(windows), np.concatenate(owners)


def _logits(weights: np.ndarray, bias: float, grams: np.ndarray, windows: np.ndarray) -> np.ndarray:
    sizes = np.bincount(windows)
    return np.bincount(windows, weights[grams]) / sizes + bias


def worst_windows(texts: list[bytes], weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """The highest logit of a window of each text (-inf without one), and its number of windows."""
    worst, sizes = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
    for lo, hi in chunks(texts, 4 * PIECE_BYTES):
        if len(texts[lo]) > 4 * PIECE_BYTES:  # a chunk of its own: piece by piece
            for piece in _pieces(texts[lo]):
                grams, word = _grams(piece)
                if len(grams):
                    _, window = np.unique(word // WINDOW, return_inverse=True)
                    z = _logits(weights, bias, grams, window)
                    worst[lo], sizes[lo] = max(worst[lo], z.max()), sizes[lo] + len(z)
            continue
        grams, windows, owners = window_grams(texts[lo:hi])
        if len(grams):
            np.maximum.at(worst[lo:hi], owners, _logits(weights, bias, grams, windows))
            sizes[lo:hi] += np.bincount(owners, minlength=hi - lo)
    return worst, sizes


def _learned_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams window by window with their share of the window, where each window starts, and its text."""
    columns, shares, sizes, owners, taken = [], [], [], [], 0
    for i, text in enumerate(texts):
        grams, windows, _ = window_grams([text])
        if not len(grams):
            continue
        keys, count = np.unique((windows << BITS) + grams, return_counts=True)
        first = np.flatnonzero(np.diff(keys >> BITS, prepend=-1))
        size = np.diff(np.append(first, len(keys)))
        columns.append((keys & ((1 << BITS) - 1)).astype(np.int32))
        shares.append((count / np.repeat(np.add.reduceat(count, first), size)).astype(np.float32))
        sizes.append(size)
        owners.append(np.full(len(size), i))
        taken += len(size)
        if taken >= SAMPLE_WINDOWS:
            break
    return np.concatenate(columns), np.concatenate(shares), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), np.concatenate(owners)


def _embed(texts: list[bytes], toxic: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Vectors and softmax by stochastic gradients with per-weight step sizes; returns the weight of each n-gram and the bias."""
    column, share, start, owners = _learned_windows(texts)
    label = toxic[owners].astype(np.int64)
    wanted = np.eye(2, dtype=np.float32)[label]
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = [np.full_like(x, 1e-6) for x in (vectors, softmax, bias)]
    live = np.arange(len(label))
    for k in range(ROUNDS):
        if k:
            z = np.add.reduceat((vectors @ (softmax[:, 1] - softmax[:, 0]))[column] * share, start[:-1]) + bias[1] - bias[0]
            worst = np.full(len(texts), -np.inf)
            np.maximum.at(worst, owners, z)
            live = np.flatnonzero((label == 0) | (z >= worst[owners]) | (z > 0))
        order = rng.permutation(live)
        for at in range(0, len(order), BATCH):
            batch = np.sort(order[at : at + BATCH])
            sizes = start[batch + 1] - start[batch]
            first = np.cumsum(sizes) - sizes
            place = np.repeat(start[batch] - first, sizes) + np.arange(sizes.sum())
            used, part = column[place], share[place]
            mean = np.add.reduceat(vectors[used] * part[:, None], first)
            out = mean @ softmax + bias
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = out / out.sum(axis=1, keepdims=True) - wanted[batch]
            back = error @ softmax.T
            distinct, where = np.unique(used, return_inverse=True)
            step = np.stack([np.bincount(where, part * np.repeat(back[:, d], sizes), len(distinct)) for d in range(DIMENSIONS)], axis=1)
            seen[0][distinct] += step * step
            vectors[distinct] -= RATE * step / np.sqrt(seen[0][distinct])
            for own, gradient, past in ((softmax, mean.T @ error / len(batch), seen[1]), (bias, error.mean(axis=0), seen[2])):
                past += gradient * gradient
                own -= RATE * gradient / np.sqrt(past)
    return (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def _inputs(worst: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.stack([worst, np.log(np.maximum(sizes, 1)), np.ones(len(worst))], axis=1)


def _calibrated(worst: np.ndarray, sizes: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on the worst window and the log number of windows: Newton's method, halving steps
    that do not lower the penalised loss."""
    x, start = _inputs(worst, sizes), np.array([1.0, 0.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - toxic * z).sum() + 0.5 * RIDGE * ((w - start) ** 2).sum())

    w = start
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + RIDGE * np.eye(3)
        step = np.linalg.solve(curve, x.T @ (p - toxic) + RIDGE * (w - start))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def fit(texts: list[bytes], toxic: np.ndarray, seed: int = 0) -> Model:
    """The model of labelled texts, the first ``CALIBRATION_SHARE`` of which set the scale. Without texts or with one class
    alone, every text has that class's share."""
    prior = float(toxic.mean()) if len(toxic) else 0.0
    kept = int(len(texts) * CALIBRATION_SHARE)
    learn, held = (texts[kept:], toxic[kept:]), (texts[:kept], toxic[:kept])
    if not 0 < toxic.sum() < len(toxic) or not 0 < learn[1].sum() < len(learn[1]):
        return Model(np.zeros(1 << BITS), 0.0, (0.0, 0.0, 30.0 if prior == 1 else -30.0 if prior == 0 else float(np.log(prior / (1 - prior)))), prior)
    weights, bias = _embed(*learn, seed)
    worst, sizes = worst_windows(held[0], weights, bias)
    used = sizes > 0
    scale = _calibrated(worst[used], sizes[used], held[1][used].astype(float)) if 0 < held[1][used].sum() < used.sum() else (1.0, 0.0, 0.0)
    return Model(weights, bias, scale, prior)


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    """0 to 1; a text without a word has the sample's share of toxic documents."""
    worst, sizes = worst_windows(texts, model.weights, model.bias)
    z = _inputs(np.where(sizes > 0, worst, 0.0), sizes) @ np.array(model.scale)
    return np.where(sizes > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), model.prior)


def held_out(id_col: str = "doc_id") -> Column:
    """The documents whose labels no model learns from; never null, a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[bytes], np.ndarray]:
    """The bounded training sample. A document with several labels is toxic if one says so; null labels, ids and texts, and
    the documents of ``held_out``, teach nothing."""
    own = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).filter("id IS NOT NULL AND toxic IS NOT NULL")
    named = own.filter(~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("rank", F.xxhash64("id"))
    share = min(1.0, MARGIN * SAMPLE_DOCS / max(1, named.count()))  # by hash: what is left is small wherever it is sorted
    low = named.filter(F.pmod("rank", F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= SAMPLE_TEXT_BYTES)
    rows = texts.join(low, "id").orderBy("rank", "id", "text").limit(SAMPLE_DOCS).collect()
    return [r.text.encode("utf-8", "replace") for r in rows], np.array([r.toxic > 0 for r in rows], np.int64)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to ``docs``; columns of those names are replaced.

    Null and empty texts and texts without a letter or digit have the sample's share of toxic documents. Repeated rows get equal
    scores, an empty table stays empty.
    """
    kept = docs.drop("score", "predicted")
    place = kept.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()]
            found = score_texts(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"]
            )

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, score double, predicted int")
