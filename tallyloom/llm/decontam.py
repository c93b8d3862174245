"""Benchmark passages in training texts: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark is the stated query set. It is taken in blocks of bounded bytes, each block sent to the tasks, which read
the corpus unshuffled; nothing about documents is gathered. A first scan counts in how many documents each benchmark
n-gram occurs. An n-gram is a seed if few documents have it, or if it is among the rarer half of its item: an item that
leaked into very many documents keeps its seeds. Around seed hits, item and passage are aligned word by word, so edits,
insertions and lost words cost points and don't hide the copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import U64, chunks, grams, words

SEED_WORDS = 4
RARE_SHARE = 0.001
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5  # of the points of a whole, unchanged item
MIN_WORDS = 8  # aligned words that are equal
BLOCK_BYTES = 4 << 20

Item = tuple[int, np.ndarray]


def _plain_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes, bounds, _, _ = words(texts, punctuation=False)
    return hashes, bounds


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[Item]]:
    """The items as word hashes, in blocks of about ``BLOCK_BYTES``. Items without an id or without words match nothing."""
    source = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for k in range(blocks):
        rows = source.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).distinct().orderBy("item", "text").collect()
        hashes, bounds = _plain_words([r.text.encode() for r in rows])
        items = [(r.item, hashes[bounds[i] : bounds[i + 1]]) for i, r in enumerate(rows)]
        yield [x for x in items if len(x[1])]


def _gram_size(item: np.ndarray) -> int:
    return min(SEED_WORDS, len(item))


def _gram_table(items: list[Item]) -> dict[int, np.ndarray]:
    """Distinct n-grams of the items, sorted, by their length (items shorter than a seed are one n-gram each)."""
    found: dict[int, list[np.ndarray]] = {}
    for _, item in items:
        found.setdefault(_gram_size(item), []).append(grams(item, _gram_size(item)))
    return {n: np.unique(np.concatenate(parts)) for n, parts in found.items()}


def _hits(hashes: np.ndarray, table: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``hashes`` whose n-gram is in ``table``, and its place there."""
    own = grams(hashes, n)
    if not len(own) or not len(table):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(table, own), len(table) - 1)
    where = np.flatnonzero(table[at] == own)
    return where, at[where]


def frequencies(docs: DataFrame, text_col: str, table: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """In how many documents each n-gram of ``table`` occurs; one row per n-gram and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {n: np.zeros(len(t), np.int64) for n, t in table.items()}
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            for lo, hi in chunks(texts):
                hashes, bounds = _plain_words(texts[lo:hi])
                for n, own in table.items():
                    where, at = _hits(hashes, own, n)
                    doc = np.searchsorted(bounds, where, side="right")
                    inside = where + n <= bounds[np.minimum(doc, len(bounds) - 1)]
                    pairs = np.unique(doc[inside] * len(own) + at[inside])
                    counts[n] += np.bincount(pairs % len(own), minlength=len(own))
        for n, c in counts.items():
            (i,) = np.nonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), n)), pa.array(i), pa.array(c[i])], ["n", "place", "df"])

    out = {n: np.zeros(len(t), np.int64) for n, t in table.items()}
    rows = docs.select(text_col).mapInArrow(run, "n long, place long, df long").groupBy("n", "place").agg(F.sum("df").alias("df"))
    for r in rows.toLocalIterator():
        out[r.n][r.place] = r.df
    return out


def _seeds(items: list[Item], table: dict[int, np.ndarray], df: dict[int, np.ndarray], n_docs: int):
    """Per n-gram length: the sorted seeds and, for each, the (item, offset) pairs that have it."""
    common = max(2, int(RARE_SHARE * n_docs))
    found: dict[int, dict[int, list[tuple[int, int]]]] = {}
    for k, (_, item) in enumerate(items):
        n = _gram_size(item)
        own = grams(item, n)
        freq = df[n][np.searchsorted(table[n], own)]
        bound = max(common, int(np.median(freq)))
        for offset in np.flatnonzero(freq <= bound):
            found.setdefault(n, {}).setdefault(int(own[offset]), []).append((k, int(offset)))
    return {n: (np.array(sorted(f), U64), [f[x] for x in sorted(f)]) for n, f in found.items()}


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int, int]:
    """Best local alignment: share of the item's full points, first and past-the-last passage word, equal words."""
    width = len(passage)
    ramp = GAP * np.arange(width)
    rows = np.zeros((len(item) + 1, width + 1), np.int32)
    for i, word in enumerate(item):
        step = np.where(passage == word, MATCH, MISMATCH)
        open_ = np.maximum(np.maximum(rows[i, :-1] + step, rows[i, 1:] + GAP), 0)
        rows[i + 1, 1:] = np.maximum.accumulate(open_ - ramp) + ramp
    i, j = np.unravel_index(int(rows.argmax()), rows.shape)
    score, last, equal = rows[i, j] / (MATCH * len(item)), int(j), 0
    while i > 0 and j > 0 and rows[i, j] > 0:
        same = passage[j - 1] == item[i - 1]
        if rows[i, j] == rows[i - 1, j - 1] + (MATCH if same else MISMATCH):
            equal += int(same)
            i, j = i - 1, j - 1
        elif rows[i, j] == rows[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return float(score), int(j), last, equal


def _matches(hashes: np.ndarray, hits: list[tuple[int, int, int]], items: list[Item]) -> list[tuple]:
    """Matches of one document; ``hits`` are (item, offset in the item, position in the document)."""
    spans: dict[int, list[list[int]]] = {}
    for k, offset, at in sorted(hits, key=lambda h: (h[0], h[2] - h[1])):
        size = len(items[k][1])
        pad = size // 4 + 4
        lo, hi = max(0, at - offset - pad), min(len(hashes), at - offset + size + pad)
        own = spans.setdefault(k, [])
        if own and lo <= own[-1][1]:
            own[-1][1] = max(own[-1][1], hi)
        else:
            own.append([lo, hi])
    out: dict[int, tuple] = {}
    for k, windows in spans.items():
        item_id, item = items[k]
        for lo, hi in windows:
            score, first, last, equal = align(item, hashes[lo:hi])
            if score >= MIN_SCORE and equal >= min(MIN_WORDS, len(item)) and (item_id not in out or score > out[item_id][1]):
                out[item_id] = (item_id, score, lo + first, lo + last)
    return [out[k] for k in sorted(out)]


def _search(texts: list[bytes], seeds, items: list[Item]) -> list[list[tuple]]:
    found: list[list[tuple]] = [[] for _ in texts]
    for lo, hi in chunks(texts):
        hashes, bounds = _plain_words(texts[lo:hi])
        per_doc: dict[int, list[tuple[int, int, int]]] = {}
        for n, (table, owners) in seeds.items():
            where, at = _hits(hashes, table, n)
            docs = np.searchsorted(bounds, where, side="right") - 1
            for doc, place, seed in zip(docs.tolist(), where.tolist(), at.tolist(), strict=True):
                if place + n <= bounds[doc + 1]:
                    per_doc.setdefault(doc, []).extend((k, o, place - int(bounds[doc])) for k, o in owners[seed])
        for doc, hits in per_doc.items():
            found[lo + doc] = _matches(hashes[bounds[doc] : bounds[doc + 1]], hits, items)
    return found


def _prepared(docs: DataFrame, text_col: str, benchmark: DataFrame, item_col: str, item_text_col: str):
    n_docs = docs.count()
    for items in item_blocks(benchmark, item_col, item_text_col):
        table = _gram_table(items)
        seeds = _seeds(items, table, frequencies(docs, text_col, table), n_docs)
        yield docs.sparkSession.sparkContext.broadcast((seeds, items))


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): one row per document and item that it holds a copy of.

    ``score`` is the alignment's share of the points of a whole, unchanged item. Null, blank and clean texts give no
    rows; rows that share an id are searched each for itself; an empty table on either side gives no rows.
    """
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _prepared(source, "text", benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds, items = shared.value
            names = ["doc_id", "item_id", "score", "first_word", "last_word"]
            for batch in batches:
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                rows = [(d, *m) for d, ms in zip(batch.column(0).to_pylist(), _search(texts, seeds, items), strict=True) for m in ms]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        out = out.unionByName(source.mapInArrow(run, schema))
    return out


def without_matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no copy of any benchmark item, with all their columns. Null texts stay."""
    place = docs.columns.index(text_col)
    out = docs
    for shared in _prepared(docs, text_col, benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds, items = shared.value
            for batch in batches:
                texts = [t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()]
                yield batch.filter(pa.array([not m for m in _search(texts, seeds, items)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
