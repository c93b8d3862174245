"""Ranked lexical search: the best documents of every item by summed integer term impacts, exact, without scoring every document.

The items are the stated query set. A first pass writes, per document, the terms it shares with the items and their counts; from
that table come the statistics (documents, terms, documents per term). The second pass cuts it into shards of bounded size. In
a shard every term has a posting list with a sparse table for range maxima over its impacts. Documents are searched as
intervals, the interval of the highest bound first: its bound is the sum over the item's terms of the highest impact in it. It is
split at the document of the largest single impact, which is scored; its two sides are bounded anew. Intervals whose bound is
below the item's current last place are left unseen; one that holds few postings is scored whole.

Items are taken in blocks of bounded vocabulary, each block a pass of its own; searching a block costs far more than its pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.words import CHUNK_BYTES, U64, chunks, words
from tallyloom.session import materialize

TOP = 50
BLOCK_TERMS = 1 << 20  # (item, term) pairs of a block of items
SHARD_POSTINGS = 1 << 19
LEAF_POSTINGS = 1 << 10
AT_ONCE = 64  # intervals split in one step
LANES = 64
SCALE = 1_000_000_000

_SEPARATOR = bytes([*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)])
_TO_SPACE = bytes.maketrans(_SEPARATOR, b" " * len(_SEPARATOR))


def _long_text(text: bytes) -> Iterator[np.ndarray]:
    """Term hashes of a text above ``CHUNK_BYTES``, in slices that end between terms. A single term above that size is
    hashed by its digest, so it is as good a term as any other."""
    at = 0
    while at < len(text):
        piece = text[at : at + CHUNK_BYTES]
        if at + len(piece) < len(text):
            cut = piece.translate(_TO_SPACE).rfind(b" ")
            if cut < 0:
                digest, rest = hashlib.blake2b(digest_size=8), at
                while rest < len(text):
                    more = text[rest : rest + CHUNK_BYTES]
                    end = more.translate(_TO_SPACE).find(b" ")
                    digest.update((more if end < 0 else more[:end]).lower())
                    rest += len(more) if end < 0 else end
                    if end >= 0:
                        break
                yield np.array([int.from_bytes(digest.digest(), "little")], U64)
                at = rest
                continue
            piece = piece[: cut + 1]
        yield words([piece], punctuation=False)[0]
        at += len(piece)


def term_counts(texts: list[bytes], vocabulary: np.ndarray | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per text: its place, its number of terms, its distinct terms (places in the sorted ``vocabulary``, other terms left out;
    hashes without one), and how often each occurs."""
    for lo, hi in chunks(texts):
        if hi - lo == 1 and len(texts[lo]) > CHUNK_BYTES:
            parts = list(_counted(_long_text(texts[lo]), vocabulary))
            size = sum(p[0] for p in parts)
            terms, where = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
            yield lo, size, terms, np.bincount(where, np.concatenate([p[2] for p in parts]), len(terms)).astype(np.int64)
            continue
        hashes, bounds, _, _ = words(texts[lo:hi], punctuation=False)
        owner = np.repeat(np.arange(hi - lo), np.diff(bounds))
        terms, owner = _known(hashes, owner, vocabulary)
        order = np.lexsort((terms, owner))
        terms, owner = terms[order], owner[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(terms)))
        at = np.searchsorted(owner[first], np.arange(hi - lo + 1))
        for i in range(hi - lo):
            own = slice(at[i], at[i + 1])
            yield lo + i, int(bounds[i + 1] - bounds[i]), terms[first[own]], count[own]


def _known(hashes: np.ndarray, owner: np.ndarray, vocabulary: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if vocabulary is None:
        return hashes, owner
    if not len(vocabulary):
        return np.empty(0, np.int64), owner[:0]
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    return at[known], owner[known]


def _counted(slices: Iterator[np.ndarray], vocabulary: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for hashes in slices:
        terms, _ = _known(hashes, np.zeros(len(hashes), np.int64), vocabulary)
        yield len(hashes), *np.unique(terms, return_counts=True)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for i, _, terms, _ in term_counts(batch.column(1).cast(pa.binary()).to_pylist(), None):
            yield pa.RecordBatch.from_arrays([pa.array([ids[i]] * len(terms), pa.int64()), pa.array(terms.view(np.int64))], ["item", "term"])


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Posting lists of some documents, each with its impacts' range maxima."""

    def __init__(self, lengths: np.ndarray, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray, documents: int, total: int):
        order = np.argsort(terms, kind="stable")
        self.term, self.doc, tf = terms[order], owner[order], counts[order].astype(np.int64)
        dampened = 50 + (50 * lengths.astype(np.int64) * documents) // total
        self.impact = SCALE * tf // (1000 * tf + 20 * dampened[self.doc])
        self.bits = max(1, int(len(lengths)).bit_length())
        self.key = (self.term.astype(np.int64) << self.bits) + self.doc  # ascending: by term, then by document
        longest = int(np.bincount(self.term).max()) if len(self.term) else 0
        self.tables = [(self.impact << self.bits) + self.doc]  # the maximum also names its document
        for k in range(1, longest.bit_length()):
            low = self.tables[-1]
            high = np.roll(low, -(1 << k - 1))
            self.tables.append(np.maximum(low, high))  # entries over a list's end are never asked for
        self.tables = np.array(self.tables)
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, len(self.tables)):
            self.log[1 << k :] = k
        self.size = len(lengths)

    def peak(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The highest impact in each posting range, with its document in the low bits; 0 of an empty one."""
        width = last - first
        some = width > 0
        at = np.where(some, first, 0)
        level = self.log[np.where(some, width, 1)]
        other = np.where(some, last - (1 << level), 0)
        return np.where(some, np.maximum(self.tables[level, at], self.tables[level, other]), 0)

    def whole(self, ranges: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents with postings in the ranges (terms x intervals, intervals apart) and their scores."""
        first, last = (r.ravel() for r in ranges)
        width = last - first
        place = np.repeat(first - (np.cumsum(width) - width), width) + np.arange(width.sum())
        gained = np.repeat(np.repeat(weights, ranges[0].shape[1]), width) * self.impact[place]
        scores = np.zeros(self.size, np.int64)
        np.add.at(scores, self.doc[place], gained)
        docs = np.flatnonzero(scores)
        return docs, scores[docs]

    def search(self, terms: np.ndarray, weights: np.ndarray, floor: int, found) -> None:
        """Calls ``found(documents, scores)``, which returns the new floor, until no interval can hold a document of at least
        the floor. ``terms`` are places in the vocabulary, ``weights`` their weights."""
        first = np.searchsorted(self.key, terms << self.bits)[:, None]
        last = np.searchsorted(self.key, (terms + 1) << self.bits)[:, None]
        held = (last > first)[:, 0]
        terms, weights, first, last = terms[held], weights[held], first[held], last[held]
        if not len(terms):
            return
        low_bits = (1 << self.bits) - 1
        peaks = self.peak(first, last)
        bounds = (weights[:, None] * (peaks >> self.bits)).sum(axis=0)
        while len(bounds):
            open_ = bounds >= floor
            if not open_.all():
                first, last, peaks, bounds = first[:, open_], last[:, open_], peaks[:, open_], bounds[open_]
                if not len(bounds):
                    return
            if len(bounds) > AT_ONCE:
                chosen = np.argpartition(-bounds, AT_ONCE)[:AT_ONCE]
            else:
                chosen = np.arange(len(bounds))
            rest = np.ones(len(bounds), bool)
            rest[chosen] = False
            a, b, top = first[:, chosen], last[:, chosen], peaks[:, chosen]
            first, last, peaks, bounds = first[:, rest], last[:, rest], peaks[:, rest], bounds[rest]
            small = (b - a).sum(axis=0) <= LEAF_POSTINGS
            if small.any():
                floor = found(*self.whole((a[:, small], b[:, small]), weights))
                a, b, top = a[:, ~small], b[:, ~small], top[:, ~small]
            if not a.shape[1]:
                continue
            best = (weights[:, None] * (top >> self.bits)).argmax(axis=0)
            split = top[best, np.arange(len(best))] & low_bits
            middle = np.searchsorted(self.key, (terms[:, None] << self.bits) + split).clip(a, b)
            here = (middle < b) & (self.doc[np.minimum(middle, len(self.doc) - 1)] == split)
            gained = np.where(here, self.impact[np.minimum(middle, len(self.doc) - 1)], 0)
            floor = found(split, (weights[:, None] * gained).sum(axis=0))
            a, b = np.concatenate((a, middle + here), axis=1), np.concatenate((middle, b), axis=1)
            top = self.peak(a, b)
            bound = (weights[:, None] * (top >> self.bits)).sum(axis=0)
            kept = bound >= floor
            first, last = np.concatenate((first, a[:, kept]), axis=1), np.concatenate((last, b[:, kept]), axis=1)
            peaks, bounds = np.concatenate((peaks, top[:, kept]), axis=1), np.concatenate((bounds, bound[kept]))


class Best:
    """The ``top`` best (score, document) of one item so far: higher scores first, then lower ids, a null id last."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.id, self.none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def floor(self) -> int:
        """The least score worth a look; an equal one may win by its id."""
        return max(1, int(self.score[-1])) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> int:
        worth = score >= self.floor
        if worth.any():
            self.score, self.id, self.none = (np.concatenate((x, y[worth])) for x, y in ((self.score, score), (self.id, ids), (self.none, none)))
            order = np.lexsort((self.id, self.none, -self.score))[: self.top]
            self.score, self.id, self.none = self.score[order], self.id[order], self.none[order]
        return self.floor


_POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = "place int, doc_id long, score long"


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            rows = [r for r in term_counts(texts, shared.value) if r[1]]
            if not rows:
                continue
            at = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows]))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(at, np.concatenate([r[k] for r in rows]).astype(np.int32)) for k in (2, 3)]
            ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([r[1] for r in rows], pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return materialize(docs.mapInArrow(run, _POSTINGS), "postings")


def _statistics(postings: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms, and documents per vocabulary term; one row per term and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        (at,) = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "held"])

    whole = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(size, np.int64)
    for r in postings.select("terms").mapInArrow(run, "term long, held long").groupBy("term").agg(F.sum("held").alias("held")).toLocalIterator():
        holding[r.term] = r.held
    return whole[0], whole[1], holding


def _best(postings: DataFrame, items: list[np.ndarray], weights: np.ndarray, documents: int, total: int, top: int) -> DataFrame:
    """Per task the ``top`` best documents of each item (place in ``items``)."""
    shared = postings.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best = [Best(top) for _ in items]
        held, size = [], 0

        def search() -> None:
            ids = pa.concat_arrays([b.column(0) for b in held])
            none, known = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            lists = [pa.concat_arrays([b.column(k) for b in held]) for k in (2, 3)]
            lengths = np.concatenate([b.column(1).to_numpy() for b in held])
            owner = np.repeat(np.arange(len(known)), lists[0].value_lengths().to_numpy())
            shard = Shard(lengths, owner, lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy(), documents, total)
            for own, terms in zip(best, items, strict=True):
                shard.search(terms, weights[terms], own.floor, lambda docs, scores, own=own: own.add(scores, known[docs], none[docs]))

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                size += len(part.column(2).flatten())
                if size >= SHARD_POSTINGS:
                    search()
                    held, size = [], 0
        if held:
            search()
        for i, own in enumerate(best):
            if len(own.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own.score), i, np.int32)), pa.array(own.id, mask=own.none), pa.array(own.score)], ["place", "doc_id", "score"]
                )

    return postings.mapInArrow(run, _FOUND)


def _first(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(
    documents: DataFrame, items: DataFrame, top: int = TOP, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item, rank 1 first.

    Scores and terms are those of the module's contract; a document of score 0 is no result, equal scores go by ascending
    document id, null ids last. Null texts have no terms; a text without terms is neither counted nor found. Rows with
    the same item id (null included) are one item with the terms of all of them; rows with the same document id are documents of
    their own. Terms are compared by 64-bit hashes. Empty tables give no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    source = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).filter("text IS NOT NULL")
    pairs = materialize(source.mapInArrow(_item_terms, "item long, term long").distinct(), "items")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    results = []
    for k in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item", "term").toArrow()
        if not rows.num_rows:
            continue
        terms = rows.column("term").to_numpy().view(U64)
        vocabulary, place = np.unique(terms, return_inverse=True)
        ids = rows.column("item").to_pylist()
        starts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
        own = [np.sort(p).astype(np.int64) for p in np.split(place, starts[1:])]
        postings = _postings(docs, vocabulary)
        number, total, holding = _statistics(postings, len(vocabulary))
        weights = np.array([weight(number, int(h)) for h in holding], np.int64)
        found = _best(postings, own, weights, number, total, top)
        lanes = _first(found.withColumn("lane", F.pmod(F.xxhash64("doc_id"), F.lit(LANES))), ["place", "lane"], top).drop("rank", "lane")
        names = spark.createDataFrame([(i, ids[s]) for i, s in enumerate(starts)], "place int, item_id long")
        results.append(_first(lanes, ["place"], top).join(names, "place"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
