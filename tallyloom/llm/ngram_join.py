"""Grouped prefix join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

How it runs:

1. One scan hashes every whole text and flushes a bounded number of shingles at a time. Copies met in one flush are kept
   once. Each distinct shingle of a flush goes, with its count there, to the bucket of its hash, where document
   frequencies are summed: a shingle of a third of all documents is one entry per flush. Only shingles of two or more
   documents come back: no other can be shared, so the rest of a set is known by its size alone.
2. With the rarest shingles first, a prefix of ``n - ceil(0.8 n) + 1`` shingles must meet the prefix of any similar
   set. A document whose prefix holds only shingles of its own links with nothing and is done.
3. Documents of one size and one prefix form a group; a shingle's posting list holds each group once.
4. Members of the same min-hash block of prefix shingles are compared inside a task, breadth first, so that those that
   link stop being compared. Blocks beyond ``CHUNK`` documents are split.
5. Of every posting list, what the first components have not joined is paired: size filter and position filter on
   pairs of groups, then the members are expanded and verified on their shingles.
6. Components come from the links; copies take the component of their representative.

Links between documents that are already connected are not looked up again: the result is each document's class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.words import U64, chunks, mix, shingle_sets
from tallyloom.session import materialize

WORDS = 5
SIMILARITY = 80  # percent
CHUNK = 1024  # documents compared in one task
FLUSH_TOKENS = 1_500_000
DOCUMENT_WEIGHT = 8  # what a document counts beside its shingles, so that copies fill a flush too
MOST = np.iinfo(np.int32).max  # frequencies beyond it are equal in the order of shingles

_PACKED = "bucket long, flush long, codes binary, toks binary, counts binary, owners binary, meta binary"
_RETURNED = "flush long, codes binary, toks binary, dfs binary, counts binary, owners binary, meta binary"
_SETS = "doc_id long, n long, d1 long, d2 long, singles int, prefix array<long>, toks binary"
_DOCUMENT = np.dtype([("id", "<i8"), ("null", "?"), ("cls", "<u4"), ("head", "?"), ("n", "<i8"), ("d1", "<i8"), ("d2", "<i8")])


def prefix_length(n: int) -> int:
    return n - (SIMILARITY * n + 99) // 100 + 1


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])


def _shrink(values: np.ndarray, steps: bool = False) -> bytes:
    """Values plane by plane, from all lowest to all highest bytes: planes of leading zeros cost next to nothing once the
    shuffle compresses them. Runs of ascending values go as steps (modulo their width), which have more such planes."""
    if steps:
        values = np.diff(values, prepend=values.dtype.type(0))
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _grow(data: bytes, kind: type, steps: bool = False) -> np.ndarray:
    """The values that ``_shrink`` was given."""
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if steps else values


def _pack(docs: list[tuple], sets: list[np.ndarray], n_buckets: int, flush: int) -> pa.RecordBatch:
    """Rows of one flush: a row per bucket of shingles, and a row (negative bucket) that describes its documents.

    A shingle of one set carries the set's number as its code. One of several sets carries a number past those, its
    count goes along, and the sets that have it stay in the row that describes the flush.
    """
    meta = np.array(docs, _DOCUMENT)
    toks = np.concatenate(sets) if sets else np.empty(0, U64)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
    order = np.argsort(toks, kind="stable")
    toks, owner = toks[order], owner[order]
    first = _starts(toks)
    counts = np.diff(np.append(first, len(toks))).astype(np.uint32)
    many = counts > 1
    lists = (_shrink(counts[many]), _shrink(owner[np.repeat(many, counts)]))
    codes = np.where(many, len(sets) + np.cumsum(many) - 1, owner[first]).astype(np.uint32)
    toks = toks[first]
    bucket = ((toks >> U64(32)) * U64(n_buckets) >> U64(32)).astype(np.int64)  # a range of hashes, so steps are short
    order = np.argsort(2 * bucket + many, kind="stable")
    codes, toks, counts, many, bucket = (x[order] for x in (codes, toks, counts, many, bucket))
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
    filled = [b for b in range(n_buckets) if edges[b] < edges[b + 1]]
    pieces = [slice(int(edges[b]), int(edges[b + 1])) for b in filled]
    none = [None] * len(filled)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*filled, -1 - flush], pa.int64()),
            pa.array([flush] * (len(filled) + 1), pa.int64()),
            pa.array([*(_shrink(codes[p]) for p in pieces), None], pa.binary()),
            pa.array([*(_shrink(toks[p], steps=True) for p in pieces), None], pa.binary()),
            pa.array([*(_shrink(counts[p][many[p]]) for p in pieces), lists[0]], pa.binary()),
            pa.array([*none, lists[1]], pa.binary()),
            pa.array([*none, meta.tobytes()], pa.binary()),
        ],
        ["bucket", "flush", "codes", "toks", "counts", "owners", "meta"],
    )


def _packed_sets(n_buckets: int, n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20
        numbers = count()
        docs: list[tuple] = []
        sets: list[np.ndarray] = []
        known: dict[tuple, int] = {}
        held = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for lo, hi in chunks(texts):
                for doc, found in zip(ids[lo:hi], shingle_sets(texts[lo:hi], n_words), strict=True):
                    key = (len(found), int(mix(found).sum(dtype=U64).astype(np.int64)), int(mix(found ^ U64(77)).sum(dtype=U64).astype(np.int64)))
                    cls = known.get(key) if doc is not None else None
                    head = cls is None
                    if head:
                        cls = len(sets)
                        sets.append(found if doc is not None else found[:0])
                        if doc is not None:
                            known[key] = cls
                        held += len(sets[-1])
                    docs.append((doc or 0, doc is None, cls, head, *key))
                if held + DOCUMENT_WEIGHT * len(docs) >= FLUSH_TOKENS:
                    yield _pack(_least_heads(docs), sets, n_buckets, part + next(numbers))
                    docs, sets, known, held = [], [], {}, 0
        if docs:
            yield _pack(_least_heads(docs), sets, n_buckets, part + next(numbers))

    return run


def _least_heads(docs: list[tuple]) -> list[tuple]:
    """The document with the least id speaks for its copies."""
    least: dict[int, int] = {}
    for i, d in enumerate(docs):
        if d[2] not in least or d[0] < docs[least[d[2]]][0]:
            least[d[2]] = i
    return [(*d[:3], least[d[2]] == i, *d[4:]) for i, d in enumerate(docs)]


def _count_bucket(table: pa.Table) -> pa.Table:
    """Frequencies within a bucket: back to each flush go its shingles of two or more documents."""
    names = ["flush", "codes", "toks", "dfs", "counts", "owners", "meta"]
    schema = pa.schema([(name, pa.int64() if name == "flush" else pa.binary()) for name in names])
    column = {name: table.column(name).to_pylist() for name in names if name != "dfs"}
    if table.column("bucket")[0].as_py() < 0:
        return pa.table({**column, "dfs": [None] * table.num_rows}, schema=schema)
    toks = [_grow(t, U64, steps=True) for t in column["toks"]]
    weight = np.ones(sum(map(len, toks)), np.int64)
    at = 0
    for own, counts in zip(toks, column["counts"], strict=True):
        at += len(own)
        repeated = _grow(counts, np.uint32)
        weight[at - len(repeated) : at] = repeated
    _, which = np.unique(np.concatenate(toks), return_inverse=True)
    df = np.minimum(np.bincount(which, weights=weight), MOST).astype(np.int32)[which]
    rows, at = [], 0
    for flush, own, codes in zip(column["flush"], toks, column["codes"], strict=True):
        d = df[at : at + len(own)]
        at += len(own)
        if (keep := d > 1).any():
            kept = (_shrink(_grow(codes, np.uint32)[keep]), _shrink(own[keep], steps=True), _shrink(d[keep]))
            rows.append((flush, *kept, None, None, None))
    return pa.table(dict(zip(names, zip(*rows) if rows else [()] * len(names), strict=True)), schema=schema)


def _by_set(codes: np.ndarray, n_sets: int, counts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes as (set, place in ``codes``) pairs: one for the shingle of one set, one per set for the others."""
    (single,), (several,) = np.nonzero(codes < n_sets), np.nonzero(codes >= n_sets)
    which = codes[several].astype(np.int64) - n_sets
    ends = np.cumsum(counts, dtype=np.int64)
    lengths = counts[which].astype(np.int64)
    own_ends = np.cumsum(lengths)
    at = np.repeat(ends[which] - own_ends, lengths) + np.arange(lengths.sum())
    return np.concatenate((codes[single], owners[at])), np.concatenate((single, np.repeat(several, lengths)))


def _assemble(table: pa.Table) -> pa.Table:
    """The documents of one flush; those that can link also get their prefix and their shared shingles."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["meta"])
    meta = np.frombuffer(head["meta"], _DOCUMENT)
    n_classes = int(meta["cls"].max()) + 1
    codes, toks, df = (
        np.concatenate([np.empty(0, kind), *(_grow(r[c], kind, c == "toks") for r in rows if r["codes"])])
        for c, kind in (("codes", np.uint32), ("toks", U64), ("dfs", np.int32))
    )
    owner, place = _by_set(codes, n_classes, _grow(head["counts"], np.uint32), _grow(head["owners"], np.uint32))
    toks, df = toks[place], df[place]
    order = np.lexsort((toks, df, owner))
    owner, toks = owner[order], toks[order]
    edges = np.searchsorted(owner, np.arange(n_classes + 1))
    singles: list = []
    prefix: list = []
    shared: list = []
    for doc in meta:
        lo, hi = int(edges[doc["cls"]]), int(edges[doc["cls"] + 1])
        alone, p = int(doc["n"]) - (hi - lo), prefix_length(int(doc["n"]))
        if doc["head"] and not doc["null"] and hi > lo and alone < p:
            singles.append(alone)
            prefix.append(toks[lo : lo + p - alone].view(np.int64))
            shared.append(np.sort(toks[lo:hi]).tobytes())
        else:
            singles.append(None)
            prefix.append(None)
            shared.append(None)
    return pa.table(
        {
            "doc_id": pa.array(meta["id"], pa.int64(), mask=meta["null"].copy()),
            "n": pa.array(meta["n"]),
            "d1": pa.array(meta["d1"]),
            "d2": pa.array(meta["d2"]),
            "singles": pa.array(singles, pa.int32()),
            "prefix": pa.array(prefix, pa.list_(pa.int64())),
            "toks": pa.array(shared, pa.binary()),
        }
    )


def shingle_table(docs: DataFrame, id_col: str, text_col: str, n_words: int = WORDS) -> DataFrame:
    """One row per document: set size, set digest, and for documents that can link the prefix and shared shingles."""
    spark = docs.sparkSession
    n_buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = source.mapInArrow(_packed_sets(n_buckets, n_words), _PACKED)
    returned = packed.groupBy("bucket").applyInArrow(_count_bucket, _RETURNED)
    return returned.groupBy("flush").applyInArrow(_assemble, _SETS)


def _links_within(table: pa.Table) -> pa.Table:
    """A spanning forest of the links inside one block. A document taken from the queue is compared with those not
    reached yet, so the work shrinks as documents join."""
    ids = table.column("doc_id").to_numpy()
    sizes = table.column("n").to_numpy()
    sets = [np.frombuffer(t, U64) for t in table.column("toks").to_pylist()]
    lengths = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    mark = np.zeros(int(codes.max()) + 1, np.int64)
    found_a: list[int] = []
    found_b: list[int] = []
    rest = np.arange(len(ids))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            own = codes[offsets[at] : offsets[at + 1]]
            near = rest[(100 * np.minimum(sizes[rest], sizes[at]) >= SIMILARITY * np.maximum(sizes[rest], sizes[at]))]
            if not len(near):
                continue
            mark[own] = 1
            flat = np.concatenate([codes[offsets[i] : offsets[i + 1]] for i in near])
            common = np.add.reduceat(mark[flat], np.concatenate(([0], np.cumsum(lengths[near])[:-1])))
            mark[own] = 0
            linked = near[100 * common >= SIMILARITY * (sizes[near] + sizes[at] - common)]
            if len(linked):
                found_a += [int(ids[at])] * len(linked)
                found_b += ids[linked].tolist()
                queue += linked.tolist()
                rest = rest[~np.isin(rest, linked)]
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, na, nb = (batch.column(c).to_numpy() for c in ("a", "b", "na", "nb"))
        common = np.array(
            [
                len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True))
                for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)
            ],
            np.int64,
        )
        ok = 100 * common >= SIMILARITY * (na + nb - common)
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])


def _block_links(cand: DataFrame) -> DataFrame:
    """Links found inside blocks: two min-hash blocks per document. A large block is cut into chunks, for each seed in another
    way: documents of one template share both blocks, and what one cut separates meets in the other."""

    def least(seed: int):
        hashed = F.transform("prefix", lambda t: F.struct(F.xxhash64(t, F.lit(seed)).alias("h"), t.alias("t")))
        return F.array_min(hashed)["t"]

    keys = cand.select("doc_id", F.posexplode(F.array(least(1), least(2))).alias("seed", "block"))
    sizes = keys.groupBy("seed", "block").agg(F.count("*").alias("size")).filter("size > 1")
    placed = keys.join(sizes, ["seed", "block"]).select(
        "seed", "block", "doc_id", F.pmod(F.xxhash64("doc_id", "seed"), F.ceil(F.col("size") / CHUNK)).alias("chunk")
    )
    members = placed.join(cand.select("doc_id", "n", "toks"), "doc_id")
    return members.groupBy("seed", "block", "chunk").applyInArrow(_links_within, "a long, b long")


def _open_pairs(cand: DataFrame, comp: DataFrame) -> DataFrame:
    """Member pairs that may link and are not in one component yet, found as pairs of groups."""
    named = cand.join(comp, cand.doc_id == comp.node, "left").select(
        "doc_id", "n", "singles", "prefix", F.coalesce("component", "doc_id").alias("comp")
    )
    keyed = named.withColumn("key", F.xxhash64("prefix"))
    grouped = keyed.groupBy("n", "singles", "key").agg(
        F.min("doc_id").alias("gid"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.first("prefix").alias("prefix")
    )
    groups = grouped.withColumn("mixed", F.col("low") != F.col("high"))
    members = materialize(
        keyed.join(groups.drop("prefix"), ["n", "singles", "key"]).select("gid", "doc_id", "comp"), "members"
    )
    entries = groups.select(
        "gid", "n", "mixed", F.when(F.col("mixed"), -1 - F.col("gid")).otherwise(F.col("low")).alias("comp"),
        "singles", F.posexplode("prefix").alias("place", "token"),
    ).select("token", "gid", "n", "mixed", "comp", (F.col("singles") + F.col("place")).alias("pos"))
    entries = materialize(entries, "postings")
    per_comp = entries.groupBy("token", "comp").agg(F.count("*").alias("size"), F.max("mixed").alias("mixed"))
    lists = (
        per_comp.groupBy("token")
        .agg(F.max_by("comp", F.struct("size", "comp")).alias("main"), F.count("*").alias("comps"), F.max("mixed").alias("any_mixed"))
        .filter("comps > 1 OR any_mixed")
    )
    left = entries.join(lists, "token").filter("comp <> main OR mixed").select(
        "token", F.col("gid").alias("g1"), F.col("n").alias("n1"), F.col("pos").alias("p1"), F.col("comp").alias("c1"), F.col("mixed").alias("m1")
    )
    right = entries.select("token", F.col("gid").alias("g2"), F.col("n").alias("n2"), F.col("pos").alias("p2"), F.col("comp").alias("c2"))
    total = F.col("n1") + F.col("n2")
    needed = F.ceil(total * SIMILARITY / (100.0 + SIMILARITY) - 1e-6)
    pairs = left.join(right, "token").filter(
        ((F.col("c1") != F.col("c2")) | ((F.col("g1") == F.col("g2")) & F.col("m1")))
        & (100 * F.least("n1", "n2") >= SIMILARITY * F.greatest("n1", "n2"))
        & (F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2")) >= needed)
    )
    pairs = pairs.select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()
    one = members.select(F.col("gid").alias("g1"), F.col("doc_id").alias("x"), F.col("comp").alias("cx"))
    two = members.select(F.col("gid").alias("g2"), F.col("doc_id").alias("y"), F.col("comp").alias("cy"))
    expanded = pairs.join(one, "g1").join(two, "g2").filter("cx <> cy")
    return expanded.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``; other columns of ``docs`` are not looked at.

    Null and blank texts have no shingles and link with nothing. Rows that share an id are one node. A row without an id
    is never a representative; it takes the class of the rows with its set, or null. An empty table gives no rows.
    """
    table = materialize(shingle_table(docs, id_col, text_col, n_words), "shingle-sets")
    small = table.select("doc_id", "n", "d1", "d2")
    reps = small.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    reps = materialize(reps, "representatives")
    cand = table.filter("toks IS NOT NULL").join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    cand = materialize(cand.select("doc_id", "n", "singles", "prefix", "toks"), "candidates")
    near = materialize(_block_links(cand), "links")
    pairs = _open_pairs(cand, components(near))
    a = cand.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    b = cand.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    more = pairs.join(a, "a").join(b, "b").mapInArrow(_verified, "a long, b long")
    comp = components(near.unionByName(more))
    return (
        small.join(reps, ["n", "d1", "d2"], "left")
        .join(comp, F.col("rep") == F.col("node"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))
    )
