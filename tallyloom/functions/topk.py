"""Best-k bookkeeping inside one task: Arrow vectors in, Arrow candidates out.

The module is pickled by value, so executors need no installed copy of this package to run a search.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCORES_AT_ONCE = 4_000_000


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """A list column as a float64 matrix with rows of length one (a zero vector stays zero)."""
    if len(pc.unique(pc.list_value_length(vectors))) > 1:
        raise ValueError("vectors of different lengths")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    matrix = flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


class TopK:
    """Running best ``depth`` documents of each query, by score descending and then document id."""

    def __init__(self, qids: list, units: np.ndarray, depth: int, digits: int):
        self.qids, self.units, self.depth, self.digits = qids, units, depth, digits
        self.scores = [np.empty(0) for _ in qids]
        self.ids = [np.empty(0, dtype=object) for _ in qids]
        self.floor = np.full(len(qids), -np.inf)

    def add(self, doc_ids: pa.Array, vectors: pa.Array) -> None:
        """Offer documents, in slices whose score matrix stays small."""
        step = max(1, _SCORES_AT_ONCE // len(self.qids))
        for start in range(0, len(doc_ids), step):
            self._add_slice(doc_ids.slice(start, step), vectors.slice(start, step))

    def _add_slice(self, doc_ids: pa.Array, vectors: pa.Array) -> None:
        ids = np.array(doc_ids.to_pylist(), dtype=object)
        scores = np.round(self.units @ unit_rows(vectors).T, self.digits) + 0.0
        hopeful = scores >= self.floor[:, None]
        for q in np.flatnonzero(hopeful.any(axis=1)):
            new = np.flatnonzero(hopeful[q])
            all_scores = np.concatenate([self.scores[q], scores[q, new]])
            all_ids = np.concatenate([self.ids[q], ids[new]])
            if len(all_scores) > self.depth:
                # drop what is certainly below the cut before the exact ordering by (score, id)
                cut = -np.partition(-all_scores, self.depth - 1)[self.depth - 1]
                near = all_scores >= cut
                all_scores, all_ids = all_scores[near], all_ids[near]
            order = np.argsort(all_ids, kind="stable")
            order = order[np.argsort(-all_scores[order], kind="stable")][: self.depth]
            self.scores[q], self.ids[q] = all_scores[order], all_ids[order]
            if len(order) == self.depth:
                self.floor[q] = self.scores[q][-1]

    def table(self, schema: pa.Schema, lane: int) -> pa.Table:
        counts = [len(s) for s in self.scores]
        total = sum(counts)
        qids = [q for q, n in zip(self.qids, counts) for _ in range(n)]
        return pa.Table.from_arrays(
            [
                pa.array(qids, schema.field("qid").type),
                pa.array([d for ids in self.ids for d in ids], schema.field("doc_id").type),
                pa.array(np.concatenate(self.scores) if total else np.empty(0), pa.float64()),
                pa.array(np.full(total, lane), pa.int32()),
            ],
            schema=schema,
        )
