"""Exact token counts for every prefix of a text, by dynamic programming over its segments.

The vocabulary's pieces hold the space sign only in front (checked when the model is loaded), so no merge crosses from
a letter to a following space. A text is therefore a chain of independent segments, each a run of space signs and what
follows up to the next. The count of a prefix is the count of the segments before it plus the count of the segment it
ends in, cut there: a table over segments, each encoded once per task however often it occurs.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
SIGN = "▁"
CACHE_SEGMENTS = 400_000
_SEGMENT = re.compile(f"{SIGN}+[^{SIGN}]*")


class PrefixCounter:
    """Counts of one vocabulary file. The cache is emptied when full, so its memory is bounded."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.separable = not any(re.search(f"[^{SIGN}]{SIGN}", p) for p in pieces)
        self.known: dict[str, int] = {}

    def _count(self, segments: list[str]) -> None:
        """Encode the segments not met before. A segment's first sign is the one that the library puts in front."""
        new = [s for s in dict.fromkeys(segments) if s not in self.known]
        if len(self.known) + len(new) > CACHE_SEGMENTS:
            self.known.clear()
            new = list(dict.fromkeys(segments))
        found = self.model.encode([s[1:].replace(SIGN, " ") for s in new], num_threads=1) if new else []
        # A lone sign in front of nothing is encoded as nothing, but is a token where text goes on.
        self.known.update((s, len(ids) or 1) for s, ids in zip(new, found, strict=True))

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        signs = SIGN + text.replace(" ", SIGN)
        return _SEGMENT.findall(signs) if self.separable else [signs]

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """Prefix lengths in code points at the ends of segments, and the exact counts of those prefixes."""
        own = self.segments(text)
        self._count(own)
        chars, tokens, at, total = [0], [0], -1, 0
        for s in own:
            at += len(s)
            total += self.known[s]
            chars.append(at)
            tokens.append(total)
        return chars, tokens

    def count(self, text: str) -> int:
        own = self.segments(text)
        self._count(own)
        known = self.known
        return sum([known[s] for s in own])

    def prefix_count(self, text: str, table: tuple[list[int], list[int]], length: int) -> int:
        """Tokens of the first ``length`` code points."""
        if length <= 0:
            return 0
        chars, tokens = table
        k = bisect_right(chars, length) - 1
        if chars[k] == length:
            return tokens[k]
        cut = (SIGN + text[:length].replace(" ", SIGN))[chars[k] + 1 if k else 0 :]
        self._count([cut])
        return tokens[k] + self.known[cut]

    def every_prefix(self, text: str) -> list[int]:
        """Counts of the prefixes of 0, 1, ... code points."""
        table = self.table(text)
        return [self.prefix_count(text, table, i) for i in range(len(text) + 1)]

    def longest_prefix(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens. Cutting a segment can raise its count but not
        lower it below the segments before, so the end lies where those still fit."""
        chars, tokens = table = self.table(text)
        if tokens[-1] <= limit:
            return chars[-1]
        k = bisect_right(tokens, limit) - 1
        best = chars[k]
        for length in range(chars[k] + 1, chars[k + 1]):
            if self.prefix_count(text, table, length) <= limit:
                best = length
        return best


@lru_cache(maxsize=2)
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) per row; ``fit_chars`` is the longest prefix within the limit.

    ``model_file`` is the vocabulary's path on every machine. A null text counts as empty: no bytes, no tokens. Equal
    ids and rows are counted each for itself; no column but the two is looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model_file)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [own.count(t) for t in texts]
            fits = [len(t) if n <= limit else own.longest_prefix(t, limit) for t, n in zip(texts, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_()), pa.array(fits, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
