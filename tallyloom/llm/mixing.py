"""Mixing overlapping sources to target weights: a min-cost flow between membership patterns and source quotas.

Documents of one membership pattern (the set of sources they belong to) are alike, so the flow is over patterns: each
holds its words up to three times, the second and third time at a higher cost, and every source takes its quota from
the patterns that belong to it. All patterns go through the flow, whose size is that of the pattern table and not of
the corpus.

Which documents fill a pattern's part is decided by a seeded hash order: sums per hash bin find the bin in which the
part ends, and only that bin's documents are put in order.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

WEIGHTS = (5, 2, 1)  # repeating, sources by code point, null last
MAX_REPEATS = 3
SEED = "mix-0"
BIN_DIGITS = 3  # hexadecimal digits of the hash: 4,096 bins per pattern
MAX_PATTERNS = 1_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> dict:
    """Words wanted per source: shares of all words by weight, none above ``most`` times its source's words."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    # Sources reach their bound in the order of bound per weight; the rest share what is left.
    order = sorted(names, key=lambda s: most * sizes[s] / weight[s])
    open_words, open_weight = float(total), sum(weight.values())
    out = {}
    for s in order:
        share = open_words * weight[s] / open_weight
        out[s] = min(float(most * sizes[s]), share)
        open_words -= out[s]
        open_weight -= weight[s]
    return out


def _path(start: tuple, reached_sink, steps, dead: set) -> tuple[list, set]:
    """The shortest chain of nodes from a pattern to a source that still wants words, and all nodes met on the way.

    ``dead`` nodes are known not to lead anywhere; the chain is empty if nothing does.
    """
    came: dict = {start: None}
    queue = deque([start])
    while queue:
        node = queue.popleft()
        if reached_sink(node):
            chain = [node]
            while came[chain[-1]] is not None:
                chain.append(came[chain[-1]])
            return chain[::-1], set(came)
        for step in steps(node):
            if step not in came and step not in dead:
                came[step] = node
                queue.append(step)
    return [], set(came)


def route(patterns: dict[tuple, int], quotas: dict, most: int = MAX_REPEATS) -> dict[tuple, dict]:
    """Words each source takes from each pattern: maximum flow at least cost, the k-th repetition costing k - 1 a word.

    Successive shortest paths on the residual graph, one repetition level after the other, because entering at a level
    costs the same for all patterns. A path enters at a pattern with free words, and may pass through sources whose
    words another pattern can supply instead. What a search without success has met stays closed for the rest of its
    level (later paths do not touch it), so the work grows with the paths found and not with patterns times paths.
    """
    flow: dict[tuple, dict] = {p: {} for p in patterns}
    suppliers: dict = defaultdict(dict)  # source to the patterns it takes words from, in a fixed order
    wanted = dict(quotas)
    used = dict.fromkeys(patterns, 0)

    def wants(node) -> bool:
        return node[0] == "s" and wanted.get(node[1], 0) > 0

    def steps(node) -> list:
        kind, x = node
        return [("s", s) for s in x] if kind == "p" else [("p", p) for p in suppliers[x]]

    for level in range(most):
        dead: set = set()
        for p in sorted(patterns, key=repr):
            free = (level + 1) * patterns[p] - used[p]
            while free > 0 and ("p", p) not in dead:
                chain, met = _path(("p", p), wants, steps, dead)
                if not chain:
                    dead |= met
                    break
                back = list(zip(chain[1::2], chain[2::2], strict=False))
                amount = min(free, wanted[chain[-1][1]], *(flow[q][s] for (_, s), (_, q) in back))
                for (_, s), (_, q) in back:
                    flow[q][s] -= amount
                    if not flow[q][s]:
                        del flow[q][s], suppliers[s][q]
                for (_, q), (_, s) in zip(chain[::2], chain[1::2], strict=True):
                    flow[q][s] = flow[q].get(s, 0) + amount
                    suppliers[s][q] = None
                free -= amount
                used[p] += amount
                wanted[chain[-1][1]] -= amount
    return flow


def mix(docs: DataFrame, id_col: str, members: Column, text_col: str, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sources, size, taken): words the mix takes of each row, repeats counted; and the sources' summary.

    ``members`` is the array of sources a row belongs to (null counts as a source of that name, an empty array takes
    part in nothing). A row is taken whole, none more than three times; the last row of a pattern's part is taken if
    that brings the sum nearer. Null and blank texts have size 0. Ties and repeated rows follow the id's hash, so reruns
    agree. An empty table gives no rows.
    """
    own = F.array_sort(F.array_distinct(F.transform(members, lambda s: F.struct(s.isNull().alias("last"), s.alias("name")))))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.transform(own, lambda s: s["name"]).alias("sources"), word_count(F.col(text_col)).alias("size"))
    hashed = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    base = materialize(base.withColumn("key", hashed), "sizes")
    per_pattern = base.groupBy("sources").agg(F.sum("size").alias("words"))
    rows = per_pattern.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r.sources): r.words for r in rows}
    sizes: dict = defaultdict(int)
    for p, words in patterns.items():
        for s in p:
            sizes[s] += words
    wanted = targets(dict(sizes))
    flow = route(patterns, {s: int(t + 0.5) for s, t in wanted.items()})
    plan = []
    for p, words in patterns.items():
        taken = sum(flow[p].values())
        passes = taken // words if words else 0
        plan.append((list(p), passes, taken - passes * words))
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "sources array<string>, passes long, rest long")
    summary = spark.createDataFrame([(s, sizes[s], round(wanted[s], 6)) for s in sizes], "source string, source_size long, target double")
    bins = base.groupBy("sources", F.substring("key", 1, BIN_DIGITS).alias("bin")).agg(F.sum("size").alias("words"))
    ordered = Window.partitionBy("sources").orderBy("bin")
    bins = bins.withColumn("before", F.sum("words").over(ordered) - F.col("words")).join(plan, "sources")
    bins = bins.withColumn("left", F.col("rest") - F.col("before")).select("sources", "bin", "words", "passes", "left")
    bins = materialize(bins, "bins")
    joined = base.withColumn("bin", F.substring("key", 1, BIN_DIGITS)).join(bins, ["sources", "bin"])
    inside = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    within = Window.partitionBy("sources", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = joined.filter(inside).withColumn("upto", F.coalesce(F.sum("size").over(within), F.lit(0)))
    cut = cut.withColumn("extra", (2 * (F.col("left") - F.col("upto")) >= F.col("size")) & (F.col("left") > F.col("upto")))
    whole = joined.filter(~inside).withColumn("upto", F.lit(0)).withColumn("extra", F.col("left") > 0)
    chosen = whole.unionByName(cut)
    taken = F.col("size") * (F.col("passes") + F.col("extra").cast("long"))
    out = chosen.select("doc_id", "sources", "size", taken.alias("taken"))
    return out, summary


def mix_by_source(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for documents of one source each; a null source is a source."""
    out, summary = mix(docs, id_col, F.array(F.col(source_col)), text_col, seed)
    named = out.withColumn("source", F.col("sources")[0])
    return named.join(summary, named.source.eqNullSafe(summary.source)).select("doc_id", "size", "source_size", "target", "taken")
