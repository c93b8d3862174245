"""Repair of broken conversation structure by cheapest edits, as a run-length dynamic programme.

A row is reduced to a symbol: the class of its role's initial and its fault. Blocks of ``1 << BLOCK_BITS`` rows of a
conversation become one min-plus matrix each: equal consecutive symbols are collapsed into runs, and a run of any length is a
product of cached binary powers of its symbol's transition. The matrices of a conversation are chained from its end, which
leaves every block the cost of all that follows it; the choices are then unrolled forward, block by block, into edits. Only
one byte per row takes part in that; texts are joined with their edits where they lie, so a conversation of any length is
spread over many tasks.

States say what the repaired rows so far end in: nothing, a system row, a user row, an assistant row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize

BLOCK_BITS = 10
RANGES_SEED = 11
BLANK_CLASS = r"[^\x20\x09-\x0D]"
ENDS = ".!?"

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the only state that an inserted or re-roled row can lead to
ROLE = {USER: "user", ASSISTANT: "assistant"}
CLASSES = "sua"  # initials; any other role is class 3
OTHER = 3
DROP = 8  # symbol of a row that must go; other symbols are 2 * class + truncated
NEVER = 1 << 60
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
AT_END = (0, 2 * INSERT, INSERT, 0)  # cost of closing a conversation from each state

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def kept_state(state: int, symbol: int) -> int | None:
    """The state after a row is kept as it is, or None where its role can't stand there."""
    role = symbol >> 1
    if role == OTHER:
        return None
    if role == 0:
        return SYSTEM if state == START else None
    return role + 1 if NEXT[state] == role + 1 else None


def edits_of(state: int, symbol: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after it) of one row, without insertions, in the order of the audit letters D, K, R."""
    yield "D", DELETE, state
    if symbol != DROP:
        extra = TRUNCATED * (symbol & 1)
        after = kept_state(state, symbol)
        if after is not None:
            yield "K", extra, after
        yield "UA"[NEXT[state] - USER], REROLE + extra, NEXT[state]


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + v[k] for k, x in enumerate(row)) for row in a)


@lru_cache(maxsize=None)  # 9 symbols and one power per bit of a block's length
def power(symbol: int, bit: int) -> Matrix:
    """The transition over ``1 << bit`` rows of one symbol: at most two insertions before each row, then its edit."""
    if bit:
        half = power(symbol, bit - 1)
        return product(half, half)
    rows = []
    for start in range(4):
        best = [NEVER] * 4
        state = start
        for inserted in range(3):
            for _, cost, after in edits_of(state, symbol):
                best[after] = min(best[after], INSERT * inserted + cost)
            state = NEXT[state]
        rows.append(tuple(best))
    return tuple(rows)


IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


@lru_cache(maxsize=1 << 14)
def transition(symbols: bytes) -> Matrix:
    """The min-plus matrix of a block, run by run."""
    whole = IDENTITY
    for symbol, run in groupby(symbols):
        length = sum(1 for _ in run)
        for bit in range(length.bit_length()):
            if length >> bit & 1:
                whole = product(whole, power(symbol, bit))
    return tuple(tuple(min(x, NEVER) for x in row) for row in whole)


@lru_cache(maxsize=1 << 14)
def unrolled(symbols: bytes, after: Vector, state: int, last: bool) -> tuple[tuple[str, ...], int, int]:
    """Per row its edits (insertions before it included), the state after the block, and the cost.

    ``after`` is the cost of what follows the block, by state. Of the cheapest edits, the audit letter that sorts first is
    taken at every step; a letter leads to one state only, so the audit is the least one. Codes: K keep, D delete, U and A
    re-role to user or assistant, u and a insert one; the last block of a conversation closes it with insertions.
    """
    left = [after]
    for symbol, run in groupby(reversed(symbols)):
        step = power(symbol, 0)
        for _ in run:
            left.append(applied(step, left[-1]))
    left.reverse()
    codes, cost = [], 0
    for i, symbol in enumerate(symbols):
        code = ""
        while True:
            want = left[i][state]
            options = list(edits_of(state, symbol))
            options.insert(1, ("I", INSERT, NEXT[state]))
            for edit, price, then in options:
                rest = left[i] if edit == "I" else left[i + 1]
                if price + rest[then] == want:
                    break
            state, cost = then, cost + price
            code += "ua"[then - USER] if edit == "I" else edit
            if edit != "I":
                break
        codes.append(code)
    if last:
        while AT_END[state]:
            state, cost = NEXT[state], cost + INSERT
            codes[-1] += "ua"[state - USER]
    return tuple(codes), state, cost


# -- Spark ---------------------------------------------------------------------------------------------------------


def damage(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text, present): the rows after deterministic damage by the checksum of ``conv_id:turn``.

    Nulls are one space, in the checksum too; ``turn`` keeps its nulls. A dropped row stays with ``present`` false and empty role
    and text, so that its conversation is not forgotten; a repeated row comes twice.
    """
    named = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    rows = named.select("*", kind.alias("kind"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
    )


def placed(turns: DataFrame) -> DataFrame:
    """Writes ``turns`` in order with ``place``, a number that rises with (conversation, turn, role, text digest), nulls first.

    Rows that are not present come last in their conversation, so the others are numbered without holes inside a block. The
    order is laid out in ranges, so that no task needs a whole conversation; what is sampled for them has no texts.
    """
    keys = [F.col("conv_id").asc_nulls_first(), F.col("present").desc(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    whole = turns.withColumn("digest", F.unhex(F.sha2("text", 256)))
    ranged = whole.repartitionByRange(*keys, F.rand(RANGES_SEED)).sortWithinPartitions(*keys)
    return materialize(ranged.withColumn("place", F.monotonically_increasing_id()), "turns")


def _block() -> Column:
    return F.shiftright("place", BLOCK_BITS).alias("block")


def _slim(rows: DataFrame) -> DataFrame:
    """One symbol per row and what the fault counts need; no text."""
    found = rows.filter("present").select(
        "conv_id",
        "turn",
        "place",
        reduce(lambda rest, i: F.when(F.startswith("role", F.lit(CLASSES[i])), i).otherwise(rest), range(len(CLASSES)), F.lit(OTHER)).alias("class"),
        "role",
        "digest",
        (~F.col("text").rlike(BLANK_CLASS)).alias("blank"),
        (~F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1).isin(*ENDS)).alias("cut"),
    )
    firsts = found.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    return found.drop("role", "digest").join(firsts, "place", "left").select("conv_id", "place", _block(), "turn", "class", fault.alias("fault"))


_PIECE = (
    "conv_id long, block long, first_place long, symbols binary, blank long, duplicate long, truncated long, illegal long, "
    "first_class int, last_class int, turns long, first_turn long, last_turn long"
)
_PLAN = _PIECE.replace("symbols binary", "codes array<string>") + ", cost long"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _sent(rows: Iterator[tuple], ddl: str, size: int = 2048) -> Iterator[pa.RecordBatch]:
    schema, held = _arrow(ddl), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batches(held, schema)
            held = []
    if held:
        yield _batches(held, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block, in order, to the block's symbols and counts."""

    def found() -> Iterator[tuple]:
        for (conv, block), rows in groupby(_rows(batches, ["conv_id", "block", "place", "turn", "class", "fault"]), lambda r: r[:2]):
            rows = list(rows)  # at most 1 << BLOCK_BITS
            classes, faults = [r[4] for r in rows], [r[5] for r in rows]
            known = [r[3] for r in rows if r[3] is not None]
            symbols = bytes(DROP if f in (1, 2) else 2 * c + (f == 3) for c, f in zip(classes, faults, strict=True))
            yield (
                conv, block, rows[0][2], symbols, faults.count(1), faults.count(2), faults.count(3),
                sum(pair not in _LEGAL for pair in zip(classes, classes[1:], strict=False)), classes[0], classes[-1],
                len(set(known)), known[0] if known else None, known[-1] if known else None,
            )

    yield from _sent(found(), _PIECE)


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation, last first: adds the cost of what follows each, and whether nothing does."""
    conv, after = object(), AT_END
    for batch in batches:
        out = []
        for own, symbols in zip(batch.column("conv_id").to_pylist(), batch.column("symbols").to_pylist(), strict=True):
            last = own != conv
            if last:
                conv, after = own, AT_END
            out.append((list(after), last))
            after = applied(transition(symbols), after)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([a for a, _ in out], pa.list_(pa.int64())), pa.array([x for _, x in out], pa.bool_())],
            [*batch.schema.names, "after", "last"],
        )


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation in order: their edits, and counts without what two neighbouring blocks share."""
    names = [f.split()[0] for f in _PIECE.split(", ")]

    def found() -> Iterator[tuple]:
        conv, state, role, turn = object(), START, None, None
        for row in _rows(batches, [*names, "after", "last"]):
            p = dict(zip([*names, "after", "last"], row, strict=True))
            if p["conv_id"] != conv:
                conv, state, role, turn = p["conv_id"], START, None, None
            least = min(p["after"])
            codes, state, cost = unrolled(p["symbols"], tuple(x - least for x in p["after"]), state, p["last"])
            p["illegal"] += role is not None and (role, p["first_class"]) not in _LEGAL
            p["turns"] -= turn is not None and turn == p["first_turn"]
            role, turn = p["last_class"], p["last_turn"] if p["last_turn"] is not None else turn
            p["symbols"] = list(codes)
            yield (*[p[n] for n in names], cost)

    yield from _sent(found(), _PLAN)


def plan(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every block of ``placed`` rows, one code string per row, with the block's counts."""
    slim = _slim(rows).repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    pieces = slim.mapInArrow(_pieces, _PIECE)
    chained = pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")).mapInArrow(_costs, f"{_PIECE}, after array<long>, last boolean")
    return materialize(chained.sortWithinPartitions("conv_id", "block").mapInArrow(_choices, _PLAN), "edits")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, place, step, edit, turn, role, text): every edit in order, with the row as it stands after it.

    ``edit`` is Keep, Rerole, Delete (role and text null) or Insert (empty text), by initial. Order by (place, step).
    """
    of_block = edits.select(F.col("conv_id").alias("own"), F.col("block").alias("own_block"), "first_place", "codes")
    joined = rows.filter("present").withColumn("block", _block()).join(of_block, F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("block") == F.col("own_block")))
    code = F.element_at("codes", (F.col("place") - F.col("first_place") + 1).cast("int"))
    letters = joined.select("conv_id", "place", "turn", "role", "text", F.posexplode(F.split(code, "")).alias("step", "code"))
    inserted = F.col("code").isin("u", "a")
    role = F.when(F.lower("code") == "u", ROLE[USER]).when(F.lower("code") == "a", ROLE[ASSISTANT]).when(F.col("code") == "K", F.col("role"))
    return letters.select(
        "conv_id",
        "place",
        "step",
        F.translate("code", "uaUA", "IIRR").alias("edit"),
        F.when(~inserted, F.col("turn")).alias("turn"),
        role.alias("role"),
        F.when(inserted, "").when(F.col("code") != "D", F.col("text")).alias("text"),
    )


def summary(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation in ``rows``.

    A conversation of which no row is present has zeros and an empty audit.
    """
    part = F.struct("block", F.translate(F.array_join("codes", ""), "uaUA", "IIRR").alias("audit"))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns"), F.lit(0)).alias("gaps")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["audit"]), "")
    found = edits.groupBy(F.col("conv_id").alias("own")).agg(gaps, *sums, audit.alias("audit"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    known = rows.select("conv_id").distinct()
    return known.join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names], F.coalesce("audit", F.lit("")).alias("audit")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    names = ["conv_id", "sha256"]
    conv, digest = None, None
    for batch in batches:
        done = []
        for own, role, text in _rows(iter([batch]), ["conv_id", "role", "text"]):
            if digest is None or own != conv:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest, lead = own, hashlib.sha256(), ""
            digest.update(f"{lead}{role}:{text}".encode())
            lead = "\n"
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done])], names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names)


def text_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) over ``role:text`` of each conversation's repaired rows, newline-joined.

    A digest can only be taken in order, so a conversation's rows pass through one task, as a sorted stream of which one row at
    a time is held.
    """
    kept = turns.filter("edit <> 'D'").select("conv_id", "place", "step", "role", "text")
    return kept.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step").drop("place", "step").mapInArrow(_digests, "conv_id long, sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows of ``turns`` (conv_id, turn, role, text, and optionally present) and a summary per conversation.

    Rows go by turn, nulls first; rows of one turn by role, then by the SHA-256 of their text, so repeated rows are neighbours
    and any order of the input gives the same result. Null roles and texts are one space. A null conversation id is an id
    of its own. An empty table gives no rows.
    """
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    blank = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = placed(turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *blank, present.alias("present")))
    edits = plan(rows)
    return repaired(rows, edits), summary(rows, edits)
