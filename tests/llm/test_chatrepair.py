"""Conversation repair against a search over all edit sequences, and the damage and digests by hand."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import oracle_check
from tallyloom.llm import chatrepair
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.sql import ORACLE

ROLES = ["user", "assistant", "system", "tool", "", "ursula", None]
TEXTS = ["yes.", "no", "  ", "", "What?", "What? ", "so be it", None, "é!", "a\nb."]
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Per conversation: the counts and the least (cost, audit), found by a best-first search over all edit sequences."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn, " " if role is None else role, " " if text is None else text))
    found = {}
    for conv, turns in conversations.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in turns:
            signs = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not signs else "duplicate" if (role, text) in seen else "" if signs[-1] in ".!?" else "truncated")
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        heap, closed = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, tail, out = heapq.heappop(heap)
            if i == len(turns) and tail in ("", "a"):
                break
            if (i, tail) in closed:
                continue
            closed.add((i, tail))
            name = "assistant" if tail == "u" else "user"
            heapq.heappush(heap, (cost + 2, audit + "I", i, name[0], (*out, f"{name}:")))
            if i < len(turns):
                _, role, text = turns[i]
                heapq.heappush(heap, (cost + 3, audit + "D", i + 1, tail, out))
                if faults[i] not in ("blank", "duplicate"):
                    extra = int(faults[i] == "truncated")
                    if role[:1] == name[0] or role[:1] == "s" and not tail:
                        heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, name[0], (*out, f"{name}:{text}")))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return found


def repaired(turns):
    rows, found = chatrepair.repair(turns)
    hashes = {r.conv_id: r.sha256 for r in chatrepair.text_digests(rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, empty)) for r in found.collect()}


def random_rows(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(12)]), rng.choice([None, *range(6), 2**40]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_cheapest_edits_on_random_conversations(spark, seed):
    rows = random_rows(seed)
    assert repaired(spark.createDataFrame(rows, SCHEMA)) == cheapest(rows)


@pytest.mark.parametrize("seed", [3])
def test_blocks_of_a_conversation_chain(spark, monkeypatch, seed):
    monkeypatch.setattr(chatrepair, "BLOCK_BITS", 1)
    rows = random_rows(seed, 200)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert repaired(frame) == cheapest(rows)


def test_one_long_conversation(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(ROLES[:3]), rng.choice(["ok.", "why", f"text {t}.", f"text {t}"])) for t in range(5000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(16)
    assert repaired(frame) == cheapest(rows)


def test_run_powers_equal_single_steps():
    for symbol in range(9):
        whole = chatrepair.IDENTITY
        for n in range(1, 12):
            whole = chatrepair.product(whole, chatrepair.power(symbol, 0))
            assert tuple(tuple(min(x, chatrepair.NEVER) for x in r) for r in whole) == chatrepair.transition(bytes([symbol]) * n)


def test_damage(spark):
    rows = random_rows(4)
    frame = chatrepair.damage(spark.createDataFrame(rows, SCHEMA))
    got = sorted(map(repr, map(tuple, frame.filter("present").drop("present").collect())))
    assert got == sorted(map(repr, damaged(rows)))
    assert frame.select("conv_id").distinct().count() == len({r[0] for r in rows})


def test_query_on_random_rows_agrees_with_sql(spark, tmp_path):
    rows = [*random_rows(6), (99, 8, "user", "gone")]
    spark.createDataFrame(rows, SCHEMA).withColumn("class", F.lit("x")).withColumn("block", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    query = QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    assert oracle_check.differences(query, con, ORACLE["op13_conversation_repair"]) == []
    got = {r[0]: tuple(r[1:]) for r in query.collect()}
    want = cheapest(damaged(rows))
    gone = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, gone) for c in {r[0] for r in rows}}


def test_edits_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "user", "cut"), (1, 3, "tool", "done.")]
    edits, found = chatrepair.repair(spark.createDataFrame(rows, SCHEMA))
    assert [(r.edit, r.turn, r.role, r.text) for r in edits.orderBy("place", "step").collect()] == [
        ("I", None, "user", ""),
        ("K", 0, "assistant", "Hello."),
        ("D", 1, None, None),
        ("K", 2, "user", "cut"),
        ("R", 3, "assistant", "done."),
    ]
    assert found.first().audit == "IKDKR" and found.first().cost == 8


def test_empty_table(spark):
    edits, found = chatrepair.repair(spark.createDataFrame([], SCHEMA))
    assert edits.count() == 0 and found.count() == 0
