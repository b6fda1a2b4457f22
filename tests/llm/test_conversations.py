"""Conversation repair against plain Python."""

import functools
import hashlib
import random
import zlib

import pytest

from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault): all edit sequences, by memo on (place, state)."""
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def then(edit, cost, j, new, line, more):
            rest = best(j, new, more)
            if rest:
                found.append((cost + rest[0], edit + rest[1], line + rest[2]))
        name = {"u": "user", "a": "assistant"}[turn[state]]
        if inserts:
            then("I", 5, i, turn[state], (f"{name}:",), inserts - 1)
        if i < len(rows):
            role, text, fault = rows[i]
            then("D", 2, i + 1, state, (), 3)
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                if (role[:1] == "s" and state == "") or role[:1] == turn[state]:
                    then("K", extra, i + 1, role[:1], (f"{role}:{text}",), 3)
                then("R", 1 + extra, i + 1, turn[state], (f"{name}:{text}",), 3)
        return min(found) if found else None
    for i in range(len(rows), 0, -1):       # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 3)
    return best(0, "", 3)


def brute(table):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        rows += [(turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest(), text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort()
        seen, marked, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, _, text in rows:
            solid = text.strip(SPACE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
            if fault:
                faults[fault] += 1
        turns = [r[1] for r in rows if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[0][:1] for r in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = cheapest(tuple(marked))
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    from lifetide.llm.conversations import repair_conversations
    rows = repair_conversations(df).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS[1:]) for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string"


def talk(seed, convs=160, odd=True):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system"] + (["tool", "Usher", "", None, "s", "u"] if odd else [])
    texts = ["Yes.", "No", "Why?  ", "ok!\n", "   ", "", "Ünïcode. 𝔘", "a. b"] + ([None] if odd else [])
    table = []
    for conv in range(convs):
        at = 0
        for _ in range(rnd.choice((1, 2, 3, 5, 9, 14))):
            at += rnd.choice((0, 1, 1, 1, 2, 40)) if odd else 1
            table.append((conv if conv or not odd else None, None if odd and rnd.random() < 0.1 else at, rnd.choice(roles), rnd.choice(texts)))
    rnd.shuffle(table)
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_repair(spark, seed):
    table = talk(seed) + talk(seed + 10, 9)[:20] * 2
    got = found(spark.createDataFrame(table, SCHEMA).repartition(7).withColumns({c: F.lit("x") for c in ("copies", "kind", "at", "hash", "cost", "_c")}))
    assert got == brute(table)
    assert any(v[0] for v in got.values()) and {c for v in got.values() for c in v[6]} >= set("DKR")


def test_long_and_repeated(spark):
    """One conversation over many partitions and batches, one of equal rows, one of one role, very long texts."""
    rnd = random.Random(4)
    table = [(7, i, rnd.choice(("user", "assistant", "assistant", "system")), rnd.choice(("So.", f"No {i}.", f"cut {i}", ""))) for i in range(400)]
    table += [(8, 3, "user", "Same words.")] * 250 + [(9, i, "assistant", f"{i}!") for i in range(300)]
    table += [(10, 0, "user", "word " * 200_000 + "?"), (10, 1, "assistant", "." * 300_000)]
    assert found(spark.createDataFrame(table, SCHEMA).repartition(9)) == brute(table)


def test_batches_cut_conversations(spark):
    table = [(7, i, ("user", "assistant")[i % 2], f"Line {i // 3}.") for i in range(300)] + talk(5, 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spark.createDataFrame(table, SCHEMA)) == brute(table)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_empty_dropped_and_null(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    table = [(5, dropped, "user", "gone."), (None, None, None, None), (6, None, "assistant", None)]
    got = found(spark.createDataFrame(table, SCHEMA))
    assert got == brute(table)
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_runs_are_powers():
    """A run of n equal symbols costs what n single steps cost; a million rows need twenty products."""
    from lifetide.llm.conversations import ACCEPTED, advance
    for symbol in range(16):
        costs = ACCEPTED
        for n in range(1, 40):
            costs = advance(symbol, 1, costs)
            assert advance(symbol, n, ACCEPTED) == costs
    assert advance(4, 10**6, ACCEPTED)[0] < 10**7
