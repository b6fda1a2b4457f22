"""Conversation structure repair by run-length dynamic programming (operator 12).

A conversation's rows, in order, are symbols: the role's initial (s, u, a, other)
and the row's fault.  Cheapest edits (keep 0, rerole 1, delete 2, insert 5; a
truncated row that is not deleted 5 more) lead through the four states of
``(s?(ua)+)?``, so every symbol is a 4 x 4 min-plus matrix.  Equal symbols in a
row are one run; a run of n advances the costs through binary powers of its
matrix, which are computed once per symbol and kept.  The costs to the end,
known at every run boundary, then unroll to choices from the front: of the edits
that stay on a cheapest path the ASCII-least is taken (an edit and a state give
the next state, so this is the ASCII-least audit).

How it runs: rows become narrow symbols (no texts), equal rows of one turn are
one row with a count, and a row is a duplicate if its role and text have an
earlier first place (partial aggregates, joined by hash).  The symbols are range
partitioned by conversation and turn, so a conversation of any size is cut into
pieces; each piece becomes its runs and counts.  One small row per piece meets the
others of its conversation, where the runs are repaired.  Last, texts move once,
each conversation's in order behind its audit, and stream through the digest.
The audit and the digest are one value per conversation, so one task writes
them; it holds runs and the audit, but never a conversation's texts.

Order: by turn, nulls first; rows of one turn by role, then by the hash of their
text (equal rows are copies of each other).  Defined results: null texts and roles
are one blank (a blank has no legal role, so it is reroled or deleted); a null
conv_id or turn is a blank in the hash, rows without conv_id are one conversation;
repeated rows are duplicates; a conversation that keeps no row has zeros, an empty
audit and the digest of the empty string; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import stage

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SOLID = r"[^\x20\x09-\x0D]"
SPACES = r"[\x20\x09-\x0D]"
ROLES = "sua"              # initials that have a class of their own (0, 1, 2; all others 3)
FAULTS = ("none", "truncated", "blank", "duplicate")

# ------------------------------------------------------- min-plus, four states
START, SYSTEM, USER, DONE = range(4)       # nothing yet; after s; after u; after a
STATES = range(4)
NEXT_TURN = {START: USER, SYSTEM: USER, USER: DONE, DONE: USER}    # the state after the turn that must come
INF = 1 << 60


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row with ``symbol`` (class * 4 + fault), ASCII order; insertions not included."""
    role, fault = divmod(symbol, 4)
    out = [("D", DELETE, state)]
    if fault < 2:
        extra = TRUNCATED if fault == 1 else 0
        if role == 0 and state == START:
            out.append(("K", KEEP + extra, SYSTEM))
        elif role == 1 and state != USER:
            out.append(("K", KEEP + extra, USER))
        elif role == 2 and state == USER:
            out.append(("K", KEEP + extra, DONE))
        out.append(("R", REROLE + extra, NEXT_TURN[state]))
    return out


def _times(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def _apply(m, v):
    return tuple(min(m[i][k] + v[k] for k in STATES) for i in STATES)


def _insertions():
    """Any number of insertions."""
    m = [[INF] * 4 for _ in STATES]
    for i in STATES:
        state, cost = i, 0
        for _ in STATES:
            m[i][state] = min(m[i][state], cost)
            state, cost = NEXT_TURN[state], cost + INSERT
    return tuple(map(tuple, m))


INSERTED = _insertions()


@functools.cache
def power(symbol: int, k: int):
    """The matrix of 2^k rows of ``symbol``, insertions before each."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    row = [[INF] * 4 for _ in STATES]
    for i in STATES:
        for _, cost, j in edits(symbol, i):
            row[i][j] = min(row[i][j], cost)
    return _times(INSERTED, row)


def advance(symbol: int, count: int, costs):
    """Costs to the end before a run, given those after it."""
    k = 0
    while count:
        if count & 1:
            costs = _apply(power(symbol, k), costs)
        count >>= 1
        k += 1
    return costs


ACCEPTED = _apply(INSERTED, (0, INF, INF, 0))


@functools.lru_cache(1 << 16)
def _choose(symbol: int, state: int, after):
    """Edits of one row, and the state after it, given the costs to the end after it (from their least)."""
    before = _apply(power(symbol, 0), after)
    out, left = "", before[state]
    while True:
        for edit, cost, j in edits(symbol, state):
            # I sorts between D and K
            if edit > "I" and INSERT + before[NEXT_TURN[state]] == left:
                break
            if cost + after[j] == left:
                return out + edit, j
        out, state = out + "I", NEXT_TURN[state]
        left = before[state]


def repair(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of a conversation given as runs (symbol, count)."""
    after = [ACCEPTED]
    for symbol, count in reversed(runs):
        after.append(advance(symbol, count, after[-1]))
    total, state, audit = after[-1][START], START, []
    for i, (symbol, count) in enumerate(runs):
        # costs within the run, from its end; the same few vectors come again and again
        steps = [after[len(runs) - 1 - i]]
        least = min(steps[0])
        steps[0] = tuple(min(c - least, INF) for c in steps[0])
        for _ in range(count - 1):
            steps.append(_step(symbol, steps[-1]))
        for costs in reversed(steps):
            edit, state = _choose(symbol, state, costs)
            audit.append(edit)
    while state not in (START, DONE):
        audit.append("I")
        state = NEXT_TURN[state]
    return total, "".join(audit)


@functools.lru_cache(1 << 16)
def _step(symbol: int, after):
    before = _apply(power(symbol, 0), after)
    least = min(before)
    return tuple(min(c - least, INF) for c in before)


# ------------------------------------------------------------------ symbols
def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (0: dropped, 2: repeated) after the damage."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"),
                       F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")).alias("_c"))
    kind = F.col("_c") % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _place() -> list[Column]:
    """Order of the rows of a conversation; ``known``: turn is not null."""
    return [F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("at"), F.col("role"),
            F.unhex(F.md5(F.col("text").cast("binary"))).alias("hash")]


ORDER = ("known", "at", "role", "hash")


def symbols(rows: DataFrame) -> DataFrame:
    """conv_id, known, at, role, hash, copies, role class, fault of the first copy, of damaged ``rows``; one row per distinct row."""
    solid = F.col("text").rlike(SOLID)
    ends = F.col("text").rlike(rf"[.!?]{SPACES}*\z")
    narrow = rows.select("conv_id", *_place(), F.col("copies").cast("long").alias("copies"),
                         F.when(~solid, 2).when(~ends, 1).otherwise(0).alias("fault"))
    # dropped rows stay as a trace of their conversation
    one = stage(narrow.groupBy("conv_id", *ORDER).agg(F.sum("copies").alias("copies"), F.min("fault").alias("fault")), "symbols")
    kept = one.filter("copies > 0 and fault < 2")
    firsts = (kept.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("hash").alias("_hash"))
              .agg(F.min(F.struct("known", "at")).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    later = F.col("_first").isNotNull() & ((F.col("known") != F.col("_first.known")) | (F.col("at") != F.col("_first.at")))
    initial = F.instr(F.lit(ROLES), F.substring("role", 1, 1))
    return (one.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("hash") == F.col("_hash")), "left")
            .select("conv_id", *ORDER, "copies", F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1).cast("int").alias("role_class"),
                    F.when(later & (F.col("fault") < 2), 3).otherwise(F.col("fault")).cast("int").alias("fault")))


#: what a piece of a conversation tells: its runs, its counts and its edges
PIECE = ("runs binary, blank long, duplicate long, truncated long, illegal long, "
         "turns long, low long, high long, first_class int, last_class int")
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True        # su, ua, au


def _pieces(batches, conv_type: pa.DataType):
    """One row per conversation of a sorted partition (and per batch, for one that goes on)."""
    schema = pa.schema([("conv_id", conv_type), ("runs", pa.binary()), *[(c, pa.int64()) for c in (
        "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")], ("first_class", pa.int32()), ("last_class", pa.int32())])
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv_id")
        known, at, copies, role, fault = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("known", "at", "copies", "role_class", "fault"))
        codes = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        # every distinct row is one symbol, then its copies as duplicates (as blanks, if blank)
        more = np.where(fault == 2, 2, 3)
        sym = np.empty(2 * n, np.int64)
        sym[0::2], sym[1::2] = role * 4 + fault, role * 4 + more
        count = np.empty(2 * n, np.int64)
        count[0::2], count[1::2] = np.minimum(copies, 1), np.maximum(copies - 1, 0)
        conv_of = np.repeat(np.searchsorted(first, np.arange(n), side="right") - 1, 2)
        live = count > 0
        sym, count, conv_of = sym[live], count[live], conv_of[live]
        m = len(first)
        out = {c: np.zeros(m, np.int64) for c in ("blank", "duplicate", "truncated", "illegal")}
        for name, code in (("truncated", 1), ("blank", 2), ("duplicate", 3)):
            here = sym % 4 == code
            np.add.at(out[name], conv_of[here], count[here])
        cls = sym // 4
        # pairs inside an entry have one initial twice; between entries of one conversation there is one pair
        np.add.at(out["illegal"], conv_of, count - 1)
        pair = np.flatnonzero(conv_of[1:] == conv_of[:-1])
        np.add.at(out["illegal"], conv_of[pair + 1], ~_LEGAL[cls[pair], cls[pair + 1]])
        new = np.ones(len(sym), bool)
        new[1:] = (sym[1:] != sym[:-1]) | (conv_of[1:] != conv_of[:-1])
        begin = np.flatnonzero(new)
        lengths = np.add.reduceat(count, begin) if len(begin) else np.zeros(0, np.int64)
        packed = np.stack([sym[begin], lengths], axis=1)
        bound = np.searchsorted(conv_of[begin], np.arange(m + 1))
        # turns, of rows that are there and have one
        there = np.flatnonzero(known & (copies > 0))
        owner = np.searchsorted(first, there, side="right") - 1
        turn = at[there]
        fresh = np.ones(len(there), bool)
        fresh[1:] = (turn[1:] != turn[:-1]) | (owner[1:] != owner[:-1])
        turns = np.bincount(owner[fresh], minlength=m)
        lo, hi = np.searchsorted(owner, np.arange(m)), np.searchsorted(owner, np.arange(m), side="right")
        none = lo == hi
        edge = lambda i: pa.array(turn[np.minimum(i, len(turn) - 1)] if len(turn) else np.zeros(m, np.int64), mask=none)
        has = bound[1:] > bound[:-1]
        lead = pa.array((packed[np.minimum(bound[:-1], len(packed) - 1), 0] // 4 if len(packed) else np.zeros(m, np.int64)).astype(np.int32), mask=~has)
        tail = pa.array((packed[np.maximum(bound[1:] - 1, 0), 0] // 4 if len(packed) else np.zeros(m, np.int64)).astype(np.int32), mask=~has)
        yield pa.record_batch([conv.take(pa.array(first)),
                               pa.array([packed[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:], strict=True)], pa.binary()),
                               *[pa.array(out[c]) for c in ("blank", "duplicate", "truncated", "illegal")],
                               pa.array(turns.astype(np.int64)), edge(lo), edge(hi - 1), lead, tail], schema=schema)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _report(conv, pieces: list[dict]) -> dict:
    """One conversation, from its pieces in order."""
    out = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal")}
    runs, last, last_turn, turns = [], None, None, 0
    for p in pieces:
        if p["first_class"] is not None:
            if last is not None and not _LEGAL[last, p["first_class"]]:
                out["illegal"] += 1
            last = p["last_class"]
        if p["low"] is not None:
            turns += p["turns"] - (p["low"] == last_turn)       # a turn may straddle two pieces
            last_turn = p["high"]
        for symbol, count in np.frombuffer(p["runs"], np.int64).reshape(-1, 2).tolist():
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += count
            else:
                runs.append([symbol, count])
    seen = [p for p in pieces if p["low"] is not None]
    gaps = seen[-1]["high"] - seen[0]["low"] + 1 - turns if seen else 0
    cost, audit = repair([tuple(r) for r in runs])
    return {"conv_id": conv, "gaps": gaps, **out, "cost": cost, "audit": audit}


def _reports(batches, schema: pa.Schema):
    """Sorted pieces in, one row per conversation out."""
    conv, held, done = None, [], []
    for batch in batches:
        for p in batch.to_pylist():
            if held and p["conv_id"] != conv:
                done.append(_report(conv, held))
                held = []
                if len(done) >= 1000:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done = []
            conv = p["conv_id"]
            held.append(p)
    if held:
        done.append(_report(conv, held))
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def audits(syms: DataFrame) -> DataFrame:
    """conv_id and the columns of ``REPORT`` of every conversation."""
    conv = syms.schema["conv_id"].dataType.simpleString()
    arrow = _arrow_type(syms)
    ordered = syms.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    pieces = ordered.mapInArrow(lambda it: _pieces(it, arrow), f"conv_id {conv}, {PIECE}")
    # pieces of one conversation in their order: places grow from piece to piece (rows of one turn may straddle two)
    numbered = pieces.withColumn("_part", F.monotonically_increasing_id())
    schema = pa.schema([("conv_id", arrow), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string())])
    sorted_pieces = numbered.repartition("conv_id").sortWithinPartitions("conv_id", "_part")
    return sorted_pieces.mapInArrow(lambda it: _reports(it, schema), f"conv_id {conv}, {REPORT}")


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema["conv_id"].dataType)


# ------------------------------------------------------------------- digests
def _digests(batches, schema: pa.Schema):
    """Sorted rows in (a conversation's audit first, then its texts), digests out."""
    done, conv, digest, audit, at, state, lines, open_ = [], None, None, "", 0, START, 0, False

    def line(role: str, text: str):
        nonlocal lines
        digest.update((("\n" if lines else "") + role + ":" + text).encode())
        lines += 1

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, NEXT_TURN[state]
            line("user" if state == USER else "assistant", "")

    def close():
        inserted()
        done.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "audit")]
        for c, role, text, copies, edit in zip(*cols, strict=True):
            if edit is not None:
                if open_:
                    close()
                conv, digest, audit, at, state, lines, open_ = c, hashlib.sha256(), edit, 0, START, 0, True
                continue
            for _ in range(copies):
                inserted()
                what = audit[at]
                at += 1
                if what == "R":
                    state = NEXT_TURN[state]
                    line("user" if state == USER else "assistant", text)
                elif what == "K":
                    state = SYSTEM if role[:1] == "s" else NEXT_TURN[state]
                    line(role, text)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done.clear()
    if open_:
        close()
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: damaged ``rows`` behind the audits ``found``, in order through one hash per conversation."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    texts = rows.filter("copies > 0").select("conv_id", F.lit(1).alias("kind"), *_place(), "text", "copies", F.lit(None).cast("string").alias("audit"))
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(False).alias("known"), F.lit(0).cast("long").alias("at"), F.lit("").alias("role"),
                         F.lit(b"").alias("hash"), F.lit("").alias("text"), F.lit(0).alias("copies"), "audit")
    arrow = _arrow_type(rows)
    schema = pa.schema([("conv_id", arrow), ("repaired_sha256", pa.string())])
    return (texts.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
            .mapInArrow(lambda it: _digests(it, schema), f"conv_id {conv}, repaired_sha256 string"))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, damaged first."""
    rows = damaged(conversations)
    found = stage(audits(symbols(rows)), "audits")
    digests = repaired_digests(rows, found).withColumnRenamed("conv_id", "_conv")
    return (found.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "inner")
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
