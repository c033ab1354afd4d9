"""Conversation repair against a plain-Python search over whole edit lists."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscan.llm import conversations as C

GAP = " \t\n\x0b\f\r"


def brute_damage(rows):
    """rows (conv_id, turn, role, text) -> {conv_id: [(turn, role, text)]} in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        word = lambda v: " " if v is None else str(v)
        c = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        if c == 1:
            text = ""
        if c == 2:
            text = "".join(x for x in text if x not in ".!?")
        if c == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if c == 0 else 2 if c == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults_of(turns):
    out, seen = [], set()
    for _, role, text in turns:
        bare = text.strip(GAP)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def least_audit(initials, faults):
    """(cost, audit) of the cheapest edits, least in ASCII, by comparing whole audits."""
    grammar = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    new = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(best):
        for _ in range(3):
            best = {q: min(best[q], (best[new[q]][0] + 2, "I" + best[new[q]][1])) for q in best}
        return best
    best = inserted({0: (0, ""), 1: (10 ** 9, ""), 2: (10 ** 9, ""), 3: (0, "")})
    for initial, fault in zip(initials[::-1], faults[::-1]):
        step = {}
        for q in range(4):
            ways = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (q, initial) in grammar:
                    to = best[grammar[q, initial]]
                    ways.append((to[0] + more, "K" + to[1]))
                ways.append((best[new[q]][0] + 2 + more, "R" + best[new[q]][1]))
            step[q] = min(ways)
        best = inserted(step)
    return best[0]


def repair(turns, audit):
    state, left, out = 0, list(turns), []
    for edit in audit:
        _, role, text = (None, None, "") if edit == "I" else left.pop(0)
        if edit == "D":
            continue
        if edit == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        else:
            state = 3 if state == 2 else 2
            role = "assistant" if state == 3 else "user"
        out.append((role, text))
    assert not left
    return out


def brute(rows):
    out = {}
    for conv, turns in brute_damage(rows).items():
        faults = faults_of(turns)
        cost, audit = least_audit([r[:1] for _, r, _ in turns], faults)
        numbers = [t for t, _, _ in turns if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                     *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repair(turns, audit)).encode()).hexdigest())
    return out


def found(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumns({"ck": F.lit("x"), "part": F.lit(3), "code": F.lit("c"), "kind": F.lit(1)})
    out = {}
    for r in C.digests(C.damaged(table)).collect():
        assert r.conv_id not in out
        out[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
    return out


def made(seed, conversations, longest, texts):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "umpire"]
    rows = []
    for conv in range(conversations):
        for turn in range(rnd.randint(1, longest)):
            rows.append((conv if conv else None, rnd.choice([turn, turn, turn, 2 * turn, None]),
                         rnd.choice(roles[:rnd.choice([3, 5, 10])]), rnd.choice(texts)))
    rnd.shuffle(rows)
    return rows


TEXTS = ["one.", "two!", "three", "four? \n", " \t", "", None, "five.", "six .", "seven…", "eight.\x1f", "🙂.", "nine!"]


def test_repair_equals_brute_force(spark):
    rows = made(1, 150, 14, TEXTS + [f"text {i}." for i in range(40)])
    rows += rows[:60]                                     # repeated rows
    assert found(spark, rows) == brute(rows)


def test_conversation_over_many_partitions(spark):
    """One long conversation with every kind of fault, and identical rows by the hundred."""
    rows = made(2, 2, 900, TEXTS + [f"text {i}." for i in range(3000)]) + made(3, 60, 5, TEXTS)
    rows += [(1, 5, "user", "again and again")] * 300
    rows = [(1 if r[0] is None else r[0], *r[1:]) for r in rows]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")   # else these few rows share a partition
    try:
        assert C.audits(C.damaged(table)).where("ck = '1'").count() > 1
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.unset(coalesce)


def test_all_dropped_and_empty(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, turn, "user", "x."), (8, None, None, None)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert got[7] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.digests(C.damaged(empty)).count() == 0 and C.repaired(C.damaged(empty)).count() == 0


def test_repaired_turns_are_legal_and_hash_alike(spark):
    rows = made(4, 60, 9, TEXTS)
    table = C.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by_conv = {}
    for r in C.repaired(table).orderBy("conv_id", "place").collect():
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text))
    expected = brute(rows)
    for conv, want in expected.items():
        turns = by_conv.get(conv, [])
        initials = "".join(r[0] for r, _ in turns)
        assert initials.lstrip("s") == "ua" * (len(initials.lstrip("s")) // 2) and initials.count("s") <= 1
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest() == want[-1]


@pytest.mark.parametrize("seed", range(6))
def test_blocks_and_segments_agree_with_one_piece(monkeypatch, seed):
    """Cutting a conversation in segments and blocks changes nothing."""
    monkeypatch.setattr(C, "BLOCK", 7)
    rnd = np.random.default_rng(seed)
    codes = rnd.integers(0, 16, 60).astype(np.uint8)
    initials = ["sua?"[c % 4] for c in codes]
    faults = [["", "truncated", "blank", "duplicate"][c // 4] for c in codes]
    cost, audit = least_audit(initials, faults)
    (ways, total), = C.solve([codes], [None], [True], [True])
    assert (total, ways[0][0].decode()) == (cost, audit)
    cuts = [0, 11, 12, 40, 60]
    parts = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
    behind, tables = C.AT_END, []
    for part in parts[::-1]:
        tables.append(behind.tolist())
        table = np.where(np.eye(4, dtype=bool), 0, C.NEVER)[None]
        for at, _, new in C._backwards([part], table):
            table = new
        behind = (table[0] + behind[:, None]).min(axis=0)
    solved = C.solve(parts, tables[::-1], [False] * 3 + [True], [True] + [False] * 3)
    state, spelled = 0, b""
    for ways, _ in solved:
        letters, state = ways[state]
        spelled += letters
    assert spelled.decode() == audit


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in C.op13_repair(spark, path).collect()}
    assert got == brute(rows)
