"""Conversation repair against an exhaustive alignment."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

from stockroute.llm import conversations as cv

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(turns):
    """[(initial, must go, truncated)] -> (cost, audit) over every target length."""
    def solve(target):
        @lru_cache(None)
        def f(i, j):
            if i == len(turns) and j == len(target):
                return 0, ""
            ways = []
            if j < len(target) and target[j] != "s":
                c, a = f(i, j + 1)
                ways.append((c + 2, "I" + a))
            if i < len(turns):
                initial, must, cut = turns[i]
                c, a = f(i + 1, j)
                ways.append((c + 3, "D" + a))
                if not must and j < len(target):
                    c, a = f(i + 1, j + 1)
                    if initial == target[j]:
                        ways.append((c + cut, "K" + a))
                    if target[j] != "s":
                        ways.append((c + 2 + cut, "R" + a))
            return min(ways, default=(10 ** 9, ""))
        return f(0, 0)
    lengths = range(1, len(turns) + 3)
    return min(solve(t) for t in ["", *["ua" * k for k in lengths], *["s" + "ua" * k for k in lengths]])


def report(rows):
    """Rows (conv_id, turn, role, text) -> the report's rows, by plain Python."""
    text = lambda x: " " if x is None else str(x)
    by_conv = defaultdict(list)
    for cid, turn, role, said in rows:
        kept = by_conv[cid]
        role, said = text(role), text(said)
        kind = zlib.crc32(f"{text(cid)}:{text(turn)}".encode()) % 20
        if kind == 1:
            said = ""
        if kind == 2:
            said = re.sub("[.!?]", "", said)
        if kind == 4:
            role = "user"
        kept += [(turn, role, said)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for cid, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults, turns = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, said in kept:
            marks = VISIBLE.findall(said)
            fault = ("blank" if not marks else "duplicate" if (role, said) in seen
                     else "truncated" if marks[-1] not in ".!?" else None)
            seen.add((role, said))
            if fault:
                faults[fault] += 1
            turns.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, audit = cheapest(tuple(turns))
        length = len(audit) - audit.count("D")
        roles = (["system"] if length % 2 else []) + ["user", "assistant"] * (length // 2)
        lines, rest = [], iter(kept)
        for letter in audit:
            if letter == "I":
                lines.append(f"{roles[len(lines)]}:")
                continue
            _, role, said = next(rest)
            if letter == "K":
                lines.append(f"{role}:{said}")
            elif letter == "R":
                lines.append(f"{roles[len(lines)]}:{said}")
        numbers = {r[0] for r in kept if r[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out.append((cid, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def test_alignment_equals_exhaustive_search():
    rnd = random.Random(5)
    for _ in range(400):
        codes = bytes(rnd.randrange(4) + rnd.choice([0, 0, 0, cv.CUT, cv.BLANK, cv.AGAIN])
                      for _ in range(rnd.randrange(9)))
        turns = tuple(("sua?"[c & 3], c >= cv.BLANK, int(bool(c & cv.CUT))) for c in codes)
        assert cv.align(codes) == cheapest(turns), codes


def test_rows_of_blocks_are_those_of_one_table():
    rnd = random.Random(6)
    codes = bytes(rnd.choice([1, 2]) if rnd.random() < 0.3 else 1 + k % 2 for k in range(200))
    table = cv._Table(cv.np.frombuffer(codes, cv.np.uint8).astype(int))
    assert table.block < 200 and [len(table.row(i)) for i in range(201)] == [2 * table.width + 1] * 201
    turns = tuple(("sua?"[c & 3], False, 0) for c in codes[:40])
    assert cv.align(codes[:40]) == cheapest(turns)


def _odd_rows():
    rnd, rows = random.Random(7), []
    for cid in [*range(150), None]:
        for turn in range(rnd.randrange(1, 8)):
            role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.2 else ["user", "assistant"][turn % 2]
            said = rnd.choice(["Yes.", "No", "Why?\n", "  ", "", None, "Ünd!", f"number {rnd.randrange(9)}."])
            rows.append((cid, turn, "system" if turn == 0 and rnd.random() < 0.3 else role, said))
    rows += [(200, None, "user", "a."), (200, None, None, "b."), (200, 3, "", "c."), (201, 5, "tool", "x" * 40_000),
             (202, 1, "user", "same."), (202, 1, "user", "same."), (202, 1, "assistant", "same."), (202, 9, "user", "z")]
    # every row of these is dropped
    gone = [(c, t) for c in range(300, 400) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    return rows + [(c, t, "user", "gone.") for c, t in gone]


def test_report_equals_plain_python(spark):
    rows = _odd_rows()
    docs = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], TURNS + ", copies int, kind string, n int")
    got = sorted((tuple(r) for r in cv.repair_report(cv.damaged(docs)).select(*COLUMNS).collect()), key=repr)
    assert got == report(rows)


def test_report_on_the_test_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/conversations.parquet")
    rows = [tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in cv.repair_report(cv.damaged(docs)).select(*COLUMNS).collect()), key=repr)
    assert got == report(rows)


def test_repaired_turns_follow_the_grammar(spark):
    docs = spark.createDataFrame(_odd_rows(), TURNS)
    turns = cv.damaged(docs)
    found = cv.audits(turns)
    spelled = defaultdict(dict)
    for r in cv.repaired(turns, found).collect():
        spelled[r["conv_id"]][r["place"]] = r["role"][0]
    for places in spelled.values():
        assert sorted(places) == list(range(len(places)))
        assert re.fullmatch("(s?(ua)+)?", "".join(places[p] for p in sorted(places)))


def test_undamaged_turns_and_empty_table(spark):
    sound = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello.")], TURNS)
    assert [(r["cost"], r["audit"]) for r in cv.audits(cv.turns_of(sound)).collect()] == [(0, "KK")]
    assert cv.repair_report(cv.damaged(spark.createDataFrame([], TURNS))).collect() == []


def test_long_conversation_of_one_role():
    assert cv.align(bytes([cv.U]) * 500) == (500, "KR" * 250)
    assert cv.align(b"") == (0, "")
