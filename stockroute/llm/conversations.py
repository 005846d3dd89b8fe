"""Conversation structure repair by Wagner-Fischer alignment to the turn grammar.

The initials of a sound conversation's roles spell ``(s?(ua)+)?``.  Turns are
aligned to the grammar's string of each feasible length with four edits: Keep
(0), Rerole to user or assistant (2), Delete (3; blank and repeated turns must
go), Insert an empty user or assistant turn (2); a truncated turn that stays
costs 1 more.  Read from the end, the strings of all lengths are one
alternating string cut at different places, with or without a system turn in
front, so one table of suffix costs holds the alignment to every length.
Ukkonen's band keeps the cells that an incumbent (a greedy repair) leaves open,
and the backtraces of all cheapest lengths are followed together to the audit
that is least in ASCII order.

Rows are read in the order turn (nulls first), role, SHA-256 of the text.
Nulls in role and text are one space; a null ``conv_id`` is a conversation of
its own.  An empty role fits no place of the grammar.  Rows equal in all
columns count as often as they occur.  An empty table gives an empty result;
further columns are ignored.

A conversation streams through one task in order, as its digest is sequential:
the task holds one byte a turn and the audit, never its texts.  Time is turns
times band, memory is band times the square root of the turns.  Repeated turns
are found by an aggregate over (conversation, role, digest of the text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroute.llm.staging import stage

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
#: Bits of a turn's code: the initial (0 system, 1 user, 2 assistant, 3 other) and its first fault.
S, U, A, OTHER, CUT, BLANK, AGAIN = 0, 1, 2, 3, 4, 8, 16
FAR = 1 << 40
ROLES = {U: "user", A: "assistant"}
AUDITS = ("conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string")


# ------------------------------------------------------------------ one conversation
def _incumbent(codes: np.ndarray) -> int:
    """Cost beyond the unavoidable of a greedy repair, or of deleting every turn."""
    want, extra, kept, only_system = U, 0, 0, False
    for c in codes[codes < BLANK].tolist():
        ini = c & 3
        if ini == S and not kept:
            only_system = True
        else:
            if ini != want:
                extra += INSERT
            if ini == want or ini not in (U, A):
                want = A if want == U else U
            only_system = False
        kept += 1
    extra += 2 * INSERT if only_system else INSERT if want == A else 0
    stay = codes[codes < BLANK]
    return min(extra, DELETE * len(stay) - TRUNCATED * int(np.count_nonzero(stay & CUT)))


class _Table:
    """Banded suffix costs: row i, place c is the cheapest alignment of the turns
    from i on to the last ``r = c - width + open[i]`` letters of ...uaua."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.n = codes, len(codes)
        self.must = codes >= BLANK
        self.open = np.concatenate([np.cumsum(~self.must[::-1])[::-1], [0]])
        self.width = _incumbent(codes) // 2          # each turn more or less costs two at least
        self.place = np.arange(2 * self.width + 1)
        self.block = max(64, isqrt(self.n))
        self.front = np.full(self.n + 1, FAR, np.int64)     # a system turn is still to come
        self.saved: dict[int, np.ndarray] = {}
        self._block: tuple[int, list[np.ndarray]] = (-1, [])
        row = np.where(self.letters(self.n) >= 0, INSERT * self.letters(self.n), FAR)
        self.saved[self.n] = row
        for i in range(self.n - 1, -1, -1):
            after, row = row, self._step(i, row)
            self.front[i] = DELETE + self.front[i + 1]
            if self.codes[i] & ~CUT == S:
                pairs = after[self.pairs(i + 1)]
                if len(pairs):
                    self.front[i] = min(self.front[i], self.stay(i) + int(pairs.min()))
            if i % self.block == 0:
                self.saved[i] = row

    def letters(self, i: int) -> np.ndarray:
        return self.place - self.width + self.open[i]

    def pairs(self, i: int) -> np.ndarray:
        """Places of row i where one or more whole pairs are left."""
        r = self.letters(i)
        return (r >= 2) & (r % 2 == 0)

    def fits(self, i: int) -> np.ndarray:
        """Where turn i has the role that its place asks for."""
        r, ini = self.letters(i), self.codes[i] & 3
        return (r >= 1) & (np.where(r % 2 == 1, A, U) == ini)

    def stay(self, i: int) -> int:
        return TRUNCATED if self.codes[i] & CUT else 0

    def _step(self, i: int, after: np.ndarray) -> np.ndarray:
        if self.must[i]:
            return np.minimum(after + DELETE, FAR)
        r = self.letters(i)
        cost = np.where(r >= 1, after + self.stay(i) + np.where(self.fits(i), 0, REROLE), FAR)
        cost[:-1] = np.minimum(cost[:-1], after[1:] + DELETE)
        cost[r < 0] = FAR
        return np.minimum(np.minimum.accumulate(cost - INSERT * self.place) + INSERT * self.place, FAR)

    def row(self, i: int) -> np.ndarray:
        """Row i; the rows of a block are made again from the saved one behind it."""
        if i == self.n:
            return self.saved[i]
        first = i // self.block * self.block
        if self._block[0] != first:
            last = min(first + self.block, self.n)
            rows = [self.saved[last]]
            for k in range(last - 1, first - 1, -1):
                rows.append(self._step(k, rows[-1]))
            self._block = (first, rows[::-1])
        return self._block[1][i - first]


def align(codes: bytes) -> tuple[int, str]:
    """The least cost of a repair, and of all repairs at that cost the least audit."""
    c = np.frombuffer(codes, np.uint8).astype(np.int64)
    t = _Table(c)
    start, even = t.row(0), t.letters(0) % 2 == 0
    left = min(int(start[even].min(initial=FAR)), int(t.front[0]))
    best, i, audit = left, 0, bytearray()
    live, front = even & (start == left), bool(t.front[0] == left)
    while i < t.n or left:
        here, after = t.row(i), t.row(i + 1) if i < t.n else None
        moves = []
        if i < t.n:
            moved = live if t.must[i] else np.concatenate([[False], live[:-1]])
            moves.append((b"D", DELETE, 1, moved & (after == left - DELETE),
                          front and t.front[i + 1] == left - DELETE))
        moves.append((b"I", INSERT, 0, np.concatenate([live[1:], [False]]) & (here == left - INSERT), False))
        if i < t.n and not t.must[i]:
            stay, fits = t.stay(i), t.fits(i)
            kept = live & fits & (after == left - stay)
            if front and c[i] & 3 == S:
                kept |= t.pairs(i + 1) & (after == left - stay)
            moves.append((b"K", stay, 1, kept, False))
            moves.append((b"R", REROLE + stay, 1,
                          live & ~fits & (t.letters(i) >= 1) & (after == left - REROLE - stay), False))
        for letter, cost, step, to, to_front in moves:
            if to_front or to.any():
                audit += letter
                left, i, live, front = left - cost, i + step, to, to_front
                break
        else:
            raise RuntimeError("no edit leads on")
    return best, audit.decode()


def _faults(codes: bytes) -> tuple[int, int, int, int]:
    """Blank, repeated and truncated turns, and neighbours that the grammar rules out."""
    c = np.frombuffer(codes, np.uint8)
    ini = c & 3
    a, b = ini[:-1], ini[1:]
    sound = ((a == S) & (b == U)) | ((a == U) & (b == A)) | ((a == A) & (b == U))
    return (int(np.count_nonzero(c & BLANK)), int(np.count_nonzero(c & AGAIN)),
            int(np.count_nonzero(c & CUT)), int(np.count_nonzero(~sound)))


# ------------------------------------------------------------------ whole tables
def _schema(kind: str, **columns: pa.DataType) -> pa.Schema:
    ids = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    return pa.schema([("conv_id", ids), *columns.items()])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def turns_of(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text (nulls: one space), copies: how often a row stands there."""
    c = conversations
    return c.select("conv_id", "turn", F.coalesce(c["role"], F.lit(" ")).alias("role"),
                    F.coalesce(c["text"], F.lit(" ")).alias("text"),
                    (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with seeded faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row
    (no copies are left), 1 empties its text, 2 removes its stops, 3 repeats it, 4 makes
    it the user's."""
    t = turns_of(conversations)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name) % 20
    return (t.withColumn("kind", kind)
            .withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
            .withColumn("copies", F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long"))
            .drop("kind"))


def _keyed(turns: DataFrame) -> DataFrame:
    return turns.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _coded(turns: DataFrame) -> DataFrame:
    """One narrow row for equal turns: conv_id, turn, role, digest, code, n, again (said earlier)."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    code = (F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)
            + F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(CUT))
    rows = (_keyed(turns).groupBy("conv_id", "turn", "role", "digest", code.alias("code"))
            .agg(F.sum("copies").alias("n")))
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"))
    earliest = (rows.where("n > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"),
                                            F.col("digest").alias("d")).agg(F.min(at).alias("earliest")))
    return (rows.join(earliest, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                      & (F.col("digest") == F.col("d")), "left")
            .select("conv_id", "turn", "role", "digest", "code", "n",
                    (~at.eqNullSafe(F.col("earliest"))).alias("again")))


def _audit(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, tuple[int, str]] = {}        # short conversations often share their codes
    out: list[tuple] = []
    conv, codes, turns, open_ = None, bytearray(), [], False

    def close() -> None:
        low, high, distinct, _ = turns or (0, -1, 0, None)
        key = bytes(codes)
        if key in known:
            cost, audit = known[key]
        else:
            cost, audit = align(key)
            if len(key) <= 64:
                if len(known) >= 100_000:
                    known.clear()
                known[key] = cost, audit
        out.append((conv, high - low + 1 - distinct, *_faults(key), cost, audit))

    for b in batches:
        for cid, turn, code, n, again in zip(*(b[c].to_pylist() for c in ("conv_id", "turn", "code", "n", "again"))):
            if not open_ or cid != conv:
                if open_:
                    close()
                    if len(out) >= 2000 or len(codes) > 1_000_000:
                        yield _batch(out, schema)
                        out.clear()
                conv, codes, turns, open_ = cid, bytearray(), [], True
            if not n:
                continue
            if turn is not None:
                if not turns:
                    turns = [turn, turn, 1, turn]
                elif turn != turns[3]:
                    turns = [turns[0], turn, turns[2] + 1, turn]
            repeat = code if code & BLANK else code & 3 | AGAIN
            codes.append(repeat if again else code)
            codes.extend(bytes([repeat]) * (n - 1))
    if open_:
        close()
    if out:
        yield _batch(out, schema)


def audits(turns: DataFrame) -> DataFrame:
    """Faults, least repair cost and audit of every conversation of ``turns``
    (``turns_of`` or ``damaged``); one without a row left has zeros and an empty audit."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        return _audit(batches, _schema(kind, **dict.fromkeys(counts, pa.int64()), audit=pa.string()))
    return (_coded(turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
            .mapInArrow(run, AUDITS.format(id=kind)))


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, role, text) of the repaired turns; an audit comes before its turns.
    After each conversation's last turn its place is None."""
    conv, audit, at, place, shift = None, None, 0, 0, 0

    def role_at(p: int) -> str:
        return ROLES[U if (p - shift) % 2 == 0 else A]

    for b in batches:
        for cid, kind, role, text, n in zip(*(b[c].to_pylist() for c in ("conv_id", "kind", "role", "text", "copies"))):
            if kind == 0:
                if audit is not None:
                    while at < len(audit):
                        yield conv, place, role_at(place), ""
                        at, place = at + 1, place + 1
                    yield conv, None, None, None
                conv, audit, at, place = cid, text, 0, 0
                shift = (len(text) - text.count("D")) % 2
                continue
            for _ in range(n):
                while audit[at] == "I":
                    yield conv, place, role_at(place), ""
                    at, place = at + 1, place + 1
                if audit[at] != "D":
                    yield conv, place, role if audit[at] == "K" else role_at(place), text
                    place += 1
                at += 1
    if audit is not None:
        while at < len(audit):
            yield conv, place, role_at(place), ""
            at, place = at + 1, place + 1
        yield conv, None, None, None


def _in_order(turns: DataFrame, found: DataFrame) -> DataFrame:
    rows = _keyed(turns.where("copies > 0")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest",
                                                    "text", "copies")
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
                         F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"),
                         F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    return (heads.unionByName(rows).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest"))


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(kind, place=pa.int64(), role=pa.string(), text=pa.string())
        rows, size = [], 0
        for r in _replay(batches):
            if r[1] is None:
                continue
            rows.append(r)
            size += len(r[3]) + 64
            if size > 4_000_000:
                yield _batch(rows, schema)
                rows, size = [], 0
        if rows:
            yield _batch(rows, schema)
    return _in_order(turns, found).mapInArrow(run, f"conv_id {kind}, place long, role string, text string")


def digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of each repaired conversation's ``role:text`` lines, as hex."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(kind, sha256=pa.string())
        rows, sha = [], hashlib.sha256()
        for conv, place, role, text in _replay(batches):
            if place is None:
                rows.append((conv, sha.hexdigest()))
                sha = hashlib.sha256()
                if len(rows) == 10_000:
                    yield _batch(rows, schema)
                    rows = []
            else:
                sha.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if rows:
            yield _batch(rows, schema)
    return _in_order(turns, found).mapInArrow(run, f"conv_id {kind}, sha256 string")


def repair_report(turns: DataFrame) -> DataFrame:
    """``audits`` plus ``repaired_sha256``, the digest of the repaired conversation."""
    found = stage(audits(turns), "audits")
    sums = digests(turns, found).select(F.col("conv_id").alias("c"), F.col("sha256").alias("repaired_sha256"))
    return found.join(sums, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
