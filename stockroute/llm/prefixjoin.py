"""Grouped prefix join: exact Jaccard links between documents of word n-grams.

A document is its set of distinct shingles (three lower-cased words by default;
a shorter text is one shingle of all its words).  Sets are put in one global order, rare
shingles first, and any two sets of similarity t or more share a shingle within
their first n - ceil(t n) + 1 (the prefix).

1.  Equal sets are one class; classes of equal size and prefix are one group.
2.  Groups meet in the lists of their prefix shingles.  In a first round each
    list only pairs its leading group with the others by their few shingles of
    least hash; the links found join the bulk of near-copy families.
3.  Families that stay apart in long lists are joined by rounds of chance: a class
    meets some others of its long lists in a seeded order, and links are verified.
    A round is linear in the classes; one with few links is the last.
4.  In the last round every list pairs all its groups whose components still
    differ, under the size and position filters and a lower bound on the
    difference of their sets (parities of 256 buckets travel along: two sets
    differ in at least as many shingles as in parities), so no link between
    different components can be missed.  Their prefixes then bound from above
    what two sets share.
5.  Group pairs are expanded to class pairs, pruned by an exact lower bound on
    the difference of the sets, and verified on the whole sets.

Links inside one component beyond those that connect it are not listed; the
components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroute.llm import wordscan as ws
from stockroute.llm.components import components
from stockroute.llm.staging import map_batches, release, small_batches, stage

SHINGLE = 3
PERCENT = 90
FREQUENT = 1 << 16          # shingles with a place of their own at the end of the order
CHUNK_SHINGLES = 4_000_000  # counted at a time for that
LEAD_TOKENS = 3             # shingles of a prefix, of least hash, for the first round and those of chance
BUCKETS = 64                # of the histogram that bounds the difference of two sets
PARITIES = 256              # bits that travel with the lists
_Q = [f"q{k}" for k in range(PARITIES // 64)]
BEFORE = 2                  # shingles before a place of a prefix that travel with the lists of the last round
_E = [f"e{k}" for k in range(BEFORE)]
LIST_ROWS = 400_000
LONG_LIST = 64              # classes of a list that takes part in the rounds of chance
CHANCE_MATES = (8, 32)     # others that a class meets in each of them
CHANCE_BLOCK = 4096
CHANCE_YIELD = 8            # a round of chance with fewer links than 1 for so many rows is the last
FEW_ROUNDS = 1              # of components that only spare the last round some pairs
FILE_ROWS = 50_000          # documents for each file of a table
LEAST = -(1 << 63)


def shingle_rows(w: ws.Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Document (in the block) and hash of every shingle, repeated ones included."""
    g = ws.grams(w.hashes, k)
    valid = ws.whole_grams(w.bounds, k)
    doc = w.doc_of_word()[:len(valid)][valid]
    g = g[valid]
    n = np.diff(w.bounds)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = ws.sequence_keys(w.hashes, w.bounds)[0][short] + np.uint64(1)
        doc, g = np.concatenate([doc, short]), np.concatenate([g, whole])
    return doc, g


def _distinct(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, key) pairs in order."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]


def _frequent(chunk: int, shingle: int):
    """Shingles that several documents of a chunk hold, with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            g = np.concatenate(held)
            held.clear()
            g.sort()                    # in place: a chunk is large
            new = np.ones(len(g), bool)
            new[1:] = g[1:] != g[:-1]
            at = np.flatnonzero(new[:-3] & (g[3:] == g[:-3]))
            n = np.searchsorted(g, g[at], side="right") - at
            return pa.record_batch([pa.array(g[at].view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])
        for b in batches:
            for w in ws.scan(b["text"], lower=True):
                g = _distinct(*shingle_rows(w, shingle))[1]
                held.append(g)
                size += len(g)
                if size >= chunk:
                    yield counted()
                    size = 0
        if size:
            yield counted()
    return run


class Order:
    """Global order of shingles: by hash, but the most frequent ones last by count."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        at = np.argsort(keys)
        self.keys = keys[at]
        self.level = np.log2(np.maximum(counts[at], 1)).astype(np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def rank(self, g: np.ndarray) -> np.ndarray:
        out = g >> np.uint64(1)
        some = np.flatnonzero(self.maybe[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(some) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, g[some]), len(self.keys) - 1)
            hit = self.keys[at] == g[some]
            some, at = some[hit], at[hit]
            out[some] = (np.uint64(1) << np.uint64(63)) | (self.level[at] << np.uint64(57)) | (g[some] >> np.uint64(7))
        return out


def prefix_sizes(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


_SKETCH = ("doc_id long, n long, s0 long, s1 long, p0 long, prefix array<long>, lead array<long>, histogram binary, "
           + ", ".join(f"{q} long" for q in _Q))


def _least_hashed(doc: np.ndarray, key: np.ndarray, docs: int) -> pa.ListArray:
    """The LEAD_TOKENS keys of least hash of each document."""
    at = np.lexsort((ws.mix(key), doc))
    cut = np.searchsorted(doc, np.arange(docs + 1))
    some = np.minimum(np.diff(cut), LEAD_TOKENS)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some)]).astype(np.int32)),
                                    pa.array(key[at][ws.ranges(cut[:-1], some)].view(np.int64)))


def _sketch(order: Order, percent: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in ws.scan(b["text"], lower=True):
                doc, g = shingle_rows(w, shingle)
                doc, key = _distinct(doc, order.rank(g))
                cut = np.searchsorted(doc, np.arange(w.docs + 1))
                n = np.diff(cut)
                total = []
                for seed in (0xA4093822299F31D0, 0x082EFA98EC4E6C89):
                    t = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ws.mix(key ^ np.uint64(seed)), dtype=np.uint64)])
                    total.append(t)
                p = prefix_sizes(n, percent)
                places = ws.ranges(cut[:-1], p)
                p_end = cut[:-1] + p
                hist = np.bincount(doc * BUCKETS + (ws.mix(key) % np.uint64(BUCKETS)).astype(np.int64),
                                   minlength=w.docs * BUCKETS)
                odd = np.bincount(doc * PARITIES + (ws.mix(key ^ np.uint64(0x9216D5D98979FB1B))
                                                    % np.uint64(PARITIES)).astype(np.int64),
                                  minlength=w.docs * PARITIES) & 1
                odd = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(w.docs, -1)
                hist = np.minimum(hist, 255).astype(np.uint8).tobytes()
                yield pa.record_batch(
                    [b["doc_id"].slice(w.first, w.docs), pa.array(n),
                     *[pa.array((t[cut[1:]] - t[cut[:-1]]).view(np.int64)) for t in total],
                     pa.array((total[0][p_end] - total[0][cut[:-1]]).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(p)]).astype(np.int32)),
                                              pa.array(key[places].view(np.int64))),
                     _least_hashed(doc[places], key[places], w.docs),
                     pa.array([hist[i:i + BUCKETS] for i in range(0, len(hist), BUCKETS)], pa.binary()),
                     *[pa.array(np.ascontiguousarray(odd[:, k])) for k in range(len(_Q))]],
                    names=["doc_id", "n", "s0", "s1", "p0", "prefix", "lead", "histogram", *_Q])
    return run


@dataclass
class Lists:
    """Rows of whole lists in order: a group's place in the list of one shingle."""
    token: np.ndarray
    gid: np.ndarray
    n: np.ndarray
    pos: np.ndarray
    tag: np.ndarray         # first round: copies; second: component, or LEAST
    odd: np.ndarray         # parities of the group's set
    single: np.ndarray      # whether the group has one set only
    before: np.ndarray      # shingles at the places before this one, nearest first (none: any value)

    def may_link(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Size, position and difference filters for rows of one list."""
        a, b = self.n[i], self.n[j]
        need = -(-percent * (a + b) // (100 + percent))
        ok = ((self.gid[i] != self.gid[j]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
              & (np.minimum(a - self.pos[i], b - self.pos[j]) >= need))
        at = np.flatnonzero(ok)
        apart = np.bitwise_count(self.odd[i[at]] ^ self.odd[j[at]]).sum(axis=1, dtype=np.int64)
        apart[~(self.single[i[at]] & self.single[j[at]])] = 0
        both = a[at] + b[at]
        ok[at] = 100 * (both - apart) >= percent * (both + apart)
        return ok

    def met_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs that surely met in an earlier list, as a shingle just before is the same."""
        met = np.zeros(len(i), bool)
        for a in range(self.before.shape[1]):
            for b in range(self.before.shape[1]):
                met |= (self.before[i, a] == self.before[j, b]) & (self.pos[i] > a) & (self.pos[j] > b)
        return met


def _by_lists(pairs, order: str, limit: int):
    """Apply ``pairs`` to rows sorted by token, in runs of whole lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
            c = {k: t[k].to_numpy() for k in ("token", "gid", "np", "tag")}
            # equal tags by chance, so that lists of one family have several leaders
            at = np.lexsort((ws.mix((c["gid"] ^ c["token"]).view(np.uint64)), -c["tag"], c["token"]) if order == "tag"
                            else (c["np"], c["token"]))
            odd = np.stack([t[q].to_numpy() for q in _Q], axis=1)[at].view(np.uint64)
            size = c["np"][at]
            before = [t[e].to_numpy()[at] for e in _E if e in t.column_names]
            before = np.stack(before, axis=1) if before else np.zeros((len(at), 0), np.int64)
            lists = Lists(c["token"][at], c["gid"][at], size >> 32, (size & 0xFFFFFFFF) >> 1,
                          c["tag"][at], odd, (size & 1) == 0, before)
            a, b = pairs(lists)
            if len(a):
                low, high = np.minimum(a, b), np.maximum(a, b)
                at = np.lexsort((high, low))
                low, high = low[at], high[at]
                new = np.ones(len(low), bool)
                new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
                yield pa.record_batch([pa.array(low[new]), pa.array(high[new])], names=["ga", "gb"])
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= limit:
                t = pa.Table.from_batches(held)
                k = t["token"].to_numpy()
                border = np.flatnonzero(k != k[-1])
                if len(border):
                    yield from solve(t.slice(0, int(border[-1]) + 1))
                    t = t.slice(int(border[-1]) + 1)
                held, size = t.to_batches(), t.num_rows
        if size:
            yield from solve(pa.Table.from_batches(held))
    return run


def _leader_pairs(percent: int):
    """The group of most copies of each list with all others."""
    def pairs(x: Lists):
        new = np.ones(len(x.token), bool)
        new[1:] = x.token[1:] != x.token[:-1]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        other = np.flatnonzero(~new)
        other = other[x.may_link(lead[other], other, percent)]
        return x.gid[lead[other]], x.gid[other]
    return pairs


def _open_pairs(percent: int):
    """Pairs of one list whose components differ; a tag of LEAST differs from all.

    Every list of a pair applies the same tests of size, component and parities, and the
    first one a test of position that no link fails.  So a list may leave out the pairs that
    have an earlier list, and most are found once instead of in all their lists.
    """
    def pairs(x: Lists):
        i = np.arange(len(x.token))
        out_a, out_b, lag = [x.gid[:0]], [x.gid[:0]], 1
        while len(i):
            i = i[i + lag < len(x.token)]
            j = i + lag
            near = (x.token[i] == x.token[j]) & (100 * x.n[i] >= percent * x.n[j])
            i = i[near]                     # sizes rise, so a failed one is done with
            apart = i[(x.tag[i] != x.tag[i + lag]) | (x.tag[i] == LEAST)]
            apart = apart[x.may_link(apart, apart + lag, percent)]
            apart = apart[~x.met_before(apart, apart + lag)]
            out_a.append(x.gid[apart])
            out_b.append(x.gid[apart + lag])
            lag += 1
        return np.concatenate(out_a), np.concatenate(out_b)
    return pairs


def _histogram_fits(percent: int):
    """Keep pairs whose histograms leave enough room for the shared shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h = [np.frombuffer(b"".join(b[c].to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int64)
                 for c in ("ha", "hb")]
            both = b["na"].to_numpy() + b["nb"].to_numpy()
            apart = np.abs(h[0] - h[1]).sum(axis=1)         # at most the size of the difference
            ok = 100 * (both - apart) >= percent * (both + apart)
            yield pa.record_batch([b["a"], b["b"]], names=["a", "b"]).filter(pa.array(ok))
    return run


def _prefix_fits(percent: int):
    """Keep pairs whose prefixes share enough, whatever the rest holds.

    Shared shingles up to the end of the prefix that ends first are in both prefixes; of
    those behind it there are at most as many as either set has there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y, a, z in zip(b["pa"], b["pb"], b["na"].to_pylist(), b["nb"].to_pylist()):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                end = min(x[-1], y[-1])
                i, j = int(np.searchsorted(x, end, "right")), int(np.searchsorted(y, end, "right"))
                both = np.sort(np.concatenate([x[:i], y[:j]]), kind="stable")
                most = int((both[1:] == both[:-1]).sum()) + min(a - i, z - j)
                ok.append((100 + percent) * most >= percent * (a + z))
            yield pa.record_batch([b["ga"], b["gb"]], names=["ga", "gb"]).filter(pa.array(ok, pa.bool_()))
    return run


def _sets(order: Order, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in ws.scan(b["text"], lower=True):
                doc, g = shingle_rows(w, shingle)
                doc, key = _distinct(doc, order.rank(g))
                cut = np.searchsorted(doc, np.arange(w.docs + 1))
                raw = key.tobytes()
                yield pa.record_batch(
                    [b["doc_id"].slice(w.first, w.docs),
                     pa.array([raw[8 * i:8 * j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary())],
                    names=["cid", "keys"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b["ka"], b["kb"]):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                ok.append(100 * inter >= percent * (len(both) - inter))
            yield pa.record_batch([b["a"], b["b"]], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, percent: int = PERCENT, frequent: int = FREQUENT,
                    chunk: int = CHUNK_SHINGLES, list_rows: int = LIST_ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id for every document.

    class_id is the least doc_id with an equal set, component_id the least that
    links reach.  Null and empty texts have no shingle, and no link; a null
    doc_id counts as the least one and stays null.  Rows that repeat a doc_id
    are one node.  An empty table gives no rows.
    """
    src = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LEAST)).alias("doc_id"),
                      docs["text"].alias("text"))
    top = (map_batches(src, _frequent(chunk, shingle), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "key").limit(frequent))
    with small_batches(docs.sparkSession):
        top = top.toPandas()
    order = Order(top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64))
    sketch = stage(map_batches(src, _sketch(order, percent, shingle), _SKETCH), "join-sketch")
    # few rows aren't written in a file for every partition of a shuffle
    files = max(docs.sparkSession.sparkContext.defaultParallelism, sketch.count() // FILE_ROWS)
    same = ["s0", "s1", "n"]
    one = sketch.where("n > 0")
    classes = stage(one.groupBy(*same).agg(F.min(F.struct("doc_id", "p0", "prefix", "lead", "histogram", *_Q)).alias("m"),
                                           F.count("*").alias("copies"))
                    .select(*same, F.col("m.doc_id").alias("cid"), "m.p0", "m.prefix", "m.lead", "m.histogram",
                            *[f"m.{q}" for q in _Q], "copies").coalesce(files),
                    "join-classes")
    groups = (classes.groupBy("n", "p0").agg(F.min(F.struct("cid", "prefix", "lead", *_Q)).alias("m"),
                                             F.max("copies").alias("weight"), F.count("*").alias("members"))
              .select("n", "p0", F.col("m.cid").alias("gid"), "m.prefix", "m.lead", "weight", "members",
                      *[f"m.{q}" for q in _Q]))
    groups = stage(groups.coalesce(files), "join-groups")
    members = stage(classes.join(groups.select("n", "p0", "gid"), ["n", "p0"])
                    .select("cid", "gid", "n", "copies", "histogram").coalesce(files), "join-members")
    rows_of = stage(sketch.select("doc_id", "n", "s0", "s1"), "join-rows")
    named = stage(classes.select(*same, "cid"), "join-named")
    release(sketch, classes)

    def postings(of: DataFrame, places, tag, before: int = 0) -> DataFrame:
        # without the shingles before it a place tells nothing, and is 0
        place = F.transform(places, lambda x, i: F.struct(
            (i if before else F.lit(0)).alias("pos"), x.alias("token"),
            *[F.coalesce(F.get(places, i - 1 - k), F.lit(0)).alias(_E[k]) for k in range(before)]))
        rows = of.select("gid", "n", "members", tag.alias("tag"), *_Q, F.inline(place))
        # size, place, and whether the group has several sets (and so no histogram of its own)
        packed = F.shiftleft("n", 32) + F.col("pos") * 2 + (F.col("members") > 1).cast("long")
        return (rows.select("token", "gid", packed.alias("np"), "tag", *_Q, *_E[:before])
                .repartition("token").sortWithinPartitions("token"))

    def fitting(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("ga").alias("gid")).unionByName(pairs.select(F.col("gb").alias("gid")))
        held = stage(groups.select("gid", "n", "prefix").join(ends, "gid", "left_semi"), "join-prefixes")
        side = lambda k: held.select(F.col("gid").alias("g" + k), F.col("n").alias("n" + k), F.col("prefix").alias("p" + k))
        out = stage(map_batches(pairs.join(side("a"), "ga").join(side("b"), "gb"), _prefix_fits(percent),
                                "ga long, gb long"), "join-fitting")
        release(pairs, held)
        return out

    def links(pairs: DataFrame) -> DataFrame:
        side = lambda k: members.select(F.col("cid").alias(k), F.col("n").alias("n" + k), F.col("histogram").alias("h" + k))
        both = (pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct().join(side("a"), "a").join(side("b"), "b"))
        close = stage(map_batches(both, _histogram_fits(percent), "a long, b long").coalesce(files), "join-close")
        needed = close.select(F.col("a").alias("cid")).unionByName(close.select(F.col("b").alias("cid")))
        texts = src.join(needed, src["doc_id"] == needed["cid"], "left_semi").dropDuplicates(["doc_id"])
        sets = stage(map_batches(texts.coalesce(files), _sets(order, shingle), "cid long, keys binary"), "join-sets")
        whole = (close.join(sets.select(F.col("cid").alias("a"), F.col("keys").alias("ka")), "a")
                 .join(sets.select(F.col("cid").alias("b"), F.col("keys").alias("kb")), "b"))
        found = stage(map_batches(whole, _verify(percent), "u long, v long"), "join-links")
        release(close, sets)
        return found

    lone = F.lit(LEAST)
    most = F.struct((-F.col("copies")).alias("few"), "cid")
    lead = stage(members.groupBy("gid").agg(F.min(most).alias("l")).select("gid", F.col("l.cid").alias("lead"))
                 .coalesce(files), "join-leads")
    # first round: leading groups of each list; leading classes of both sides
    # a prefix starts with what only its own text holds, and changes move its places: near
    # copies rather share its shingles of least hash
    first = (map_batches(postings(groups, F.col("lead"), F.col("weight")),
                         _by_lists(_leader_pairs(percent), "tag", list_rows), "ga long, gb long").distinct().coalesce(files))
    first = stage(first, "join-first")
    m = members.select("gid", "cid")
    inside = m.join(lead, "gid").select(F.col("lead").alias("a"), F.col("cid").alias("b"))
    cross = [first.join(lead, F.col(x) == F.col("gid")).drop("gid").join(m, F.col(y) == F.col("gid"))
             .select(F.col("lead").alias("a"), F.col("cid").alias("b")) for x, y in (("ga", "gb"), ("gb", "ga"))]
    edges = links(inside.unionByName(cross[0]).unionByName(cross[1]))
    comp = components(edges, "join-components", FEW_ROUNDS, files).select(F.col("node").alias("cid"), "component")
    known = stage(members.join(comp, "cid", "left")
                  .select("cid", "gid", F.coalesce("component", "cid").alias("component")).coalesce(files), "join-known")
    # rounds of chance: each class in a few of its lists, if they are long and have several components
    span = known.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    tokens = groups.join(span, "gid").select("gid", "members", "low", "high", F.explode("lead").alias("token"))
    long_ = (tokens.groupBy("token").agg(F.sum("members").alias("rows"), F.min("low").alias("low"),
                                         F.max("high").alias("high"))
             .where((F.col("rows") > LONG_LIST) & (F.col("low") < F.col("high"))).select("token", "rows"))
    posts = stage(tokens.select("gid", "token").join(long_, "token").join(members.select("cid", "gid", "n"), "gid")
                  .select("cid", "n", "token", "rows").coalesce(files), "join-long")
    many = posts.count()
    for turn, most_mates in enumerate(CHANCE_MATES if many else ()):
        place = F.xxhash64("cid", F.lit(turn))
        dealt = posts.join(known.select("cid", "component"), "cid").select(
            "cid", "n", "component", "token", place.alias("place"),
            F.pmod(place, F.ceil(F.col("rows") / CHANCE_BLOCK)).alias("block"))
        ahead = Window.partitionBy("token", "block").orderBy("place", "cid").rowsBetween(1, most_mates)
        mates = F.filter(F.collect_list(F.struct("cid", "n", "component")).over(ahead),
                         lambda x: x["component"] != F.col("component"))
        met = (dealt.withColumn("mates", mates).select("cid", "n", "component", F.explode("mates").alias("x"))
               .where((F.col("component") != F.col("x.component"))
                      & (100 * F.least("n", "x.n") >= percent * F.greatest("n", "x.n")))
               .select(F.col("cid").alias("a"), F.col("x.cid").alias("b")))
        new = links(met)
        edges = edges.unionByName(new)
        if new.count() * CHANCE_YIELD < many:
            break
        of = known.select("cid", "component")
        joined = (new.join(of.select(F.col("cid").alias("u"), F.col("component").alias("cu")), "u")
                  .join(of.select(F.col("cid").alias("v"), F.col("component").alias("cv")), "v")
                  .select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        merged = components(joined, "join-chance", FEW_ROUNDS, files).select(F.col("node").alias("component"), F.col("component").alias("to"))
        before = known
        known = stage(before.join(merged, "component", "left")
                      .select("cid", "gid", F.coalesce("to", "component").alias("component")).coalesce(files), "join-known")
        release(before)
    release(posts)
    # last round: whatever could still join two components
    state = known.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    state = state.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(lone).alias("comp"))
    second = (map_batches(postings(groups.join(state, "gid"), F.col("prefix"), F.col("comp"), BEFORE),
                          _by_lists(_open_pairs(percent), "size", list_rows), "ga long, gb long").distinct().coalesce(files))
    second = fitting(stage(second, "join-second"))
    k = known.select(F.col("gid").alias("g"), "cid", "component")
    wide = (second.join(k.select(F.col("g").alias("ga"), F.col("cid").alias("a"), F.col("component").alias("ca")), "ga")
            .join(k.select(F.col("g").alias("gb"), F.col("cid").alias("b"), F.col("component").alias("cb")), "gb")
            .where("ca <> cb").select("a", "b"))
    mixed = state.where(F.col("comp") == lone).select("gid")
    own = known.join(mixed, "gid")
    inner = (own.select("gid", F.col("cid").alias("a"), F.col("component").alias("ca"))
             .join(own.select("gid", F.col("cid").alias("b"), F.col("component").alias("cb")), "gid")
             .where("a < b and ca <> cb").select("a", "b"))
    more = links(wide.unionByName(inner))
    comp = components(edges.unionByName(more), "join-components", files=files).select(F.col("node").alias("cid"), "component")
    release(groups, members, known, first, second, lead)
    of_class = stage(named.join(comp, "cid", "left")
                     .select(*same, "cid", F.coalesce("component", "cid").alias("component")), "join-result")
    out = rows_of.join(of_class, same, "left")
    show = lambda c: F.when(c != lone, c)
    return out.select(
        show(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        show(F.coalesce("cid", "doc_id")).alias("class_id"),
        show(F.coalesce("component", "doc_id")).alias("component_id"))
