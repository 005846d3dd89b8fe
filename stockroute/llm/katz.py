"""Language-model scores by Katz backoff over word pairs.

A token is predicted from the one before it (a start mark for the first).  With
r = count(h, w) and Good-Turing discounts d(r) for r <= 5,

    p(w | h) = d(r) r / count(h)          if r > 0
             = alpha(h) p(w)              if only h was seen
             = p(w)                       if h was not seen

and p(w) backs off in the same way to a uniform share for unseen words.  alpha
makes every distribution over the vocabulary and one unseen word sum to 1.
Larger counts keep 0.999 of themselves, so that each history leaves some mass.

No table of pairs is ever joined to the tokens.  All occurrences of a word meet
in one bucket, packed by pairs (words with over 1/512 of all tokens are spread
by their history, pairs with as many over all buckets, their counts sent
along).  There count(h, w), count(w) and p(w) are known, and a document's score
splits into sums over its tokens:

    seen pair:    log d(r) r   - kept as numbers of tokens by r until d is known
    any word:     - log count(word), on behalf of the token after it
    unseen pair:  log p(w), and log(alpha(h) count(h)), joined later by h
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.llm import wordscan as ws
from stockroute.llm.staging import map_batches, map_groups, release, stage

TOP = 5                     # counts up to this are discounted by Good-Turing
KEEP = 0.999                # of larger counts
HEAVY_PARTS = 512
CHUNK_TOKENS = 1_000_000    # packed at a time by a task
BUCKET_TOKENS = 1_600_000
ENTRY_RUN = 200_000         # entries of a bucket unpacked at a time
OUT_ROWS = 1 << 16          # of a batch sent back
START, END = np.uint64(1), np.uint64(2)
LEAST = -(1 << 63)


def held_out(doc_id, parts: int = 7, part: int = 2):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts)) == part, F.lit(False))


def tokens(w: ws.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, word and history of every token of a block, end marks included."""
    n = np.diff(w.bounds)
    out = np.full(len(w.hashes) + w.docs, END, np.uint64)
    doc = np.repeat(np.arange(w.docs), n + 1)
    is_word = np.ones(len(out), bool)
    is_word[np.cumsum(n + 1) - 1] = False
    out[is_word] = w.hashes
    history = np.empty_like(out)
    history[1:] = out[:-1]
    history[np.cumsum(n + 1) - (n + 1)] = START
    return doc, out, history


def _word_counts(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            key = np.concatenate(held)
            held.clear()
            key.sort()                  # in place: no copy of the chunk beside it
            at = np.flatnonzero(_heads(key))
            return pa.record_batch([pa.array(key[at].view(np.int64)), pa.array(np.diff(np.append(at, len(key))))],
                                   names=["w", "c"])
        for b in batches:
            for w in ws.scan(b["text"], lower=True):
                t = tokens(w)[1]
                held.append(t)
                size += len(t)
                if size >= chunk:
                    yield counted()
                    size = 0
        if size:
            yield counted()
    return run


def discounts(n: list[int]) -> np.ndarray:
    """d(1) .. d(5) from the numbers n(1) .. n(6) of items seen r times (Katz).

    Where the numbers don't give a discount within (0, 1), (r - 0.5) / r is used.
    """
    out = np.array([(r - 0.5) / r for r in range(1, TOP + 1)])
    if n[0] > 0:
        a = (TOP + 1) * n[TOP] / n[0]
        for r in range(1, TOP + 1):
            if n[r - 1] > 0 and a < 1:
                d = ((r + 1) * n[r] / (r * n[r - 1]) - a) / (1 - a)
                if 0 < d < 1:
                    out[r - 1] = d
    return out


def pair_keys(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    return ws.mix(w * np.uint64(0x9E3779B97F4A7C15) + ws.mix(h))


class Lookup:
    """Counts of a bounded list of keys; 0 for any other key."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


@dataclass
class Unigrams:
    n: int                      # training tokens
    types: int                  # distinct ones
    d: np.ndarray               # discounts of counts 1 .. 5
    unseen: float               # probability of the unseen word
    heavy: Lookup               # words with over 1 / HEAVY_PARTS of the tokens

    def p(self, c: np.ndarray) -> np.ndarray:
        keep = np.where(c <= TOP, np.append(0.0, self.d)[np.minimum(c, TOP)], KEEP)
        return np.where(c > 0, keep * c / max(1, self.n), self.unseen)


def unigrams(train: DataFrame, chunk: int) -> Unigrams:
    table = stage(map_batches(train, _word_counts(chunk), "w long, c long").groupBy("w").agg(F.sum("c").alias("c")),
                  "katz-words")
    s = table.agg(F.sum("c").alias("n"), F.count("*").alias("types"),
                  *[F.count(F.when(F.col("c") == r, 1)).alias(f"n{r}") for r in range(1, TOP + 2)]).first()
    n, of = s["n"] or 0, [s[f"n{r}"] for r in range(1, TOP + 2)]
    d = discounts(of)
    lost = sum(of[r - 1] * r * (1 - d[r - 1]) for r in range(1, TOP + 1))
    lost += (n - sum(of[r - 1] * r for r in range(1, TOP + 1))) * (1 - KEEP)
    heavy = table.where(F.col("c") * HEAVY_PARTS >= n).collect() if n else []   # at most HEAVY_PARTS rows
    release(table)
    return Unigrams(n, s["types"], d, lost / n if n else 1.0,
                    Lookup(np.array([r["w"] for r in heavy], np.int64).view(np.uint64),
                           np.array([r["c"] for r in heavy], np.int64)))


def _heavy_pairs(uni: Unigrams):
    """Counts of pairs of heavy words (or the start mark and one): a bounded table."""
    known = np.sort(np.append(uni.heavy.keys, START))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known) ** 2, np.int64)
        for b in batches:
            for w in ws.scan(b["text"], lower=True):
                _, word, history = tokens(w)
                at = [np.minimum(np.searchsorted(known, x), len(known) - 1) for x in (word, history)]
                both = (known[at[0]] == word) & (known[at[1]] == history)
                total += np.bincount(at[0][both] * len(known) + at[1][both], minlength=len(total))
        i = np.flatnonzero(total)
        yield pa.record_batch([pa.array(known[i // len(known)].view(np.int64)),
                               pa.array(known[i % len(known)].view(np.int64)), pa.array(total[i])],
                              names=["w", "h", "c"])
    return run


_PARTS = [("uid", np.int64), ("doc_id", np.int64), ("train", np.uint8), ("word", np.uint64), ("pairs", np.int32),
          ("history", np.uint64), ("entries", np.int32), ("doc", np.uint16), ("times", np.int32)]


def _dump(parts: list[np.ndarray]) -> bytes:
    sizes = np.array([len(p) for p in parts], np.int64)
    raw = b"".join([sizes.tobytes(), *[np.ascontiguousarray(p, t).tobytes() for p, (_, t) in zip(parts, _PARTS)]])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _load(packed) -> dict[str, np.ndarray]:
    size = int.from_bytes(packed.slice(0, 8).to_pybytes(), "little")
    raw = pa.decompress(packed.slice(8), size, "zstd")
    sizes = np.frombuffer(raw, np.int64, len(_PARTS))
    at, out = sizes.nbytes, {}
    for n, (name, t) in zip(sizes, _PARTS):
        out[name] = np.frombuffer(raw, t, n, at)
        at += out[name].nbytes
    return out


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _pack(buckets: int, uni: Unigrams, pairs: Lookup, chunk: int):
    """Occurrences by bucket: words, their histories, and the documents of each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size, n_docs = [], [], 0, 0

        def packed() -> Iterator[pa.RecordBatch]:
            history, word, doc = (np.concatenate([x.pop() for x in held]) for _ in range(3))
            held.clear()
            uid, doc_id, train = (np.concatenate(x) for x in zip(*docs))
            docs.clear()
            place = ws.mix(word)
            wide = uni.heavy(word) > 0
            place[wide] = pair_keys(word[wide], history[wide])
            some = np.flatnonzero(wide)
            all_over = some[pairs(place[some]) > 0]
            place[all_over] = np.uint64(int(uid[0]) & ((1 << 63) - 1))
            place %= np.uint64(buckets)
            bucket = place.astype(np.int32)
            del place, wide, some, all_over
            order = np.lexsort((doc, history, word, bucket))
            each = [doc, word, history, bucket]
            del doc, word, history, bucket
            for i in range(len(each)):          # one after the other: few copies at once
                each[i] = each[i][order]
            del order
            entry = np.flatnonzero(_heads(*each))
            times = np.diff(np.append(entry, len(each[0]))).astype(np.int32)
            for i in range(len(each)):
                each[i] = each[i][entry]
            doc, word, history, bucket = each
            del each, entry
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            for k in range(buckets):
                a, z = cut[k], cut[k + 1]
                if a == z:
                    continue
                w, h = word[a:z], history[a:z]
                pair = np.flatnonzero(_heads(w, h))
                lead = np.flatnonzero(_heads(w[pair]))
                here, d = np.unique(doc[a:z], return_inverse=True)
                raw = _dump([uid[here], doc_id[here], train[here], w[pair][lead],
                             np.diff(np.append(lead, len(pair))), h[pair],
                             np.diff(np.append(pair, z - a)), d, times[a:z]])
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([raw], pa.binary())],
                                      names=["bucket", "payload"])

        for b in batches:
            for w in ws.scan(b["text"], lower=True):
                for a in range(0, w.docs, 1 << 15):         # a document's number must fit 16 bits
                    z = min(w.docs, a + (1 << 15))
                    if size and (size >= chunk or n_docs + z - a > (1 << 16)):
                        yield from packed()
                        size = n_docs = 0
                    doc, word, history = tokens(w)
                    if (a, z) != (0, w.docs):
                        mine = (doc >= a) & (doc < z)
                        doc, word, history = doc[mine], word[mine], history[mine]
                    held.append([(doc - a + n_docs).astype(np.uint16), word, history])
                    rows = slice(w.first + a, w.first + z)
                    docs.append(tuple(np.asarray(b[c].to_numpy(zero_copy_only=False))[rows]
                                      for c in ("uid", "doc_id", "train")))
                    size += len(doc)
                    n_docs += z - a
        if size:
            yield from packed()
    return run


#: kind 0: of a document; 1: of a history; 2: unseen pairs of a document (id) with a history (big)
_SUMS = ("kind int, id long, doc_id long, n long, k1 long, k2 long, k3 long, k4 long, k5 long, k6 long, "
         "big long, f1 double, f2 double")


def _sums(kind: int, **cols) -> Iterator[pa.RecordBatch]:
    names = [c.split() for c in _SUMS.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    total = len(cols["id"])
    for a in range(0, total, OUT_ROWS):
        n = min(OUT_ROWS, total - a)
        same = {t: pa.array(np.full(n, kind if t == "int" else 0)).cast(types[t]) for t in types}
        yield pa.record_batch([same[t] if c not in cols else pa.array(cols[c][a:a + n]).cast(types[t]) for c, t in names],
                              names=[c for c, _ in names])


def _runs(payloads: list[pa.Buffer]) -> Iterator[dict[str, np.ndarray]]:
    """The blobs of a bucket unpacked and joined, about ENTRY_RUN entries at a time."""
    def joined():
        shift = np.cumsum([0] + [len(b["uid"]) for b in held[:-1]], dtype=np.int32)
        out = {name: np.concatenate([b[name] for b in held]) for name, _ in _PARTS if name != "doc"}
        out["doc"] = np.concatenate([b["doc"].astype(np.int32) + s for b, s in zip(held, shift)])
        held.clear()
        return out

    held, size = [], 0
    for x in payloads:
        held.append(_load(x))
        size += len(held[-1]["doc"])
        if size >= ENTRY_RUN:
            yield joined()
            size = 0
    if held:
        yield joined()


def _solve(uni: Unigrams, pairs: Lookup):
    """All sums of a bucket.  Its blobs stay packed and are read twice, run by run: for the
    counts of its pairs, and for its documents, each of which is in one blob alone."""
    def counted(payloads) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs with their training counts; which of them each pair of a blob is."""
        found = []
        for b in _runs(payloads):
            start = np.cumsum(b["entries"]) - b["entries"]
            found.append([np.add.reduceat(b["times"] * b["train"][b["doc"]], start, dtype=np.int64),
                          b["history"], np.repeat(b["word"], b["pairs"])])
        word, history, mine = (np.concatenate([x.pop() for x in found]) for _ in range(3))
        order = np.lexsort((history, word))
        word, history = word[order], history[order]
        head = _heads(word, history)
        of = np.empty(len(order), np.int32)
        of[order] = np.cumsum(head, dtype=np.int32) - 1
        at = np.flatnonzero(head)
        return word[at], history[at], np.add.reduceat(mine[order], at), of

    def of_histories(history, count, p) -> Iterator[pa.RecordBatch]:
        """Heavy pairs are added by the caller."""
        hs, at = np.unique(history[count > 0], return_inverse=True)
        count, p = count[count > 0], p[count > 0]
        cols = {f"k{k}": np.bincount(at, count == k, len(hs)).astype(np.int64) for k in range(1, 7)}
        cols["big"] = np.bincount(at, np.where(count > TOP, count, 0), len(hs)).astype(np.int64)
        cols["n"] = np.bincount(at, minlength=len(hs))
        cols["f1"] = np.bincount(at, p, len(hs))
        return _sums(1, id=hs.view(np.int64), **cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads = [x.as_buffer() for b in batches for x in b["payload"]]
        word, history, r, of = counted(payloads)
        # of words
        lead = np.flatnonzero(_heads(word))
        at = np.repeat(np.arange(len(lead), dtype=np.int32), np.diff(np.append(lead, len(word))))
        heavy = uni.heavy(word[lead])
        c = np.where(heavy > 0, heavy, np.add.reduceat(r, lead))
        p = uni.p(c)
        base = np.log10((c + 1) / (uni.n + uni.types + 1))
        minus = np.where((c > 0) & (word[lead] != END), np.log10(np.maximum(c, 1)), 0.0)
        # of pairs
        known = pairs(pair_keys(word, history))
        del word
        yield from of_histories(history, np.where(known > 0, 0, r), p[at])
        r = np.where(known > 0, known, r)
        del known
        log_r = np.where(r > TOP, np.log10(np.maximum(r, 1)), 0.0)
        log_r += np.where(r == 0, np.log10(p)[at], 0.0)
        log_r -= minus[at]
        kinds = np.minimum(r, TOP + 1).astype(np.int8)
        del r
        # of documents; unseen pairs follow at the end, so that rows of one kind lie together
        first, misses = 0, []
        for b in _runs(payloads):
            pair = of[first:first + len(b["entries"])]
            first += len(pair)
            u, d, t, m = np.repeat(pair, b["entries"]), b["doc"], b["times"], len(b["uid"])
            kind, w = kinds[u], at[u]
            tokens_of = lambda some: np.bincount(d[some], t[some], m).astype(np.int64)
            by_kind = {f"k{k}": tokens_of(kind == k) for k in range(1, TOP + 2)}
            yield from _sums(0, id=b["uid"], doc_id=b["doc_id"], n=np.bincount(d, t, m).astype(np.int64),
                             big=tokens_of((c > 0)[w]), **by_kind,
                             f1=np.bincount(d, t * log_r[u], m), f2=np.bincount(d, t * base[w], m))
            miss = np.flatnonzero(kind == 0)
            misses.append((b["uid"][d[miss]], u[miss], t[miss]))
        for uid, u, t in misses:
            yield from _sums(2, id=uid, big=history[u].view(np.int64), n=t)
    return run


def score(docs: DataFrame, chunk: int = CHUNK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is the end mark alone.  A null doc_id belongs to the training
    part.  Repeated rows are documents of their own.  Without training rows
    every token is the one unseen word, of probability 1.  An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LEAST)).alias("doc_id"),
                      docs["text"].alias("text"), (~held_out(docs["doc_id"])).alias("train"))
    train = src.where("train").select("text")
    uni = unigrams(train, chunk)
    start = train.count()
    found = []
    if len(uni.heavy.keys):
        found = (map_batches(train, _heavy_pairs(uni), "w long, h long, c long").groupBy("w", "h").agg(F.sum("c").alias("c"))
                 .where((F.col("c") * HEAVY_PARTS >= uni.n) & (F.col("c") > TOP + 1)).collect())
    word = np.array([r["w"] for r in found], np.int64).view(np.uint64)
    history = np.array([r["h"] for r in found], np.int64).view(np.uint64)
    counts = np.array([r["c"] for r in found], np.int64)
    pairs = Lookup(pair_keys(word, history), counts)
    # training tokens are all but about a seventh
    buckets = max(1, -(-uni.n * 7 // (6 * bucket_tokens)))
    packed = map_batches(
        src.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.col("train").cast("int").alias("train"), "text"),
        _pack(buckets, uni, pairs, chunk), "bucket int, payload binary")
    sums = stage(map_groups(packed.groupBy("bucket"), _solve(uni, pairs), _SUMS), "katz-sums")
    ks = [f"k{k}" for k in range(1, TOP + 1)]
    seen = sums.where("kind = 1")
    of = seen.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in [*ks, "k6"]]).first()
    d = discounts([of[k] for k in [*ks, "k6"]])
    # the heavy pairs' part in their histories: a bounded table, sent as Arrow, which starts no Python worker
    extra = spark.createDataFrame(
        pa.table([pa.array(history.view(np.int64)), pa.array(counts), pa.array(uni.p(uni.heavy(word)), pa.float64())],
                 names=["id", "big", "f1"]), "id long, big long, f1 double")
    parts = seen.select("id", *ks, "big", "f1").unionByName(extra, allowMissingColumns=True)
    mass = sum((F.coalesce(F.sum(k), F.lit(0)) * float(r * (1 - d[r - 1])) for r, k in enumerate(ks, 1)),
               F.sum("big") * (1 - KEEP))
    alpha = stage(parts.groupBy("id").agg(F.log10(mass / F.greatest(1 - F.sum("f1"), F.lit(1e-12))).alias("a"))
                  .select(F.col("id").alias("h"), "a"), "katz-alpha")
    back = (sums.where("kind = 2").select("id", F.col("big").alias("h"), "n").join(alpha, "h")
            .groupBy("id").agg(F.sum(F.col("n") * F.col("a")).alias("back")))
    direct = (F.sum("f1") + F.sum("k6") * float(np.log10(KEEP)) - float(np.log10(max(start, 1)))
              + sum((F.sum(k) * float(np.log10(r * d[r - 1])) for r, k in enumerate(ks, 1)), F.lit(0.0)))
    by_doc = (sums.where("kind = 0").groupBy("id")
              .agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sum("big").alias("n_known"),
                   F.sum("f2").alias("base_score"), direct.alias("direct")))
    out = by_doc.join(back, "id", "left")
    doc_id = F.when(F.col("doc_id") != LEAST, F.col("doc_id"))
    return out.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "n_tokens", "n_known",
                      F.lit(uni.n).cast("long").alias("train_tokens"), "base_score",
                      (F.col("direct") + F.coalesce("back", F.lit(0.0))).alias("score"))
