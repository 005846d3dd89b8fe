"""Substring dedup with prefix-partitioned suffix trees over words.

A suffix is a window of ``width`` words (20) with what follows; only nodes at
least that deep matter.  Every window is filed under a prefix of variable
length:

1.  Of its runs of ``seed`` words (8) the window's anchor is the one with the
    least hash, so equal windows have equal anchors.  An anchor met once can't
    start a repeat; only the others go on.
2.  The consecutive windows of one anchor form one stretch, filed by a key of its
    words.  Of equal stretches only the earliest goes on, and its words are read
    from the text again; the others are repeats whole.
3.  Stretches that share an anchor form one group.  Groups are sent by anchor
    to partitions and taken in memory-sized runs of whole groups; their
    suffixes are sorted by words, and neighbours that agree in ``width`` words
    lie below one deep internal node of the group's subtree.
4.  An anchor with more than ``heavy`` different stretches is too long a group:
    its windows are filed under all their words, which makes each group one
    deep node.  Such nodes are found by a distributed minimum, whatever their
    size.

Of the leaves below a deep node the earliest (least doc_id, then place) stays;
the words of the other windows are removed.  Texts with the same words as an
earlier document are removed whole, if they are long enough for a window, and
don't enter the trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.llm import wordscan as ws
from stockroute.llm.staging import map_batches, release, stage

WIDTH = 20
SEED_WORDS = 8
HEAVY = 1000
RUN_WINDOWS = 150_000
PARTITION_BYTES = 24 << 20
LEAST = -(1 << 63)


def window_anchors(h: np.ndarray, bounds: np.ndarray, width: int,
                   seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and anchor place of every window, and the hashes of the seed runs."""
    g = ws.grams(h, seed)
    valid = ws.whole_grams(bounds, width)
    m = len(valid)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), g
    least, at = g[:m].copy(), np.zeros(m, np.int8)
    for j in range(1, width - seed + 1):
        other = g[j:j + m]
        less = other < least
        least[less] = other[less]
        at[less] = j
    starts = np.flatnonzero(valid)
    return starts, starts + at[starts], g


def _outline(width: int, seed: int):
    """A row a document: its number of words, the key of their sequence, its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in ws.scan(b["text"]):
                _, anchor, g = window_anchors(w.hashes, w.bounds, width, seed)
                anchor = anchor[np.diff(anchor, prepend=-1) != 0]
                key0, key1 = ws.sequence_keys(w.hashes, w.bounds)
                cut = np.searchsorted(anchor, w.bounds).astype(np.int32)
                place = anchor - np.repeat(w.bounds[:-1], np.diff(cut))
                yield pa.record_batch(
                    [b["doc_id"].slice(w.first, w.docs), pa.array(np.diff(w.bounds)),
                     pa.array(key0.view(np.int64)), pa.array(key1.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(g[anchor].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(place.astype(np.int32)))],
                    names=["doc_id", "n_words", "key0", "key1", "anchor", "place"])
    return run


_OUTLINE = "doc_id long, n_words long, key0 long, key1 long, anchor array<long>, place array<int>"
_STRETCH = "k0 long, c0 long, c1 long, doc_id long, start int, windows int"
_WORDS = "k0 long, doc_id long, start int, windows int, words binary"
_WINDOWS = "k0 long, k1 long, doc_id long, start int"


def _list_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the bounds of each row in them."""
    flat = column.flatten()
    n = np.asarray(column.value_lengths().fill_null(0))
    return (flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(n)]).astype(np.int64))


def _found_stretches(b: pa.RecordBatch, width: int, seed: int, places: np.ndarray, p_cut: np.ndarray
                     ) -> Iterator[tuple]:
    """Of each block of documents: the words, and of the windows of each document and
    shared anchor the first one's place, their number, document and anchor's hash."""
    for w in ws.scan(b["text"]):
        h, first, last = w.hashes, w.first, w.first + w.docs
        s, a, g = window_anchors(h, w.bounds, width, seed)
        shared = np.zeros(len(h) + 1, bool)
        own = places[p_cut[first]:p_cut[last]].astype(np.int64)
        shared[np.repeat(w.bounds[:-1], np.diff(p_cut[first:last + 1])) + own] = True
        s, a = s[shared[a]], a[shared[a]]
        if len(s):
            head = np.flatnonzero(np.diff(a, prepend=-1) != 0)
            yield w, s[head], np.diff(np.append(head, len(s))), w.doc_of_word()[s[head]], g[a[head]]


def _stretches(width: int, seed: int):
    """A row for the windows of each document and shared anchor, with a key of their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_ids = b["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
            for w, s, n, d, anchor in _found_stretches(b, width, seed, *_list_column(b["places"])):
                flat = w.hashes[ws.ranges(s, n + width - 1)]
                c0, c1 = ws.sequence_keys(flat, np.concatenate([[0], np.cumsum(n + width - 1)]))
                yield pa.record_batch(
                    [pa.array(anchor.view(np.int64)), pa.array(c0.view(np.int64)), pa.array(c1.view(np.int64)),
                     pa.array(doc_ids[w.first + d]), pa.array((s - w.bounds[d]).astype(np.int32)),
                     pa.array(n.astype(np.int32))],
                    names=["k0", "c0", "c1", "doc_id", "start", "windows"])
    return run


def _stretch_words(width: int):
    """The chosen stretches (k0, start, windows of each document) with their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_ids = b["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
            (k0, cut), (start, _), (windows, _) = (_list_column(b[c]) for c in ("k0", "start", "windows"))
            for w in ws.scan(b["text"]):
                rows = np.arange(cut[w.first], cut[w.first + w.docs])
                d = np.repeat(np.arange(w.docs), np.diff(cut[w.first:w.first + w.docs + 1]))
                size = windows[rows].astype(np.int64) + width - 1
                # a row that shares its doc_id with a longer text may lack some
                fits = start[rows] + size <= np.diff(w.bounds)[d]
                rows, d, size = rows[fits], d[fits], size[fits]
                flat = w.hashes[ws.ranges(w.bounds[d] + start[rows], size)]
                ends = (8 * np.concatenate([[0], np.cumsum(size)])).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(k0[rows]), pa.array(doc_ids[w.first + d]), pa.array(start[rows].astype(np.int32)),
                     pa.array(windows[rows].astype(np.int32)),
                     pa.Array.from_buffers(pa.binary(), len(d), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])],
                    names=["k0", "doc_id", "start", "windows", "words"])
    return run


def _expand(t: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the stretches, and each window's place in them, document and start."""
    n = t["windows"].to_numpy().astype(np.int64)
    words = np.frombuffer(b"".join(t["words"].to_pylist()), np.uint64)
    at = ws.ranges(np.concatenate([[0], np.cumsum(n + width - 1)[:-1]]), n)
    return (words, at, np.repeat(t["doc_id"].to_numpy(), n),
            ws.ranges(t["start"].to_numpy().astype(np.int64), n))


def _windows(width: int):
    """A row a window, under two keys of all its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            words, at, doc, start = _expand(pa.Table.from_batches([b]), width)
            k0, k1 = ws.grams(words, width), ws.grams(words[::-1], width)[::-1]
            yield pa.record_batch([pa.array(k0[at].view(np.int64)), pa.array(k1[at].view(np.int64)),
                                   pa.array(doc), pa.array(start.astype(np.int32))],
                                  names=["k0", "k1", "doc_id", "start"])
    return run


def repeated_leaves(words: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray,
                    width: int) -> np.ndarray:
    """Which suffixes lie below a deep node without being its earliest leaf.

    words: hashes of all words; at: where each suffix begins in them.  The
    suffixes are put in the order of the tree's leaves; a leaf whose longest
    common prefix with the one before it has ``width`` words shares a deep node
    with it.
    """
    columns = [words[at + j] for j in range(width)]
    order = np.lexsort([start, doc, *reversed(columns)])
    deep = np.ones(len(order), bool)
    deep[0] = False
    for c in columns:
        c = c[order]
        deep[1:] &= c[1:] == c[:-1]
    head = np.maximum.accumulate(np.where(deep, 0, np.arange(len(order))))
    d, s = doc[order], start[order]
    out = np.zeros(len(order), bool)
    out[order] = deep & ((d != d[head]) | (s != s[head]))
    return out


def _subtrees(width: int, run_windows: int):
    """Spans of repeated words from rows sorted by prefix, in runs of whole groups."""
    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        words, at, doc, start = _expand(t, width)
        again = repeated_leaves(words, at, doc, start, width)
        if again.any():
            yield _spans(doc[again], start[again], width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += int(np.asarray(b["windows"]).sum())
            if size >= run_windows:
                t = pa.Table.from_batches(held)
                k = t["k0"].to_numpy()
                border = np.flatnonzero(k != k[-1])
                if len(border):
                    yield from solve(t.slice(0, int(border[-1]) + 1))
                    t = t.slice(int(border[-1]) + 1)
                held, size = t.to_batches(), int(t["windows"].to_numpy().sum())
        if size:
            yield from solve(pa.Table.from_batches(held))
    return run


def _spans(doc: np.ndarray, start: np.ndarray, width: int) -> pa.RecordBatch:
    """Overlapping windows of a document joined to spans of words."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + width)
    at = np.flatnonzero(head)
    end = start[np.append(at[1:], len(doc)) - 1] + width
    return pa.record_batch([pa.array(doc[at]), pa.array(start[at].astype(np.int32)),
                            pa.array(end.astype(np.int32))], names=["doc_id", "lo", "hi"])


def repeated_spans(docs: DataFrame, width: int = WIDTH, seed: int = SEED_WORDS, heavy: int = HEAVY,
                   run_windows: int = RUN_WINDOWS) -> DataFrame:
    """(doc_id, lo, hi): spans of words that also start earlier, in no order, maybe overlapping.

    ``docs`` is (doc_id long without null, text).
    """
    outline = stage(map_batches(docs, _outline(width, seed), _OUTLINE), "suffix-outline")
    same = ["key0", "key1", "n_words"]
    first = stage(outline.groupBy(*same).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1").drop("n"), "suffix-first")
    marked = outline.join(first, same, "left")
    copies = marked.where((F.col("doc_id") > F.col("first")) & (F.col("n_words") >= width)).select(
        "doc_id", F.lit(0).alias("lo"), F.col("n_words").cast("int").alias("hi"))
    # repeated rows of one document count once
    fresh = stage(marked.where(F.col("first").isNull() | (F.col("doc_id") == F.col("first")))
                  .select("doc_id", F.explode(F.arrays_zip("anchor", "place")).alias("a"))
                  .select("doc_id", F.col("a.anchor").alias("anchor"), F.col("a.place").alias("place")),
                  "suffix-anchors")
    shared = stage(fresh.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
                   "suffix-shared")
    places = stage(fresh.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("place").alias("places")),
                   "suffix-places")
    release(fresh, shared)
    filed = stage(map_batches(docs.join(places, "doc_id").select("doc_id", "text", "places"),
                              _stretches(width, seed), _STRETCH), "suffix-stretches")
    release(places)
    # only places are filed; of equal stretches the earliest one's words are read again
    same = ["k0", "c0", "c1"]
    lead = stage(filed.groupBy(*same).agg(F.min(F.struct("doc_id", "start", "windows")).alias("m"))
                 .select(*same, "m.*"), "suffix-leads")
    equal = (filed.join(lead.select(*same, F.col("doc_id").alias("l_doc"), F.col("start").alias("l_start")), same)
             .where((F.col("doc_id") != F.col("l_doc")) | (F.col("start") != F.col("l_start")))
             .select("doc_id", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (width - 1)).alias("hi")))
    chosen = (lead.groupBy("doc_id").agg(F.collect_list(F.struct("k0", "start", "windows")).alias("x"))
              .select("doc_id", "x.k0", "x.start", "x.windows"))
    words = stage(map_batches(docs.join(chosen, "doc_id").select("doc_id", "text", "k0", "start", "windows"),
                              _stretch_words(width), _WORDS), "suffix-words")
    big = stage(lead.groupBy("k0").agg(F.count("*").alias("n")).where(F.col("n") > heavy)
                .select("k0", F.lit(True).alias("big")), "suffix-heavy")
    words_of = words.join(big, "k0", "left")
    light = words_of.where(F.col("big").isNull()).select("k0", "doc_id", "start", "windows", "words")
    size = words.agg(F.sum(F.length("words") + 40)).first()[0] or 0
    n = max(1, int(size // PARTITION_BYTES) + 1,
            int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) if size > (1 << 20) else 1)
    trees = map_batches(light.repartition(n, "k0").sortWithinPartitions("k0"),
                        _subtrees(width, run_windows), "doc_id long, lo int, hi int")
    deep = stage(map_batches(words_of.where("big").select("doc_id", "start", "windows", "words"),
                             _windows(width), _WINDOWS), "suffix-windows")
    earliest = stage(deep.groupBy("k0", "k1").agg(F.min(F.struct("doc_id", "start")).alias("e"),
                                                  F.count("*").alias("n")).where("n > 1").drop("n"), "suffix-deep")
    later = (deep.join(earliest, ["k0", "k1"])
             .where(F.struct("doc_id", "start") != F.col("e"))
             .select("doc_id", F.col("start").alias("lo"), (F.col("start") + width).alias("hi")))
    return copies.unionByName(equal).unionByName(trees).unionByName(later)


def _strip(keep: list[str], text: str):
    """The kept columns and what stays of ``text``, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, cut = _list_column(b["sf_lo"])
            hi, _ = _list_column(b["sf_hi"])
            for w in ws.scan(b[text]):
                first, last = w.first, w.first + w.docs
                own = np.diff(cut[first:last + 1])
                base, end = np.repeat(w.bounds[:-1], own), np.repeat(w.bounds[1:], own)
                depth = np.zeros(len(w.hashes) + 1, np.int64)
                # spans of a longer text with the same doc_id end with this one
                np.add.at(depth, np.minimum(base + lo[cut[first]:cut[last]], end), 1)
                np.add.at(depth, np.minimum(base + hi[cut[first]:cut[last]], end), -1)
                stay = np.cumsum(depth[:-1]) == 0
                size = (w.ends - w.starts)[stay] + 1         # with a space behind each word
                flat = np.append(w.data, np.uint8(0x20))[ws.ranges(w.starts[stay], size)]
                stop = np.cumsum(size)
                flat[stop - 1] = 0x20
                total = np.concatenate([[0], stop])
                kept = np.concatenate([[0], np.cumsum(stay)])[w.bounds]
                a, z = total[kept[:-1]], total[kept[1:]]
                raw = flat.tobytes()
                texts = [raw[i:max(i, j - 1)].decode() for i, j in zip(a.tolist(), z.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[b[c].slice(first, w.docs) for c in keep], pa.array(texts, pa.string()),
                     pa.array(np.diff(w.bounds)), pa.array(np.diff(w.bounds) - np.diff(kept))],
                    names=[*keep, "sf_kept", "sf_n_words", "sf_n_removed"])
    return run


def remove_repeats(docs: DataFrame, keep: list[str] | None = None, width: int = WIDTH,
                   seed: int = SEED_WORDS, heavy: int = HEAVY, run_windows: int = RUN_WINDOWS) -> DataFrame:
    """The ``keep`` columns (default doc_id) plus sf_kept, sf_n_words, sf_n_removed.

    sf_kept has the words that stay, joined by one space.  Null texts have no
    words; texts of fewer than ``width`` words stay.  A null doc_id counts as
    the least.  Rows that repeat a doc_id are one document to each other: equal
    rows are treated alike and don't remove each other.  An empty table gives
    no rows.
    """
    keep = keep or ["doc_id"]
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(LEAST))
    spans = repeated_spans(docs.select(key.alias("doc_id"), docs["text"].alias("text")),
                           width, seed, heavy, run_windows)
    spans = stage(spans.groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("s"))
                  .select(F.col("doc_id").alias("sf_id"), F.col("s.lo").alias("sf_lo"), F.col("s.hi").alias("sf_hi")),
                  "suffix-spans")
    # a text that is kept is carried once
    text = "text" if "text" in keep else "sf_text"
    own = [*keep, *([] if text in keep else [text])]
    src = docs.select(*[docs["text"].alias(c) if c == text else docs[c] for c in own], key.alias("sf_key"))
    none = F.array().cast("array<int>")
    joined = src.join(spans, F.col("sf_key") == F.col("sf_id"), "left").select(
        *[src[c] for c in own], F.coalesce("sf_lo", none).alias("sf_lo"),
        F.coalesce("sf_hi", none).alias("sf_hi"))
    schema = (docs.select(*[docs[c] for c in keep]).schema.add("sf_kept", "string")
              .add("sf_n_words", "long").add("sf_n_removed", "long"))
    return map_batches(joined, _strip(keep, text), schema)
