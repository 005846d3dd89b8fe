"""Best-fit packing by hierarchical residual rounds.

Texts become token ids plus a closing 0; only documents longer than a sequence
are cut, into full pieces after a shorter first one.  Partitions pack their
pieces best-fit by falling length; full and nearly full sequences are emitted.
The underfull ones are merged, as items of their own, in a tree of further
best-fit rounds with fewer groups each time.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.llm import wordscan as ws
from stockroute.llm.staging import map_batches, stage

CAPACITY = 2048
SLACK = 3               # a sequence this close to full is emitted at once
GROUP_ITEMS = 200_000   # items that one group of a round may hold
#: Places in a sequence number: 32 levels (the last one: uncut full pieces) of 2^26
#: partitions of 2^32 sequences.
LEVEL_BITS, PART_BITS, LEVELS = 58, 32, 31

#: Bytes after (or before) which a space is sure to open a new piece of the
#: tokenizer's own splitting: ASCII beyond controls, and the last byte of the
#: two-byte letters of Latin, Greek, Cyrillic, Hebrew and Arabic scripts.
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_LEAD2 = np.zeros(256, bool)
_LEAD2[0xC3:0xE0] = True
#: Letters and punctuation part as well, but for the apostrophe of contractions.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCT = _ASCII & ~_LETTER
_PUNCT[[0x27, *range(48, 58)]] = False


class Encoder:
    """Token ids of whole texts, with a cache of the chunks between safe cuts.

    The tokenizer never joins a visible character with a lone space or line
    feed that follows it, so texts are cut there and a chunk met before is not
    encoded again.  Added tokens of the vocabulary file (``<|endoftext|>``) are
    chunks of their own.  Chunks whose ends are not surely visible characters are
    encoded by themselves.  The cache is a table with two places a chunk, in
    which a new chunk may take an old one's place; it never holds more than
    ``places`` chunks and about ``room`` ids.
    """

    def __init__(self, path: str, places: int = 1 << 21, room: int = 12_000_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        told = json.loads(self.tok.to_str())
        vocab = told["model"]["vocab"]
        #: strings of the vocabulary file that are one token wherever they stand
        self.marks = [t["content"].encode() for t in told["added_tokens"]]
        self.size = np.zeros(max(vocab.values()) + 65, np.int64)
        for word, i in vocab.items():
            self.size[i] = len(word)        # a character of the vocabulary is one byte
        self.mask, self.room = np.uint64(places - 1), room
        self.keys = np.zeros(places, np.uint64)
        self.at = np.zeros(places, np.int64)
        self.n = np.zeros(places, np.int32)
        self.pool = np.zeros(1 << 20, np.uint32)
        self.used = 0

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (h & self.mask).astype(np.int64), (h >> np.uint64(40) & self.mask).astype(np.int64)

    def _add(self, ids: np.ndarray) -> int:
        """Append ids to the pool; where they begin."""
        at = self.used
        while at + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[at:at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _marked(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Starts and ends of the added tokens within documents; the leftmost one counts."""
        raw, found, at = data.tobytes(), [], 0
        while self.marks:
            hits = [(i, -len(m)) for m in self.marks if (i := raw.find(m, at)) >= 0]
            if not hits:
                break
            i, size = min(hits)
            border = off[np.searchsorted(off, i, side="right")]
            if i - size <= border:
                found.append((i, i - size))
            at = min(i - size, int(border))
        return np.array(found, np.int64).reshape(-1, 2)

    def cuts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the chunks, and whether each may be joined with others."""
        n = len(data)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, bool)
        lead = _LEAD2[data]
        opens = _ASCII[data] | lead                     # a visible character begins here
        closes = _ASCII[data].copy()                    # ... ends here
        closes[1:] |= lead[:-1] & (data[1:] >= 0x80)
        keep = np.zeros(n + 1, bool)
        keep[off] = True
        if n > 2:
            # i between two visible characters of its own document
            lone = closes[:-2] & opens[2:] & ~keep[1:n - 1] & ~keep[2:n]
            space, line = lone & (data[1:-1] == 0x20), lone & (data[1:-1] == 0x0A)
            keep[1:n - 1] |= space | line
            keep[2:n] |= line
        letter = _LETTER[data]
        # the letters of Latin-1: C3 80 .. C3 BF but for two signs
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        keep[1:n] |= letter[:-1] & _PUNCT[data[1:]]
        marked = self._marked(data, off)
        for a, b in marked:
            keep[a:b + 1] = False
        keep[marked.ravel()] = True
        at = np.flatnonzero(keep)
        starts, ends = at[:-1], at[1:]
        first = data[starts]
        second = data[np.minimum(starts + 1, n - 1)]
        begins = opens[starts] | ((first == 0x20) & (ends - starts > 1) & (_ASCII[second] | _LEAD2[second]))
        return starts, ends, begins & closes[ends - 1] & ~np.isin(starts, marked[:, 0])

    def _learn(self, chunks: list[bytes], joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode chunks into the pool; where each one's ids begin, and their number."""
        at, n = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        alone = np.flatnonzero(~joined)
        for i, e in zip(alone, self.tok.encode_batch_fast(
                [chunks[i].decode() for i in alone], add_special_tokens=False)):
            at[i], n[i] = self._add(np.array(e.ids, np.uint32)), len(e.ids)
        many = np.flatnonzero(joined)
        size = np.array([len(chunks[i]) for i in many], np.int64) + 1
        groups = np.split(many, np.flatnonzero(np.diff(np.cumsum(size) // 20_000)) + 1) if len(many) else []
        lines = self.tok.encode_batch_fast([b"\n".join([chunks[i] for i in g]).decode() for g in groups],
                                           add_special_tokens=False)
        for g, e in zip(groups, lines):
            seq = np.array(e.ids, np.uint32)
            stop = np.cumsum([len(chunks[i]) + 1 for i in g]) - 1   # without the line feed that follows
            hi = np.searchsorted(np.cumsum(self.size[seq]), stop) + 1
            lo = np.concatenate([[0], hi[:-1] + 1])
            at[g], n[g] = self._add(seq) + lo, hi - lo
        return at, n

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first document, ids, bounds of each document in ids), block by block."""
        buf, off = ws.text_buffers(column)
        for d, e in ws.byte_blocks(off, 2 << 20):
            if self.used > self.room:
                self.keys[:], self.used = 0, 0
            data, own = buf[off[d]:off[e]], off[d:e + 1] - off[d]
            starts, ends, joined = self.cuts(data, own)
            h = ws.span_hashes(data, starts, ends, seed=7) | np.uint64(1)
            p, q = self._places(h)
            p = np.where(self.keys[p] == h, p, q)
            at, n = self.at[p], self.n[p].astype(np.int64)
            new = np.flatnonzero(self.keys[p] != h)
            if len(new):
                keys, first, back = np.unique(h[new], return_index=True, return_inverse=True)
                first = new[first]
                raw = data.tobytes()
                k_at, k_n = self._learn([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())],
                                        joined[first])
                at[new], n[new] = k_at[back], k_n[back]
                p, q = self._places(keys)
                p = np.where(self.keys[p] == 0, p, q)
                self.keys[p], self.at[p], self.n[p] = keys, k_at, k_n
                # of chunks written to one place the last one stays
                kept = self.keys[p] == keys
                self.at[p[kept]], self.n[p[kept]] = k_at[kept], k_n[kept]
            ids = self.pool[ws.ranges(at, n)]
            total = np.concatenate([[0], np.cumsum(n)])
            yield d, ids, total[np.searchsorted(starts, own)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a Python worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_lengths(n: int, capacity: int = CAPACITY) -> np.ndarray:
    """Lengths of a document's pieces: full ones after a first of the rest."""
    first = n % capacity or capacity
    return np.array([first, *[capacity] * ((n - first) // capacity)], np.int64)


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document; a null text is empty."""
    path = vocabulary or default_vocabulary()
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            doc_ids = b["doc_id"]
            for first, ids, bounds in enc.encode(b["text"]):
                doc, piece, start, length, crc = [], [], [], [], []
                for i in range(len(bounds) - 1):
                    seq = np.append(ids[bounds[i]:bounds[i + 1]], 0).astype("<u4")
                    at = 0
                    for k, n in enumerate(piece_lengths(len(seq), capacity)):
                        doc.append(first + i)
                        piece.append(k)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(seq[at:at + n].tobytes()))
                        at += n
                yield pa.record_batch(
                    [doc_ids.take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(src, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of each item, and each bin's fill; longest items first.

    Open bins are kept by the room they have left, and a set of the rooms in
    use as bits of one integer, so the tightest fit is found at once.
    """
    bins = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offset[i] = b, fill[b]
        fill[b] += s
        room -= s
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, offset, np.array(fill, np.int64)


_PLACED = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "bin long, offset long, fill long")


def _round(level: int, capacity: int, limit: int):
    """Pack the bins met in a partition as items; rows keep their place in them.

    The rows of a bin come one after another; about ``limit`` rows are packed
    at a time.
    """
    names = [c.split()[0] for c in _PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, made = TaskContext.get().partitionId(), 0

        def packed(t: pa.Table) -> list[pa.RecordBatch]:
            nonlocal made
            _, first, at = np.unique(t["bin"].to_numpy(), return_index=True, return_inverse=True)
            bins, offset, fill = best_fit(t["fill"].to_numpy()[first], capacity)
            # numbers are unique over levels, partitions and calls
            name = (np.int64(level) << LEVEL_BITS) + (np.int64(part) << PART_BITS) + bins + made
            made += len(fill)
            cols = [t[c] for c in names[:5]] + [
                pa.array(name[at]), pa.array(t["offset"].to_numpy() + offset[at]), pa.array(fill[bins][at])]
            return pa.table(cols, names=names).to_batches(max_chunksize=20_000)

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= limit:
                t = pa.Table.from_batches(held)
                ids = t["bin"].to_numpy()
                whole = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if (ids != ids[-1]).any() else 0
                if whole:
                    yield from packed(t.slice(0, whole))
                held, size = t.slice(whole).to_batches(), t.num_rows - whole
        if size:
            yield from packed(pa.Table.from_batches(held))
    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, slack: int = SLACK,
         group_items: int = GROUP_ITEMS) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32) plus sequence_id, offset.

    ``parts`` should be a written table: it is read more than once.  Ties,
    repeated rows and hot documents don't matter, as only lengths count; no
    piece gives no sequence.  Groups of a round hold a bounded number of items and are
    dealt anew each time.  Sequences that not even the emptiest other one fits into are
    emitted; the tree ends with one group, or with a round that merges nothing.
    """
    numbered = (parts.withColumn("bin", F.monotonically_increasing_id())
                .withColumn("offset", F.lit(0).cast("long")).withColumn("fill", F.col("length")))
    full = F.col("length") >= capacity
    done = [numbered.where(full).withColumn("bin", F.col("bin") + F.lit(LEVELS << LEVEL_BITS))]
    rows = numbered.where(~full)            # the first round packs each partition
    level, groups, before = 0, 0, None
    while True:
        packed = stage(map_batches(rows, _round(level, capacity, 4 * group_items), _PLACED), f"pack-{level}")
        # at most a row for each fill
        fills = {r["fill"]: r["n"] for r in packed.where(F.col("fill") < capacity - slack)
                 .groupBy("fill").agg(F.count_distinct("bin").alias("n")).collect()}
        room = capacity - min(fills, default=capacity)
        under = (F.col("fill") < capacity - slack) & (F.col("fill") <= room)
        left = sum(n for fill, n in fills.items() if fill <= room)
        if left <= 1 or groups == 1 or before is not None and left >= before or level == LEVELS - 1:
            done.append(packed)
            break
        done.append(packed.where(~under))
        before, level = left, level + 1
        groups = -(-left // group_items)
        rows = (packed.where(under).repartition(groups, F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)))
                .sortWithinPartitions("bin"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32",
                      F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    return pack(stage(pieces(docs, vocabulary, capacity), "pieces"), capacity)
