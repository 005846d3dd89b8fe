"""Spelling variants by Bloom-guided neighbourhoods.

Words of the vocabulary are near if they differ by one inserted, deleted or
replaced code point.  For every word all deletions of one letter and all
replacements of one letter by a later letter of the alphabet are generated, so
each near pair is met from one side.  The edits are probed against blocked
Bloom filters of the vocabulary, one shard a word length, that are broadcast to
the tasks; only the edits that a filter holds are shuffled to an exact join
with the vocabulary, which removes the false positives.

A filter block is four 64-bit lanes with one bit a word in each; about
``BITS_PER_WORD`` bits are kept for each word.  A shard of more words than a
broadcast may hold is cut into parts by hash; shards and parts are packed into
waves of at most ``wave_words`` words, and each wave probes the edits of its own
shards.  Driver and broadcast thus hold ``wave_words * BITS_PER_WORD`` bits
(32 MB) at any size of the vocabulary; more words mean more waves.

A null text has no words; a null doc_id is an empty string in the seed.
Repeated rows count as often as they occur.  An empty table gives an empty
result; further columns are ignored.  A word has at most (2 n + 1) times the
alphabet near words, so no group of the joins grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroute.llm import wordscan as ws
from stockroute.llm.staging import stage

RUN = "[a-zÀ-ÿ]+"         # A-Z are lower-cased first
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, DROP_EVERY, RATIO = 5, 3, 97, 2
BITS_PER_WORD, BLOCK_BITS = 16, 256
WAVE_WORDS = 1 << 24
_BASE = np.uint64(0x9E3779B97F4A7C15)       # odd: positions of a word keep apart
_LANES = [np.uint64(6 * k) for k in range(4)]
_CHUNK = 1 << 18                            # letters of the words that a task edits at a time


# ------------------------------------------------------------------ vocabulary
def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the lower-cased runs of all texts, with one letter lost where 97 divides the
    crc32 of ``doc_id:run``, of at least five code points and three occurrences."""
    runs = F.regexp_extract_all(F.translate(docs["text"], UPPER, LOWER), F.lit(RUN), F.lit(0))
    run = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    size = F.char_length("run")
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run"))
    at = F.pmod(F.col("h"), size).cast("int")
    lost = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, size))
    word = F.when(F.col("h") % DROP_EVERY == 0, lost).otherwise(F.col("run"))
    return (run.where(size >= least_length).withColumn("h", h).select(word.alias("word"))
            .where(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


# ------------------------------------------------------------------ hashes and filters
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _code_points(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, matrix of code points) for each word length."""
    size = np.array([len(w) for w in words], np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        flat = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le"), np.uint32)
        yield at, flat.reshape(len(at), n)


def _sums(points: np.ndarray) -> np.ndarray:
    """Sum of code point times power of the position: an edit changes a few terms only."""
    return (points.astype(np.uint64) * _powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def _bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Block of each hash and the bit in each of its four lanes."""
    block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    return block, [np.uint64(1) << (h >> k & np.uint64(63)) for k in _LANES]


def _blocks_of(words: int) -> int:
    return max(1, ceil(words * BITS_PER_WORD / BLOCK_BITS))


def _waves(sizes: dict[int, int], wave_words: int) -> list[dict[int, list[tuple[int, int, int]]]]:
    """Waves of shards: {length: [(part, parts, blocks)]}, at most ``wave_words`` words each."""
    waves, room = [], 0
    for length in sorted(sizes):
        parts = -(-sizes[length] // wave_words)
        words = -(-sizes[length] // parts)
        for part in range(parts):
            if words > room:
                waves.append({})
                room = wave_words
            waves[-1].setdefault(length, []).append((part, parts, _blocks_of(words)))
            room -= words
    return waves


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (ws.mix(h ^ _BASE) % np.uint64(parts)).astype(np.int64)


def _filters(spark: SparkSession, words: DataFrame, wave: dict) -> dict:
    """{(length, part): lanes} of one wave, put together by an aggregate over blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, points in _code_points(b["word"].to_pylist()):
                n = points.shape[1]
                for part, parts, blocks in wave.get(n, ()):
                    h = ws.mix(_sums(points))
                    h = h[_part(h, parts) == part]
                    block, lanes = _bits(h, blocks)
                    yield pa.record_batch([pa.array(np.full(len(h), n, np.int32)), pa.array(np.full(len(h), part, np.int32)),
                                           pa.array(block), *[pa.array(x.view(np.int64)) for x in lanes]],
                                          names=["length", "part", "block", "l0", "l1", "l2", "l3"])
    rows = (words.where(F.char_length("word").isin(*wave))
            .mapInArrow(run, "length int, part int, block long, l0 long, l1 long, l2 long, l3 long")
            .groupBy("length", "part", "block").agg(*[F.bit_or(f"l{k}").alias(f"l{k}") for k in range(4)]))
    out = {(n, part): np.zeros((4, blocks), np.uint64) for n, cut in wave.items() for part, _, blocks in cut}
    found = rows.toArrow()      # at most the filters' own size
    length, part, block = (found[c].to_numpy() for c in ("length", "part", "block"))
    lanes = [found[f"l{k}"].to_numpy().view(np.uint64) for k in range(4)]
    for (n, p), table in out.items():
        at = (length == n) & (part == p)
        for k in range(4):
            table[k, block[at]] = lanes[k][at]
    return out


def _held(h: np.ndarray, n: int, wave: dict, filters: dict) -> np.ndarray:
    """Which hashes the filters of length ``n`` hold."""
    out = np.zeros(len(h), bool)
    for part, parts, blocks in wave.get(n, ()):
        table = filters[(n, part)]
        block, lanes = _bits(h, blocks)
        hit = np.ones(len(h), bool) if parts == 1 else _part(h, parts) == part
        for k in range(4):
            hit &= table[k, block] & lanes[k] != 0
        out |= hit
    return out


# ------------------------------------------------------------------ edits
def _deletions(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, positions, sums) of the different words that lack one letter."""
    power, letters = _powers(points.shape[1]), points.astype(np.uint64)
    none = np.zeros((len(points), 1), np.uint64)
    head = np.concatenate([none, np.cumsum(letters[:, :-1] * power[:-1], axis=1, dtype=np.uint64)], axis=1)
    # letters behind the gap move one place to the front
    moved = letters[:, 1:] * power[:-1]
    tail = np.concatenate([np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], none], axis=1)
    differ = np.ones(points.shape, bool)        # of equal neighbours only the last one goes
    differ[:, :-1] = points[:, 1:] != points[:, :-1]
    rows, at = np.nonzero(differ)
    return rows, at, (head + tail)[rows, at]


def _replacements(points: np.ndarray, alphabet: np.ndarray
                  ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(letter, rows, positions, sums) of the words with one letter replaced by that later one."""
    power, whole, letters = _powers(points.shape[1]), _sums(points), points.astype(np.uint64)
    for letter in alphabet.tolist():
        rows, at = np.nonzero(points < letter)
        if len(rows):
            yield letter, rows, at, whole[rows] + (np.uint64(letter) - letters[rows, at]) * power[at]


def _edits(words: DataFrame, alphabet: np.ndarray, wave: dict, filters) -> DataFrame:
    """(word, n, edit): the edits of all words that the wave's filters hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = filters.value
        for b in batches:
            words_, counts = b["word"].to_pylist(), b["n"]
            for at, points in _code_points(words_):
                n = points.shape[1]
                step = max(1, _CHUNK // n)
                for lo in range(0, len(at), step):
                    some, places = points[lo:lo + step], at[lo:lo + step]
                    word, edit = [], []

                    def keep(rows: np.ndarray, spots: np.ndarray, h: np.ndarray, length: int, letter: str) -> None:
                        hit = _held(ws.mix(h), length, wave, held)
                        for r, p in zip(rows[hit].tolist(), spots[hit].tolist()):
                            w = words_[places[r]]
                            word.append(places[r])
                            edit.append(w[:p] + letter + w[p + 1:])
                    if n - 1 in wave:
                        keep(*_deletions(some), n - 1, "")
                    if n in wave:
                        for letter, rows, spots, h in _replacements(some, alphabet):
                            keep(rows, spots, h, n, chr(letter))
                    if word:
                        take = pa.array(np.array(word, np.int64))
                        yield pa.record_batch([b["word"].take(take), counts.take(take), pa.array(edit, pa.string())],
                                              names=["word", "n", "edit"])
    return words.mapInArrow(run, "word string, n long, edit string")


def near_pairs(words: DataFrame, wave_words: int = WAVE_WORDS) -> DataFrame:
    """(word, n, near, near_n) for each near pair of ``words`` (word, n), both ways round.

    ``words`` should be a written table of distinct words: it is read once a wave and again
    in the join.
    """
    spark = words.sparkSession
    sizes = {r["length"]: r["count"] for r in words.groupBy(F.char_length("word").alias("length")).count().collect()}
    letters = words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters if r["c"]), np.int64)
    found = None
    for wave in _waves(sizes, wave_words):
        filters = spark.sparkContext.broadcast(_filters(spark, words, wave))
        reach = sorted({k for n in wave for k in (n, n + 1)})
        some = words.where(F.char_length("word").isin(*reach))
        hits = _edits(some, alphabet, wave, filters)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    exact = words.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    pairs = stage(found.join(exact, "edit").select("word", "n", F.col("edit").alias("near"), "near_n"), "near-words")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame, low: int, high: int) -> DataFrame:
    """word, root of every word that has a form, by pointer doubling.

    Each form has ``RATIO`` times the occurrences of its word at least, so a path
    has at most log2(high / low) steps, and half as many after each round.
    """
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(max(2.0, log2(max(high / low, 2.0)) + 1)))):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        up = stage(up.join(further, "root", "left")
                   .select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    return up


def variants(docs: DataFrame, wave_words: int = WAVE_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary of ``docs``."""
    words = stage(vocabulary(docs), "vocabulary")
    near = near_pairs(words, wave_words)
    # the largest count, and of equal counts the word that comes first
    least = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    chosen = stage(near.groupBy("word", "n").agg(F.count("*").alias("n_near"), least.alias("top"))
                   .select("word", "n_near", F.when(-F.col("top.minus") >= RATIO * F.col("n"), F.col("top.near")).alias("form"),
                           (-F.col("top.minus")).alias("form_n")), "forms")
    span = words.agg(F.min("n").alias("low"), F.max("n").alias("high")).first()
    roots = _roots(chosen.where("form is not null"), span["low"] or 1, span["high"] or 1)
    return (words.join(chosen, "word", "left").join(roots, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form",
                    F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"),
                    F.coalesce("root", "word").alias("root")))
