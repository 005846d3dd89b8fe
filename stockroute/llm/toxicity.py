"""Toxicity by non-negative positive-unlabelled learning.

The only labels used are confirmed toxic rows (positives) and the share of
toxic rows among the labelled ones (the class prior).  Unlabelled texts stand
for the mixture of both classes.  A linear classifier on the presence of words
and word beginnings minimises

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss; while the second part is negative (the classifier
overfits the positives) its gradient step is reversed.

Features are counted over all training texts.  Only the fit of their weights sees
a bounded sample: at most ``max_positive`` and ``max_unlabelled`` texts (those with
the least hash of doc_id).  Scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.llm import wordscan as ws
from stockroute.llm.staging import map_batches, small_batches, stage

PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.3
MARKS = 1 << 26             # bits of the bitmap of features (8 MB)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(words: ws.Words) -> np.ndarray:
    """Hashes, one row a word: the word itself and its first bytes."""
    size = words.ends - words.starts
    cols = [words.hashes]
    for n in PREFIXES:
        cols.append(ws.span_hashes(words.data, words.starts,
                                   words.starts + np.minimum(size, n), seed=1000 + n))
    return np.stack(cols, axis=1)


def held_out(doc_id, parts: int = 4, part: int = 2):
    """Whether crc32 of the id as text falls to the held-out part; a null id never does."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts)) == part, F.lit(False))


@dataclass
class Model:
    keys: np.ndarray        # sorted feature hashes
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self._maybe = np.zeros(1 << 20, bool)
        self._maybe[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def present(self, words: ws.Words) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, feature number) pairs of the model's features."""
        if not len(self.keys) or not len(words.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        f = features(words)
        row, col = np.nonzero(self._maybe[(f & np.uint64((1 << 20) - 1)).astype(np.int64)])
        found = f[row, col]
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hit = self.keys[at] == found
        doc = words.doc_of_word()[row[hit]]
        pair = np.unique(doc * len(self.keys) + at[hit])
        return pair // len(self.keys), pair % len(self.keys)

    def block_scores(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Of each block of texts: the first one's place and the scores."""
        for words in ws.scan(texts, lower=True, is_word=_LETTER):
            doc, at = self.present(words)
            z = np.bincount(doc, self.weights[at], words.docs) + self.bias
            yield words.first, 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(s for _, s in self.block_scores(texts))])


def nnpu_fit(docs: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float,
             steps: int = 400, rate: float = 0.05, ridge: float = 1e-4,
             beta: float = 0.0, gamma: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias minimising the non-negative risk by Adam over full batches."""
    sizes = np.array([len(d) for d in docs])
    flat = np.concatenate(docs).astype(np.int64) if len(docs) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(docs)), sizes)
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = np.bincount(row, theta[flat], len(docs)) + theta[-1]
        up = 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))         # d loss(-)/dz
        neg = np.logaddexp(0.0, z)                                # loss(-)
        rest = neg[~positive].sum() / n_u - prior * neg[positive].sum() / n_p
        g_plus = np.where(positive, prior * (up - 1.0) / n_p, 0.0)
        g_rest = np.where(positive, -prior * up / n_p, up / n_u)
        g = g_plus + g_rest if rest >= -beta else -gamma * g_rest
        grad = np.append(np.bincount(flat, g[row], n_features), g.sum()) + ridge * np.append(theta[:-1], 0.0)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _count_features(marks: np.ndarray | None = None):
    """Per block of texts: how many of them hold each feature (of those that ``marks``, a
    bitmap of feature hashes, may have)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words in ws.scan(b["text"], lower=True, is_word=_LETTER):
                f = features(words).ravel()
                doc = np.repeat(words.doc_of_word(), 1 + len(PREFIXES))
                if marks is not None:
                    at = (f & np.uint64(MARKS - 1)).astype(np.int64)
                    held = marks[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) != 0
                    f, doc = f[held], doc[held]
                keys, at = np.unique(f, return_inverse=True)
                pair = np.unique(at.astype(np.int64) * words.docs + doc)
                n = np.bincount(pair // max(1, words.docs), minlength=len(keys)).astype(np.int64)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["f", "n"])
    return run


def _feature_counts(docs: DataFrame, positive: DataFrame, min_texts: int) -> DataFrame:
    """f, p, u of the features of ``min_texts`` positive texts or more: how many of the
    positive texts and of all texts hold them.

    Every text of ``docs`` is counted.  The features of the positives mark a bitmap of
    fixed size, so that most others are not shuffled; the join leaves out the rest.
    """
    count = "f long, n long"
    known = stage(map_batches(docs.join(positive, "doc_id", "left_semi").select("text"), _count_features(), count)
                  .groupBy("f").agg(F.sum("n").alias("p")).where(F.col("p") >= min_texts), "pu-features")
    words = (known.withColumn("place", F.col("f").bitwiseAND(F.lit(MARKS - 1)))
             .groupBy(F.shiftright("place", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS INT))")).alias("bits")))
    marks = np.zeros(MARKS >> 6, np.uint64)
    for r in words.collect():           # at most MARKS / 64 rows
        marks[r["w"]] = np.int64(r["bits"]).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    everywhere = (map_batches(docs.select("text"), lambda batches: _count_features(shared.value)(batches), count)
                  .groupBy("f").agg(F.sum("n").alias("u")))
    return known.join(everywhere, "f")


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_unlabelled: int = 9000,
        max_features: int = 4096, min_z: float = 4.0, min_texts: int = 3,
        min_precision: float = 0.6, prior_share: float = 0.95) -> Model:
    """Fit on confirmed toxic texts plus unlabelled ones, held-out rows aside.

    Features are chosen from the counts of all training texts: one is used if it is more
    frequent among the positives than among all (``min_z``) and if, with the prior, at
    least ``min_precision`` of the texts that hold it should be toxic; the ``max_features``
    of highest z make the model, whose size is thus bounded.  Their weights are fitted on
    a bounded sample: at most ``max_positive`` confirmed toxic texts and
    ``max_unlabelled`` texts of all, by hash of doc_id.  The risk uses ``prior_share`` of
    the labelled share of toxic rows, as some of those show no sign of it.

    Without a toxic training row, or without any text, the model has no
    features and scores every text the prior (0 without labels).  Rows repeated with one
    doc_id count as often as they occur, in the counts and in the sample; features of
    equal z go by hash.
    """
    known = (labels.where(~held_out(labels["doc_id"])).groupBy(labels["doc_id"].alias("doc_id"))
             .agg(F.max("toxic").alias("toxic")).where(F.col("toxic").isNotNull()))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    order = lambda salt: F.xxhash64(F.lit(salt), "doc_id")
    train = docs.where(~held_out(docs["doc_id"])).select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    positive = stage(known.where("toxic = 1").select("doc_id"), "pu-positive")
    pos = positive.orderBy(order(1), "doc_id").limit(max_positive).withColumn("positive", F.lit(True))
    unl = train.select("doc_id").orderBy(order(2), "doc_id").limit(max_unlabelled).withColumn("positive", F.lit(False))
    texts = docs.select(docs["doc_id"].alias("t_id"), docs["text"].alias("text"))
    # at most max_positive + max_unlabelled ids, so their side may be broadcast
    chosen = F.broadcast(stage(pos.unionByName(unl), "pu-sample"))
    sample = stage(texts.join(chosen, F.col("t_id") == F.col("doc_id")).select("positive", "text"), "pu-texts")
    n_u = train.count()
    n_p = train.select("doc_id").join(positive, "doc_id", "left_semi").count()
    none = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))))
    if not n_p or not n_u or not 0 < prior < 1:
        return none
    counts = _feature_counts(train, positive, min_texts)
    share = (F.col("p") + F.col("u")) / (n_p + n_u)
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    precision = prior * F.col("p") / n_p / ((F.col("u") + F.sqrt("u") + 1) / n_u)
    best = (counts.where(share < 1).withColumn("z", z)
            .where((F.col("z") >= min_z) & (precision >= min_precision)).orderBy(F.desc("z"), "f").limit(max_features).select("f"))
    with small_batches(docs.sparkSession):
        best = best.collect()
    keys = np.sort(np.array([r["f"] for r in best], np.int64).view(np.uint64))
    if not len(keys):
        return none
    probe = Model(keys, np.zeros(len(keys)), 0.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words in ws.scan(b["text"], lower=True, is_word=_LETTER):
                doc, at = probe.present(words)
                cut = np.searchsorted(doc, np.arange(words.docs + 1)).astype(np.int32)
                yield pa.record_batch(
                    [b["positive"].slice(words.first, words.docs),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(at.astype(np.int32)))],
                    names=["positive", "at"])

    with small_batches(docs.sparkSession):
        got = map_batches(sample, rows, "positive boolean, at array<int>").collect()
    weights, bias = nnpu_fit([np.array(r["at"], np.int64) for r in got],
                             np.array([r["positive"] for r in got], bool), len(keys),
                             prior * prior_share)
    return Model(keys, weights, bias)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` plus score (0 to 1) of the whole text.

    Null and empty texts hold no feature and get the model's base score.
    """
    # a text that is kept is sent once, and goes back block by block
    at = keep.index("text") if "text" in keep else len(keep)
    src = docs.select(*[docs[c] for c in keep], *([] if "text" in keep else [docs["text"].alias("pu_text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, scores in model.block_scores(b.column(at)):
                own = b.slice(first, len(scores))
                yield pa.RecordBatch.from_arrays([*own.columns[:len(keep)], pa.array(scores)],
                                                 names=[*keep, "pu_score"])

    schema = docs.select(*[docs[c] for c in keep]).schema.add("pu_score", "double")
    return map_batches(src, run, schema)
