"""Toxicity, packing, substring dedup, fingerprints, scores, n-gram join."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockroute.llm import katz, merkle, packing, prefixjoin, suffixtrees, toxicity, wordscan
from tests.llm import brute


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- word scanning
def test_words_are_those_of_the_pattern(odd_docs):
    texts = [t for _, t in _pairs(odd_docs)] + ["a\x0bb\x0cc\r\nd", " x y", "é\tß 漢字", "x" * 5000 + " y"]
    got = []
    for w in wordscan.scan(pa.array(texts), limit=300):
        raw = w.data.tobytes()
        for d in range(w.docs):
            got.append([raw[a:z].decode() for a, z in zip(w.starts[w.bounds[d]:w.bounds[d + 1]],
                                                           w.ends[w.bounds[d]:w.bounds[d + 1]])])
    assert got == [brute.words(t) for t in texts]


def test_equal_words_have_equal_hashes():
    w = next(wordscan.scan(pa.array(["abcdefgh abcdefghi abcdefgh abcdefghi xabcdefgh"])))
    assert w.hashes[0] == w.hashes[2] and w.hashes[1] == w.hashes[3] and len(set(w.hashes.tolist())) == 3


# ---------------------------------------------------------------- toxicity
@pytest.fixture(scope="module")
def toxic_docs(spark, make_text):
    rnd, rows, labels = random.Random(9), [], []
    for i in range(600):
        w = make_text(1000 + i, rnd.randrange(20, 120)).split(" ")
        bad = rnd.random() < 0.15
        for _ in range(rnd.randrange(2, 5) if bad else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["Grumple", "snarkish,", "vexoloo", "vexolam"]))
        rows.append((i, " ".join(w), "en", "s", 0))
        if rnd.random() < 0.6:
            labels.append((i, 1, int(bad)))
    rows += [(600, None, None, None, None), (601, "", "en", "s", 0), (None, "text", "en", "s", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), [
        any(x in (r[1] or "") for x in ("Grumple", "snarkish", "vexol")) for r in rows]


def _risk(theta, docs, positive, prior):
    """The non-negative risk written out text by text."""
    z = [sum(theta[j] for j in d) + theta[-1] for d in docs]
    lose = lambda x: float(np.log1p(np.exp(-x)))
    p, u = [x for x, y in zip(z, positive) if y], [x for x, y in zip(z, positive) if not y]
    mean = lambda f, xs: sum(map(f, xs)) / len(xs)
    plus, rest = prior * mean(lose, p), mean(lambda x: lose(-x), u) - prior * mean(lambda x: lose(-x), p)
    return plus, rest, plus + max(0.0, rest)


def test_fit_lowers_the_risk_as_written_out():
    rng = np.random.default_rng(3)
    n, m, prior = 120, 6, 0.2
    truth = rng.random(n) < prior
    docs = [np.flatnonzero(rng.random(m) < np.where(t, [.8, .7, .3, .3, .1, .2], [.1, .1, .3, .3, .4, .2])) for t in truth]
    positive = truth & (rng.random(n) < .7)
    start = np.append(np.zeros(m), np.log(prior / (1 - prior)))
    # the first step of Adam goes a fixed length against the sign of the gradient
    weights, bias = toxicity.nnpu_fit(docs, positive, m, prior, steps=1, rate=0.01, ridge=0.0)
    step = np.append(weights, bias) - start
    for j in range(m + 1):
        h = np.eye(m + 1)[j] * 1e-5
        slope = (_risk(start + h, docs, positive, prior)[2] - _risk(start - h, docs, positive, prior)[2]) / 2e-5
        assert abs(slope) < 1e-9 or step[j] == pytest.approx(-0.01 * np.sign(slope), rel=1e-3)
    assert _risk(start, docs, positive, prior)[1] > 0
    weights, bias = toxicity.nnpu_fit(docs, positive, m, prior, steps=400, ridge=0.0)
    best = _risk(np.append(weights, bias), docs, positive, prior)[2]
    assert best < _risk(start, docs, positive, prior)[2]
    for _ in range(200):
        assert best <= _risk(np.append(weights, bias) + rng.normal(0, .3, m + 1), docs, positive, prior)[2] + 0.02


def test_features_are_counted_over_all_training_texts(toxic_docs):
    docs, labels, _ = toxic_docs
    train = docs.where(~toxicity.held_out(docs["doc_id"])).select("doc_id", "text")
    positive = labels.where("toxic = 1").select("doc_id")
    got = {r["f"]: (r["p"], r["u"]) for r in toxicity._feature_counts(train, positive, 3).collect()}
    bad, p, u = {r["doc_id"] for r in positive.collect()}, {}, {}
    for i, t in _pairs(train):
        for w in toxicity.ws.scan(pa.array([t], pa.string()), lower=True, is_word=toxicity._LETTER):
            for f in set(toxicity.features(w).ravel().view(np.int64).tolist()):
                u[f] = u.get(f, 0) + 1
                p[f] = p.get(f, 0) + (i in bad)
    assert got == {f: (k, u[f]) for f, k in p.items() if k >= 3}
    # and do not depend on the sample that the weights are fitted on
    keys = [toxicity.fit(docs, labels, max_positive=a, max_unlabelled=b).keys.tolist() for a, b in ((3000, 9000), (20, 60))]
    assert keys[0] == keys[1] and keys[0]


def test_held_out_accuracy(toxic_docs):
    docs, labels, truth = toxic_docs
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["pu_score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = sum((got[i] >= 0.3) != truth[i] for i in held)
    assert wrong <= 0.05 * len(held)
    assert got[600] == got[601] < 0.3


def test_held_out_labels_are_not_used(spark, toxic_docs):
    docs, labels, _ = toxic_docs
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert (a.keys == b.keys).all() and np.allclose(a.weights, b.weights)


def test_toxicity_without_labels_or_texts(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd_docs, none)
    assert toxicity.score(odd_docs, model, odd_docs.columns).where("pu_score < 0.01").count() == odd_docs.count()
    assert toxicity.score(odd_docs.limit(0), model, ["doc_id"]).count() == 0


def test_the_risk_stays_non_negative():
    docs = [np.array([0])] * 20 + [np.array([0])] * 5 + [np.array([1])] * 75
    w, b = toxicity.nnpu_fit(docs, np.arange(100) < 20, 2, prior=0.07, steps=300)
    assert w[0] + b > 0 > w[1] + b


# ---------------------------------------------------------------- packing
@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.default_vocabulary(), places=1 << 10, room=500)


def test_cached_ids_equal_the_tokenizers(encoder, odd_docs):
    rnd = random.Random(4)
    bits = ["a", "Word ", " ", "\n", "\t", "é", "ß,", "'s", " '", "1", "!", " ", "　", "漢", "😀", "\u0085",
            "\r\n", "<|endoftext|>", "́", "don't", "\x1c", "\x00", "×", "-", "(x)"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(30))) for _ in range(3000)]
    texts += [t or "" for _, t in _pairs(odd_docs)]
    ref = encoder.tok.encode_batch_fast(texts, add_special_tokens=False)
    for first, ids, bounds in encoder.encode(pa.array(texts)):
        for i in range(len(bounds) - 1):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == ref[first + i].ids


def _check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.fixture(scope="module")
def plain_tokenizer():
    """The vocabulary file as it comes, apart from the operator's own encoder."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_vocabulary())


MARKED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "x<|endoftext|>y  <|endoftext|>\n\n z",
          "<|endoftext", "|> <|endoftext|", "it's<|endoftext|>'s", "<|<|endoftext|>|>", "ends <|endoftext|> ", "é<|endoftext|>é"]


def test_added_tokens_keep_their_id(encoder, plain_tokenizer):
    texts = [*MARKED, *(t + u for t in MARKED for u in MARKED), "<|endo", "ftext|>", "plain words"]
    want = [e.ids for e in plain_tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    for first, ids, bounds in encoder.encode(pa.array(texts)):
        for i in range(len(bounds) - 1):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want[first + i], texts[first + i]


def test_packing_round_trip(spark, plain_tokenizer, odd_docs):
    marked = spark.createDataFrame([(100 + i, t) for i, t in enumerate(MARKED)], "doc_id long, text string")
    odd_docs = odd_docs.select("doc_id", "text").unionByName(marked)
    rows = packing.pack_documents(odd_docs).collect()
    n = _check_packing(rows, 2048)
    assert n <= sum(r["length"] for r in rows) / 2048 + 2
    docs = _pairs(odd_docs)
    ref = [np.append(e.ids, 0).astype("<u4")
           for e in plain_tokenizer.encode_batch_fast([t or "" for _, t in docs], add_special_tokens=False)]
    want = []
    for (i, _), ids in zip(docs, ref):
        start = 0
        for k, size in enumerate(packing.piece_lengths(len(ids))):
            want.append((i, k, start, size, zlib.crc32(ids[start:start + size].tobytes())))
            start += size
        assert start == len(ids)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted([tuple(None if x is None else int(x) for x in w) for w in want], key=repr)


def _plain_best_fit(sizes, capacity):
    """Bins of items, longest first (in order where equal), each into the fullest bin it fits."""
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [b for b in bins if sum(sizes[j] for j in b) + sizes[i] <= capacity]
        if fits:
            max(fits, key=lambda b: sum(sizes[j] for j in b)).append(i)
        else:
            bins.append([i])
    return bins


def test_best_fit_equals_plain_search():
    rnd = random.Random(12)
    for _ in range(60):
        capacity = rnd.randrange(5, 200)
        sizes = [rnd.randrange(1, capacity + 1) for _ in range(rnd.randrange(1, 120))]
        bins, offset, fill = packing.best_fit(np.array(sizes), capacity)
        want = _plain_best_fit(sizes, capacity)
        assert sorted(fill.tolist()) == sorted(sum(sizes[j] for j in b) for b in want)
        for b in range(len(fill)):
            at = 0
            for i in sorted(np.flatnonzero(bins == b), key=lambda i: offset[i]):
                assert offset[i] == at
                at += sizes[i]
            assert at == fill[b] <= capacity


def test_sequence_numbers_of_levels_are_apart():
    top = (1 << packing.LEVEL_BITS) - 1
    assert (packing.LEVELS << packing.LEVEL_BITS) + top < 1 << 63
    assert ((1 << 26) - 1 << packing.PART_BITS) + (1 << packing.PART_BITS) - 1 == top


def test_tree_of_rounds(spark):
    """Small groups: several levels, each merging what the last left open."""
    rnd = random.Random(2)
    parts = spark.createDataFrame([(i, 0, 0, rnd.randrange(1, 101), i) for i in range(3000)],
                                  "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(40)
    from stockroute.llm.staging import stage
    rows = packing.pack(stage(parts, "test-pieces"), capacity=100, slack=1, group_items=25).collect()
    assert len(rows) == 3000
    assert _check_packing(rows, 100) <= 1.06 * sum(r["length"] for r in rows) / 100 + 1
    assert packing.pack_documents(parts.selectExpr("doc_id", "'' as text").limit(0)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offset, fill = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8] and fill.tolist() == [10, 10]


# ---------------------------------------------------------------- substring dedup
@pytest.mark.parametrize("heavy, run_windows", [(1000, 150_000), (1, 40)])
def test_repeats_equal_brute_force(spark, odd_docs, make_text, heavy, run_windows):
    shared = make_text(77, 60)
    more = [(100 + i, f"{make_text(200 + i, 10 + i)} {shared} {make_text(300 + i, 25)}", None, "s", 0, 0, "", 0.0, "", 0, "")
            for i in range(12)]
    more += [(120 + i, "x y " * (8 + i), None, "s", 0, 0, "", 0.0, "", 0, "") for i in range(6)]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema))
    got = suffixtrees.remove_repeats(docs, docs.columns, heavy=heavy, run_windows=run_windows)
    rows = sorted(((r["doc_id"], r["sf_n_words"], r["sf_n_removed"], r["sf_kept"]) for r in got.collect()), key=repr)
    assert rows == sorted(brute.dedup(_pairs(docs)), key=repr)


def test_repeats_of_nothing(spark):
    assert suffixtrees.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- fingerprints
def test_fingerprints(spark, odd_docs):
    rows = merkle.compare(odd_docs.where("size <> 12")).collect()      # one of the repeated rows
    docs = sorted([(brute.order_key(r["doc_id"]), r["text"] or "") for r in odd_docs.where("size <> 12").collect()])
    assert len(rows) == len(docs)
    by = {brute.order_key(r["doc_id"]): r for r in rows}
    prints = {}
    for k, (i, t) in enumerate(docs):
        nxt, half = docs[(k + 1) % len(docs)][1], len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = by[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), brute.sha(edited))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(r["fingerprint"], t) == t
        assert (r["near_edited"] == 1) == (edited == t) or r["near_edited"] < 1
        if len(t) > 500:
            assert r["near_edited"] > 0.3
    assert len(prints) == len({t for _, t in docs})


def test_one_bucket_for_each_neighbourhood(spark, odd_docs):
    docs = odd_docs.where("size <> 12")
    a = merkle.with_next_text(docs, rows_per_bucket=2).select("doc_id", "next_text").collect()
    b = merkle.with_next_text(docs).select("doc_id", "next_text").collect()
    assert sorted(a, key=repr) == sorted(b, key=repr)
    assert merkle.compare(docs.limit(0)).count() == 0
    assert merkle.compare(docs.where("doc_id = 1")).first()["near_next"] == 1.0
    assert merkle.compare(odd_docs).count() == odd_docs.count()


def test_changed_paragraphs_locate_the_edit(spark):
    a = "First line here.\nSecond line.\nThird line."
    df = spark.createDataFrame([(a, a.replace("Second", "2nd"))], "a string, b string")
    assert df.select(merkle.changed_paragraphs(F.col("a"), F.col("b"))).first()[0] == [1]


# ---------------------------------------------------------------- language-model scores
@pytest.mark.parametrize("chunk, bucket", [(katz.CHUNK_TOKENS, katz.BUCKET_TOKENS), (900, 700)])
def test_scores_equal_brute_force(spark, odd_docs, make_text, chunk, bucket):
    more = [(100 + i, "the cat " * (5 + i % 7) + make_text(500 + i % 9, 30), "en", "s", 0, 0, "", 0.0, "", 0, "") for i in range(40)]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema))
    got = katz.score(docs, chunk, bucket).collect()
    want, sums = brute.katz(_pairs(docs), katz.discounts)
    assert all(abs(s - 1) < 1e-9 for s in sums.values())
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    got = sorted(map(tuple, got), key=key)
    want = sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


def test_scores_without_training(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = katz.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert katz.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- n-gram join
@pytest.mark.parametrize("list_rows, frequent", [(prefixjoin.LIST_ROWS, prefixjoin.FREQUENT), (50, 3)])
def test_links_equal_brute_force(spark, odd_docs, make_text, list_rows, frequent):
    rnd, more = random.Random(6), []
    for family in range(6):
        base = make_text(700 + family, rnd.randrange(60, 250)).split(" ")
        for k in range(12):
            w = list(base)
            for _ in range(rnd.randrange(6)):
                w[rnd.randrange(len(w))] = f"new{rnd.randrange(50)}"
            more.append((1000 + 20 * family + k, " ".join(w), None, "s", 0, 0, "", 0.0, "", 0, ""))
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema))
    got = prefixjoin.near_duplicates(docs, list_rows=list_rows, frequent=frequent, chunk=500).collect()
    assert len(got) == docs.count()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == brute.linked(_pairs(docs))


def test_links_of_nothing(spark):
    assert prefixjoin.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefix_is_long_enough():
    for n in range(1, 300):
        for m in range(n, 300):
            need = -(-90 * (n + m) // 190)
            if 100 * n >= 90 * m:
                p, q = prefixjoin.prefix_sizes(np.array([n, m]))
                assert need > n - p and need > m - q
