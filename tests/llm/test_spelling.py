"""Spelling variants against a plain search of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from stockroute.llm import spelling as sp

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans(sp.UPPER, sp.LOWER)


def words_of(docs):
    n = Counter()
    for i, t in docs:
        for run in RUN.findall(t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:p] + b[p + 1:] == a for p in range(len(b)))


def plain(docs):
    n = words_of(docs)
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, n[w], len(near[w]), form[w] or "", n[form[w]] if form[w] else -1, root(w)) for w in n)


def found(df):
    return sorted((r["word"], r["n"], r["n_near"], r["form"] or "", -1 if r["form_n"] is None else r["form_n"], r["root"])
                  for r in df.collect())


@pytest.fixture(scope="module")
def spelled():
    rnd, rows = random.Random(3), []
    stems = ["colour", "honour", "straße", "naïve", "letter", "aaaaaa", "ababab", "Überfluß", "x" * 60]
    for i in range(400):
        words = []
        for _ in range(30):
            w = rnd.choice(stems)
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2, 3])):
                p = rnd.randrange(len(w))
                w = rnd.choice([w[:p] + w[p + 1:], w[:p] + rnd.choice("aeéÿ") + w[p:], w[:p] + rnd.choice("bsßX") + w[p + 1:]])
            words.append(w)
        rows.append((i, rnd.choice([" ", "\n", "-", "1"]).join(words)))
    return rows + [(400, None), (401, ""), (None, "colour colour"), (402, "漢字 colour " * 3000), (403, "a×b÷c abc"),
                   (7, rows[7][1]), (7, rows[7][1])]


def test_variants_equal_plain_search(spark, spelled):
    docs = spark.createDataFrame([(*r, 1, "w") for r in spelled], "doc_id long, text string, n int, word string")
    got = found(sp.variants(docs))
    assert got == plain(spelled) and len(got) > 400 and any(w != r and f != r for w, _, _, f, _, r in got if f)


def test_small_waves_give_the_same(spark, spelled):
    docs = spark.createDataFrame(spelled, "doc_id long, text string")
    words = sp.vocabulary(docs).cache()
    pairs = lambda df: sorted((r["word"], r["near"]) for r in df.collect())
    assert len(sp._waves(Counter(len(r["word"]) for r in words.collect()), 60)) > 5
    assert pairs(sp.near_pairs(words, 60)) == pairs(sp.near_pairs(words))


def test_filters_hold_all_words_and_little_else():
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(20_000)})
    held, others = words[::2], words[1::2]
    (wave,) = sp._waves({7: len(held)}, sp.WAVE_WORDS)
    blocks = wave[7][0][2]
    (_, points), = sp._code_points(held)
    table = sp.np.zeros((4, blocks), sp.np.uint64)
    block, lanes = sp._bits(sp.ws.mix(sp._sums(points)), blocks)
    for k in range(4):
        sp.np.bitwise_or.at(table[k], block, lanes[k])
    for some, least, most in ((held, 1.0, 1.0), (others, 0.0, 0.02)):
        (_, points), = sp._code_points(some)
        share = sp._held(sp.ws.mix(sp._sums(points)), 7, wave, {(7, 0): table}).mean()
        assert least <= share <= most


def test_roots_of_a_long_path(spark):
    path = [(f"w{k}", f"w{k + 1}", 3 * 2 ** k) for k in range(20)]
    forms = spark.createDataFrame(path, "word string, form string, n long")
    roots = {r["word"]: r["root"] for r in sp._roots(forms, 3, 3 * 2 ** 20).collect()}
    assert roots == {f"w{k}": "w20" for k in range(20)}


def test_test_table_and_empty_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    assert found(sp.variants(docs)) == plain([tuple(r) for r in docs.collect()])
    assert sp.variants(docs.limit(0)).collect() == []
