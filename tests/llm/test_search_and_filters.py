"""Top-k search, license scans, source mixing, url filters."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stockroute.llm import licenses, mixture, redirects, topk


# ---------------------------------------------------------------- top-k search
def _brute_top(vectors, queries, k):
    out = []
    for qi, q in queries:
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors if i != qi and len(v) == len(q))[:k]
        out += [(qi, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 7])
def test_topk_equals_brute_force(spark, rows_of, block):
    rnd = random.Random(5)
    data = [(i, [rnd.choice([-0.5, 0.0, 0.25, 0.75]) for _ in range(4)]) for i in range(60)]
    data += [(60, [0.9, 0.9, 0.9, 0.9]), (61, [1.0, 2.0])]
    df = spark.createDataFrame([*data, data[3], (70, None), (71, [0.1, None, 0.2, 0.3]), (72, [float("nan")] * 4),
                                (73, [float("inf")] * 4), (None, [1.0] * 4)], "vec_id long, embedding array<float>")
    ints = topk.integer_vectors(df, "vec_id", "embedding")
    got = topk.top_k(ints, ints.where(F.col("id") % 5 == 0), 5, block_rows=block, query_rows=block)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in data]
    assert rows_of(got) == sorted(_brute_top(whole, [x for x in whole if x[0] % 5 == 0], 5), key=repr)


def test_topk_of_nothing(spark):
    none = topk.integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert topk.top_k(none, none).count() == 0


def test_threshold_stops_early():
    import numpy as np
    x = np.concatenate([np.full((5, 3), 100.0), np.random.default_rng(1).integers(0, 10, (5000, 3))])
    asc = np.argsort(x, axis=0, kind="stable")
    ids, score = topk.walk(x, np.arange(len(x)), asc, np.array([1.0, 1.0, 1.0]), -1, 5)
    assert ids.tolist() == [0, 1, 2, 3, 4] and (score == 300).all()


# ---------------------------------------------------------------- license scans
def test_license_lines_are_found(spark, make_text, rows_of):
    mit = "Released under the MIT License."
    gpl = licenses.TEMPLATES[6][1]
    docs = [(1, make_text(1, 400) + "\n" + mit), (2, make_text(2, 50)), (3, None), (4, ""),
            (5, "released UNDER the\nmit  license"), (6, gpl.replace("Foundation", "Trust ") + make_text(3, 30)),
            (7, " ".join(gpl.split()[:12])), (8, (mit + " ") * 500), (9, "released under the gnu license")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, w int, n string")
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(df).collect()}
    assert got[(1, "MIT")] == 1.0 and got[(5, "MIT")] == 1.0 and got[(8, "MIT")] == 1.0
    assert 0.8 <= got[(6, "GPL-header")] < 1.0
    assert {k[0] for k in got} == {1, 5, 6, 8}


def test_every_match_holds_an_anchor():
    for _, text in licenses.TEMPLATES:
        w, marks = licenses.template_words(text), set(licenses.anchors(text))
        runs = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        without = sum(not marks & set(r) for r in runs)
        assert without < math.ceil(0.8 * len(runs))


def test_licenses_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- mixing
def test_mix_meets_its_targets(spark, odd_docs):
    plan = mixture.mix_plan(odd_docs).collect()
    assert len(plan) == odd_docs.count()
    taken, target = {}, {}
    for r in plan:
        assert 0 <= r["taken"] <= 2 * r["size"]
        key = r["source_size"], r["target"]
        taken[key] = taken.get(key, 0) + r["taken"]
        target[key] = r["target"]
    for key, t in taken.items():
        assert abs(t - target[key]) <= 2
    assert sorted(map(tuple, plan), key=repr) == sorted(map(tuple, mixture.mix_plan(odd_docs).collect()), key=repr)


def test_mixed_documents_have_the_planned_words(spark, odd_docs):
    plan = mixture.mix_plan(odd_docs).agg(F.sum("taken")).first()[0]
    mixed = mixture.mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.agg(F.sum(F.regexp_count("text", F.lit(mixture.WORD)))).first()[0] == plan
    assert mixed.where("n_chars <> length(text)").count() == 0


def test_water_filling_clamps_and_reshares(spark):
    # weights 3, 1, 2: the first source is clamped at twice its size
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixture.targets(sizes).collect()}
    assert got == {"a": 20.0, "b": pytest.approx(295 / 3), "c": pytest.approx(590 / 3)}


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert mixture.mix_plan(none).count() == 0
    assert mixture.mix_documents(none).count() == 0


# ---------------------------------------------------------------- url filters
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def _link(url):
    return f"<html><head><LINK href='{url}' rel=canonical></head></html>"


def test_verdicts_and_aliases(spark):
    rows = [
        (1, "https://Example.com/en/a?x", None), (2, "http://www.example.com/en/a", ""),
        (3, "http://sub.example.com/fr/", None), (4, "http://notexample.org/en/", None),
        (5, "no scheme", _link("http://x.net/es/")), (6, None, None),
        # 7 names 8, 8 redirects to a blocked page: both are blocked, 9 is allowed by its own rule
        (7, "http://a.org/1", _link("/2#top")), (8, "http://a.org/2?q=1",
         '<meta http-equiv="refresh" content="0; url=http://b.net/es/x">'),
        (9, "http://c.com/1", _link("http://a.org/1")), (10, "http://d.org/", _link("http://d.org/z")),
        (11, "http://com", None), (7, "http://a.org/1", _link("/2#top")),
    ]
    df = spark.createDataFrame([(*r, "k", "v") for r in rows], "page_id long, url string, html string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in redirects.judge(df, RULES).collect()}
    assert got[1] == ("example.com", "/en/a", "example.com/en/", "block")
    assert got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3][2:] == ("com/", "allow")
    assert got[4][2:] == (None, "allow")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7][2:] == got[8][2:] == (None, "block")
    assert got[9][2:] == ("com/", "allow")
    assert got[10][2:] == (None, "allow")
    assert got[11] == ("com", "", None, "allow")
    assert redirects.judge(df, RULES).count() == len(rows)


def test_redirect_log_adds_edges(spark):
    df = spark.createDataFrame([(1, "http://a.org/1", None)], "page_id long, url string, html string")
    log = spark.createDataFrame([("a.org\n/1", "t.org\n/"), ("t.org\n/", "b.net\n/es/9"), (None, "x\n/")], "u string, v string")
    assert redirects.judge(df, RULES, log).first()["verdict"] == "block"


def test_urls_of_nothing(spark):
    assert redirects.judge(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0
