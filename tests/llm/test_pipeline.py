"""The pipeline on small tables: every stage against a plain version."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as cp
from stockroute.llm import mixture, toxicity
from stockroute.llm.staging import stage
from tests.llm import brute
from tests.llm.test_near_copies import _linked


def _docs(spark, make_text):
    rnd, rows, labels = random.Random(3), [], []
    passage = make_text(5, 60)
    for i in range(160):
        w = make_text(2000 + i, rnd.randrange(30, 160)).split(" ")
        bad = i % 7 == 0
        for _ in range(4 if bad else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["grumple", "snarkish"]))
        t = " ".join(w) + (" " + passage if i % 11 == 1 else "")
        if i % 13 == 5:
            t = rows[i - 3][1]
        if i % 17 == 6:         # near copies: some reach 0.8 on five words, but not 0.9 on three
            other = rows[i - 4][1].split(" ")
            for _ in range(rnd.randrange(1, 4)):
                other[rnd.randrange(len(other))] = f"new{rnd.randrange(50)}"
            t = " ".join(other)
        rows.append((i, t, "en", f"s{i % 4}", len(t)))
        bad = "grumple" in t or "snarkish" in t
        labels.append((i, 1, int(bad)))
    rows += [(160, None, None, None, None), (161, "", "en", None, 0)]
    return rows, labels


def test_stages(spark, make_text, tmp_path):
    rows, labels = _docs(spark, make_text)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    step = dict(cp.STAGES)
    clean = stage(step["toxicity"](spark, docs, str(tmp_path)), "t")
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = {r["doc_id"] for r in toxicity.score(docs, model, ["doc_id"]).collect() if r["pu_score"] < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in clean.collect()} == kept and clean.columns == docs.columns
    bad = {i for i, _, t in labels if t}
    assert len(bad & kept) <= 1 and len(kept - bad) >= 0.95 * (162 - len(bad))
    text = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    single = stage(step["ngram_jaccard_join"](spark, clean, str(tmp_path)), "t")
    assert {i for i, _ in text(single)} == {c for _, _, c in _linked(text(clean), 80, 5)}
    assert {c for _, _, c in _linked(text(clean), 80, 5)} != {c for _, _, c in brute.linked(text(clean))}
    short = stage(step["substring_dedup"](spark, single, str(tmp_path)), "t")
    was = dict(text(single))
    want = {(i, k if gone else was[i]) for i, n, gone, k in brute.dedup(text(single)) if gone < n or not n}
    assert set(text(short)) == want and short.columns == docs.columns
    assert short.where("n_chars <> length(text)").count() == 0
    mixed = stage(step["source_mix"](spark, short, str(tmp_path)), "t")
    assert mixed.columns == docs.columns
    plan = {r["doc_id"]: r["taken"] for r in mixture.mix_plan(short).collect()}
    got = {}
    for i, t in text(mixed):
        got[i] = got.get(i, 0) + len(brute.words(t))
    assert {i: n for i, n in plan.items() if n} == got
    packed = step["bestfit_packing"](spark, mixed, str(tmp_path))
    assert packed.where("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    whole = cp.run(spark, str(tmp_path))
    count = lambda df: sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in df.collect())
    assert count(whole) == count(packed)


def test_stages_on_odd_rows(spark, odd_docs, tmp_path):
    """Null ids, texts and sources, repeated rows, a very long text, columns with clashing names."""
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (13, 1, 0), (12, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert docs.where("doc_id = 12").count() == 2
    counts = []
    for name, step in cp.STAGES[:-1]:
        docs = stage(step(spark, docs, str(tmp_path)), "odd")
        assert docs.columns == odd_docs.columns, name
        counts.append({r["doc_id"]: r["n"] for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()})
    clean, single, short, mixed = counts
    assert clean == {**dict.fromkeys([*range(14), None], 1), 12: 2}
    # 1, 2 and 8 are copies, and the two rows of 12 one document
    assert single == dict.fromkeys(set(clean) - {1, 2, 8}, 1) and set(short) <= set(single)
    assert not {3, 4, 5} & set(mixed) and None in mixed
    packed = dict(cp.STAGES)["bestfit_packing"](spark, docs, str(tmp_path))
    assert packed.where("piece = 0").count() == docs.count()


def test_stages_on_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
