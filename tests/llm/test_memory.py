"""What the operators' tasks hold, and what they leave behind."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from stockroute.llm import katz, prefixjoin, staging, suffixtrees, toxicity
from stockroute.llm import wordscan as ws


def _resident_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) / 1024


def test_tasks_leave_no_freed_memory_behind(spark):
    """A worker whose task filled 200 MB is small again in the next task."""
    def fill(batches):
        for b in batches:
            held = [np.ones(8000) for _ in range(3200)]
            pinned.append(held[-1])         # what lies on top keeps the rest from being returned
            del held
            yield b

    def look(batches):
        for b in batches:
            yield pa.record_batch([pa.array([_resident_mb()])], names=["mb"])

    def both(batches):
        seen = []
        for step in (look, fill, look):
            seen += [r for r in staged(step, batches)]
        return seen

    pinned, one = [], [pa.record_batch([pa.array([1])], names=["id"])]

    class Plain:
        """Stands for a table: runs a task here, in this process."""
        def mapInArrow(self, run, schema):
            return list(run(iter(one)))

    def staged(step, batches):
        return staging.map_batches(Plain(), step, "id long")

    staging.give_back()
    before, _, after = (r.column(0)[0].as_py() for r in both(one))
    assert after - before < 60
    df = staging.map_batches(spark.range(100), lambda batches: batches, "id long")
    assert sorted(r["id"] for r in df.collect()) == list(range(100))


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 200_000])
def test_frequent_shingles_are_counted_in_place(make_text, n):
    text = make_text(5, n)
    batch = pa.record_batch([pa.array([text, text.upper(), None, ""]), ], names=["text"])
    g = np.concatenate([prefixjoin._distinct(*prefixjoin.shingle_rows(w, 1))[1] for w in ws.scan(pa.array([text] * 5))]
                       or [np.zeros(0, np.uint64)])
    key, count = np.unique(g, return_counts=True)
    got = [(k, c) for b in prefixjoin._frequent(1 << 30, 1)(iter([batch, batch, batch]))
           for k, c in zip(b["key"].to_pylist(), b["n"].to_pylist())]
    assert {c for _, c in got} <= {6} and len(got) == len(key)
    assert [k for k, _ in got] == key.view(np.int64).tolist() and (not n or set(count) == {5})


def test_counting_a_chunk_takes_little_more_than_the_chunk(monkeypatch):
    size = 2_000_000
    shingles = np.random.default_rng(1).integers(0, 1 << 63, size).astype(np.uint64)
    shingles[:40] = shingles[0]
    monkeypatch.setattr(prefixjoin.ws, "scan", lambda column, lower: iter([None]))
    monkeypatch.setattr(prefixjoin, "shingle_rows", lambda w, k: (None, None))
    monkeypatch.setattr(prefixjoin, "_distinct", lambda doc, key: (None, shingles.copy()))
    tracemalloc.start()
    got = list(prefixjoin._frequent(size, 1)(iter([{"text": None}])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["key"], r["n"]) for b in got for r in b.to_pylist()] == [(int(shingles[0].view(np.int64)), 40)]
    assert peak < 2.6 * 8 * size


def test_texts_return_block_by_block(make_text):
    """A large batch isn't held whole again by what is made of it."""
    text = make_text(6, 3000)
    n = 400
    ids, texts = pa.array(range(n)), pa.array([None, ""] + [text] * (n - 2))
    none = pa.array([[]] * n, pa.list_(pa.int32()))
    lo, hi = pa.array([[0]] * n, pa.list_(pa.int32())), pa.array([[2]] * n, pa.list_(pa.int32()))
    b = pa.record_batch([ids, texts, none, none], names=["doc_id", "text", "sf_lo", "sf_hi"])
    assert b.nbytes > 4 * ws.BLOCK_BYTES
    out = list(suffixtrees._strip(["doc_id", "text"], "text")(iter([b])))
    assert max(x.nbytes for x in out) < 3 * ws.BLOCK_BYTES
    got = pa.Table.from_batches(out)
    assert got["doc_id"].to_pylist() == list(range(n)) and got["text"].to_pylist() == texts.to_pylist()
    assert got["sf_kept"].to_pylist() == ["", ""] + [" ".join(text.split())] * (n - 2)
    assert set(got["sf_n_removed"].to_pylist()) == {0} and got["sf_n_words"].to_pylist()[:3] == [0, 0, 3000]
    cut = pa.record_batch([ids, texts, lo, hi], names=["doc_id", "sf_text", "sf_lo", "sf_hi"])
    got = pa.Table.from_batches(list(suffixtrees._strip(["doc_id"], "sf_text")(iter([cut]))))
    assert got["sf_kept"].to_pylist() == ["", ""] + [" ".join(text.split()[2:])] * (n - 2)
    assert got.column_names == ["doc_id", "sf_kept", "sf_n_words", "sf_n_removed"]


@pytest.mark.parametrize("keep", [["text", "doc_id"], ["doc_id"], ["doc_id", "lang", "text", "u"]])
def test_scores_stand_beside_their_rows(spark, odd_docs, keep):
    from pyspark.sql import functions as F
    word = next(ws.scan(pa.array(["again"]), lower=True)).hashes
    model = toxicity.Model(word, np.array([2.0]), -1.0)
    got = toxicity.score(odd_docs, model, keep)
    assert got.columns == [*keep, "pu_score"]
    want = odd_docs.select(*keep, F.coalesce(F.col("text").startswith("again"), F.lit(False)).alias("hit")).collect()
    rows = lambda it: sorted(it, key=repr)
    assert rows((*r[:-1], r["pu_score"] > 0.5) for r in got.collect()) == rows(tuple(r) for r in want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("pu_text" in plan) == ("text" not in keep)


@pytest.fixture(scope="module")
def occurrences():
    """Documents of 400,000 tokens, most pairs of words once, and what packing needs to know of them."""
    rng, n = np.random.default_rng(3), 10_000
    text = pa.array([" ".join(map(str, rng.integers(0, 20_000, n - 1))) for _ in range(40)])
    batch = pa.record_batch([pa.array(range(40)), pa.array(range(40)), pa.array([int(i % 7 > 0) for i in range(40)]), text],
                            names=["uid", "doc_id", "train", "text"])
    none = katz.Lookup(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return batch, katz.Unigrams(340_000, 20_001, np.full(katz.TOP, 0.5), 1e-6, none), none


def _peak(f):
    tracemalloc.start()
    try:
        out = f()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_packing_takes_little_more_than_the_chunk(occurrences):
    batch, uni, none = occurrences
    sizes, peak = _peak(lambda: [b.nbytes for b in katz._pack(8, uni, none, 400_000)(iter([batch]))])
    assert len(sizes) == 8 and peak < 400_000 * 80


def test_a_bucket_is_solved_run_by_run(occurrences, monkeypatch):
    batch, uni, none = occurrences
    packed = [b for chunk in range(4) for b in katz._pack(1, uni, none, 1)(iter([batch.slice(10 * chunk, 10)]))]
    solve = katz._solve(uni, none)
    rows, peak = _peak(lambda: [b.num_rows for b in solve(iter(packed))])
    assert max(rows) <= katz.OUT_ROWS and peak < 400_000 * 120
    key = lambda r: (r["kind"], r["id"], r["big"])

    def result():
        return sorted((r for b in solve(iter(packed)) for r in b.to_pylist()), key=key)
    whole = result()
    assert sum(r["n"] for r in whole if r["kind"] == 0) == 400_000
    for run, out in ((1, 1000), (10 ** 9, 10 ** 9)):
        monkeypatch.setattr(katz, "ENTRY_RUN", run)
        monkeypatch.setattr(katz, "OUT_ROWS", out)
        other = result()
        assert [[v for k, v in r.items() if k[0] != "f"] for r in other] == [[v for k, v in r.items() if k[0] != "f"] for r in whole]
        for f in ("f1", "f2"):
            assert np.allclose([r[f] for r in other], [r[f] for r in whole])


def test_groups_leave_no_freed_memory_behind(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(staging, "give_back", lambda: calls.append(1))

    class Plain:
        """Stands for grouped rows: runs a group here, in this process."""
        def applyInArrow(self, run, schema):
            return run

    def fails(batches):
        yield next(batches)
        raise ValueError

    one = pa.record_batch([pa.array([1])], names=["id"])
    assert list(staging.map_groups(Plain(), lambda batches: batches, "id long")(iter([one, one]))) == [one, one] and calls == [1]
    with pytest.raises(ValueError):
        list(staging.map_groups(Plain(), fails, "id long")(iter([one])))
    assert calls == [1, 1]
    monkeypatch.undo()
    df = staging.map_groups(spark.range(100).selectExpr("id % 3 g", "id").groupBy("g"),
                            lambda batches: iter([pa.record_batch([pa.array([sum(b.num_rows for b in batches)])], names=["n"])]), "n long")
    assert sorted(r["n"] for r in df.collect()) == [33, 33, 34]
