"""Near copies at other shingle lengths and thresholds than those of the registered query."""

import random

import pyarrow as pa

import corpus_pipeline as cp
from stockroute.llm import prefixjoin
from stockroute.llm.components import components
from tests.llm import brute


def _linked(docs, percent, k):
    sets = {i: brute.shingles(t, k) for i, t in docs}
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if c == high else c for i, c in comp.items()}
    return {(i, len(s), comp[i]) for i, s in sets.items()}


def test_stage_takes_five_words_and_four_fifths(spark, tmp_path):
    first = [f"word{i}" for i in range(55)]
    second = [*first[:27], "other", *first[28:]]       # 46 of 56 five-word shingles, 50 of 56 three-word ones
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in ((1, first), (2, second), (3, first[:40]))],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(cp.STAGES)["ngram_jaccard_join"](spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert {r["component_id"] for r in prefixjoin.near_duplicates(docs).collect()} == {1, 2, 3}


def test_shingle_length_equals_brute_force(spark, make_text):
    rnd, rows = random.Random(8), [(900, "one two three four"), (901, "one two three four"), (902, "one"), (903, "")]
    for family in range(5):
        base = make_text(300 + family, rnd.randrange(40, 120)).split(" ")
        for k in range(10):
            w = list(base)
            for _ in range(rnd.randrange(5)):
                w[rnd.randrange(len(w))] = f"new{rnd.randrange(50)}"
            rows.append((20 * family + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = prefixjoin.near_duplicates(docs, percent=80, shingle=5, frequent=50, chunk=500).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == _linked(rows, 80, 5)


def test_pairs_of_a_family_grow_with_its_size(spark, monkeypatch):
    """Copies with two changed words each: most don't link, yet few pairs are left for the last round."""
    rnd, n, pairs = random.Random(1), 600, {}
    base = [f"w{rnd.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(2):
            w[rnd.randrange(200)] = f"x{rnd.randrange(10 ** 9)}"
        rows.append((i, " ".join(w)))
    stage = prefixjoin.stage

    def counted(df, name):
        out = stage(df, name)
        if name in ("join-second", "join-close"):
            pairs[name] = pairs.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(prefixjoin, "stage", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in prefixjoin.near_duplicates(docs).collect()}
    assert got == _linked(rows, 90, 3)
    assert pairs["join-second"] < 5 * n and pairs["join-close"] < 60 * n


def _made(prefixes, n=100):
    """Pairs that the last round makes of groups with these prefixes, each list in a task of its own."""
    lists = {}
    for gid, prefix in enumerate(prefixes):
        for pos, token in enumerate(prefix):
            before = [prefix[pos - 1 - k] if pos > k else 0 for k in range(2)]
            row = {"token": token, "gid": gid, "np": (n << 32) + 2 * pos, "tag": gid,
                   **{q: 0 for q in prefixjoin._Q}, **dict(zip(("e0", "e1"), before))}
            lists.setdefault(token, []).append(row)
    run = prefixjoin._by_lists(prefixjoin._open_pairs(80), "size", 1000)
    return [(r["ga"], r["gb"]) for rows in lists.values() for b in run(iter([pa.RecordBatch.from_pylist(rows)]))
            for r in b.to_pylist()]


def test_a_pair_is_made_in_few_of_its_lists():
    same = list(range(1, 11))
    assert _made([same, same]) == [(0, 1)]
    assert _made([same, [1, 2, 30, 4, 5, 6, 7, 8, 9, 10]]) == [(0, 1)]      # one apart
    family = [[*same[:i], 100 + i, *same[i + 1:]] for i in range(10)]
    made = _made(family)
    assert len(set(made)) == 45 and len(made) < 60
    # the first place has none before it, whatever its columns hold
    assert _made([[5, 7], [5, 8]]) == [(0, 1)] and _made([[0, 5], [5, 0]]) != []


def test_lists_of_a_mid_sized_family_leave_few_pairs_to_verify(spark, monkeypatch):
    """Families of long texts, too small for the rounds of chance, whose members mostly link."""
    rnd, rows, closed = random.Random(3), [], []
    for family in range(6):
        base = [f"f{family}w{rnd.randrange(10 ** 6)}" for _ in range(300)]
        for i in range(40):
            w = list(base)
            for _ in range(3):
                w[rnd.randrange(300)] = f"x{rnd.randrange(10 ** 9)}"
            rows.append((100 * family + i, " ".join(w)))
    stage = prefixjoin.stage

    def counted(df, name):
        out = stage(df, name)
        if name == "join-close":
            closed.append(out.count())
        return out
    monkeypatch.setattr(prefixjoin, "stage", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"])
           for r in prefixjoin.near_duplicates(docs, percent=80, shingle=5).collect()}
    assert got == _linked(rows, 80, 5)
    assert sum(closed) < 6 * len(rows)         # of 4,680 inside the families


def _fits(x, y, na, nb, percent):
    row = {"ga": 1, "gb": 2, "na": na, "nb": nb, "pa": x, "pb": y}
    schema = pa.schema([("ga", pa.int64()), ("gb", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()),
                        ("pa", pa.list_(pa.int64())), ("pb", pa.list_(pa.int64()))])
    batch = pa.RecordBatch.from_pylist([row], schema=schema)
    return sum(b.num_rows for b in prefixjoin._prefix_fits(percent)(iter([batch]))) == 1


def test_prefixes_that_share_too_little_are_left_out():
    rnd = random.Random(5)
    for percent in (80, 90):
        kept = 0
        for _ in range(400):
            x = sorted(rnd.sample(range(130), 100))
            y = sorted({*x[rnd.randrange(12):]} ^ {rnd.randrange(130) for _ in range(rnd.randrange(30))})
            p, q = (v[:len(v) - -(-percent * len(v) // 100) + 1] for v in (x, y))
            # the order is that of unsigned keys
            as_long = lambda v: [k - (1 << 63) if k > 64 else k for k in v]
            linked = 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y))
            ok = _fits(as_long(p), as_long(q), len(x), len(y), percent)
            assert ok or not linked
            kept += ok
        assert kept < 400
    assert not _fits([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11], [1, *range(20, 30)], 100, 100, 90)


def test_components_that_stop_early_stay_inside_the_real_ones(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100 + i, 101 + i) for i in range(3)], "u long, v long")
    rows = components(edges, rounds=1).collect()
    assert len(rows) == 45 and len({r["node"] for r in rows}) == 45
    assert all((r["node"] < 100) == (r["component"] < 100) and r["component"] <= r["node"] for r in rows)
