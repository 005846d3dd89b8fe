import random

import pytest

WORDS = [a + b for a in "ba ke li mo nu ra se ti vo zu".split() for b in "ba ke li mo nu ra se ti vo zu".split()]


@pytest.fixture(scope="session")
def make_text():
    def make(seed: int, n: int) -> str:
        rnd = random.Random(seed)
        return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", ".\n"]) for _ in range(n))
    return make


@pytest.fixture(scope="session")
def odd_docs(spark, make_text):
    """Nulls in every column, empty and very long texts, copies, repeated rows,
    and further columns with names that operators use themselves."""
    base = make_text(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (0, base), (1, " ".join(near)), (2, base), (3, None), (4, ""), (5, "   \n\t"), (6, "one"), (7, "two words"),
        (8, "one"), (9, make_text(2, 30_000)), (10, "Café  naïve text\x1cstill one"), (11, make_text(3, 50) + " " + base),
        (12, "again " * 300), (12, "again " * 300), (None, make_text(4, 40)), (13, make_text(5, 200)),
    ]
    data = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}",
             None if t is None else len(t), k, "x", 1.5, "b", 7, "u") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, size int, lo string, "
              "n double, bucket string, key0 int, u string")


@pytest.fixture(scope="session")
def rows_of():
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return rows
