import random

import pytest

CLASH = "doc_id long, text string, lang string, source string, n_chars long, digest string, key long, rank int, run long, id long, size long, copies int, `mix_id` string, `a b` int"


@pytest.fixture(scope="session")
def corpus():
    """Texts with nulls, empties, copies, near copies, a hot source and one long text."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    rows = []
    for i in range(120):
        n = rng.choice([1, 2, 5, 40, 120])
        rows.append([i, " ".join(rng.choice(words) for _ in range(n)), "s0" if i % 3 else f"s{i % 7}"])
    for i in range(120, 140):  # near copies of row 3
        w = " ".join(rng.choice(words) for _ in range(150)).split() if i == 120 else rows[120][1].split()
        if i > 120:
            w = list(w)
            for _ in range(i % 9):
                w[rng.randrange(len(w))] = "zz"
        rows.append([i, " ".join(w), "s1"])
    for i in range(140, 170):
        rows.append([i, rows[5][1], None])  # exact copies
    rows += [[170, None, "s2"], [171, "", "s2"], [172, "  \n ", None], [173, "x " * 30000, "s3"], [174, "A\tb\x0bC  d\r\n é", "s3"], [174, "A\tb\x0bC  d\r\n é", "s3"], [None, "no id", "s4"], [None, None, None]]
    return rows


@pytest.fixture()
def docs(spark, corpus):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "d", 1, 2, 3, 4, 5, 6, "m", 7) for i, t, s in corpus], CLASH).repartition(5)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], CLASH)
