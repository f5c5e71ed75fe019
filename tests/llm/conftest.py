import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of texts as a documents table with further columns."""

    def make(rows, extra=False):
        data = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in (r if len(r) == 3 else (*r, "a") for r in rows)]
        df = spark.createDataFrame(data, DOC)
        if extra:  # names that operators use themselves
            for name in ("size", "n", "hash", "spans", "tokens", "score", "class_id", "k"):
                df = df.withColumn(name, df.lang)
        return df

    return make


@pytest.fixture(scope="session")
def words():
    r = random.Random(5)
    stock = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(400)]

    def make(n, seed):
        q = random.Random(seed)
        out = [q.choice(stock) + q.choice(["", "", "", ",", "."]) for _ in range(n)]
        return " ".join(out).replace(". ", ".\n" if seed % 2 else ". ") + "."

    return make


#: Texts that every operator must handle.
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "null id here"), (5, "x " * 60_000), (6, "é" * 50), (7, "\n\n\n")]


@pytest.fixture(scope="session")
def edges():
    return EDGES
