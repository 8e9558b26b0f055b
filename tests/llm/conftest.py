import random

import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Columns that a table may have besides, named like what operators use inside.
EXTRA = "k STRING, nb INT, doc INT, size STRING, h STRING, kept INT, digest STRING, root INT, value INT, `a.b` INT, words STRING, row INT"


def prose(rng, n, vocabulary=400):
    return " ".join("".join(rng.choice("aeioubcdfglmnrst") for _ in range(2 + x % 7)) + str(x % 97) for x in (rng.randrange(vocabulary) for _ in range(n)))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): prose, copies, near copies, shared passages and odd texts."""
    rng = random.Random(7)
    texts = [prose(rng, rng.choice([5, 30, 80, 200])) for _ in range(60)]
    passage = prose(rng, 60, 10_000)
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(6)]
    for t in texts[:12]:
        w = t.split()
        w[len(w) // 2] = "edited"
        texts += [t, " ".join(w), t.replace(" ", "\n  "), t.upper()]
    texts += [None, "", " \n\t ", "one", "one", "two words", "é" * 150, "x" * 700, "ab " * 400, "日本語 " * 60, prose(rng, 30_000, 50_000)]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", "c", None][(i * i) % 4]) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, lang, s, None if t is None else len(t), *["x" if "STRING" in c else 1 for c in EXTRA.split(", ")]) for i, t, lang, s in corpus]
    return spark.createDataFrame(rows, f"{SCHEMA}, {EXTRA}").repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows):
        """rows: (doc_id, text) or (doc_id, text, lang, source)."""
        return spark.createDataFrame([(*r, *(["en", "s"] if len(r) == 2 else []), len(r[1] or "")) for r in rows], SCHEMA)

    return frame


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
