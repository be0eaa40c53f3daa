import random

import pytest


def prose(rng: random.Random, n: int) -> str:
    """Words in lines, drawn so that five-word shingles rarely meet by chance."""
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + ("\n" if rng.random() < 0.08 else " "))
    return "".join(out).strip()


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages and lines, and odd texts."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(30, 400)) for _ in range(60)]
    base, passage, line = prose(rng, 200), prose(rng, 80).replace("\n", " "), "A line that Many documents share here"
    texts += [base] * 7
    for k in range(25):
        w = base.split(" ")
        for _ in range(k):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        texts.append(" ".join(w))
    texts += [prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 50) for _ in range(12)]
    texts += [prose(rng, 40) + "\n" + line.upper() + " \n" + prose(rng, 40) + "\n\t" + line for _ in range(12)]
    texts += [None, "", " \t\n ", "one", "two words", "a b c d", "x" * 5000, "Orre " * 900, "é" * 300 + "ß日本語 " * 200, "\n\n\n", prose(rng, 4000)]
    rows = [(3 * i + 1, t, ["en", "de", None][i % 3], "src%d" % (i % 2) if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names clash with internal ones."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, h1 long, label string, block int, pos int"
    return spark.createDataFrame([(*r, 7, "x", 3, None) for r in corpus], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def texts(corpus):
    return {r[0]: r[1] for r in corpus}


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def repeated(spark):
    """Repeated rows, null ids and a null in every column."""
    text = " ".join(f"word{i}" for i in range(120))
    rows = [(1, text, "en", "a", 1)] * 3 + [(2, text, None, None, None), (None, text, "en", "a", 1), (None, None, None, None, None), (4, None, "en", "a", 0), (5, "short", None, "b", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
