"""Hard negatives, spelling variants and toxicity against brute force, and on nulls, ties, repeats and empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tableload.llm import hard_negatives, spelling_variants, toxicity

# 11 hard negatives


def vectors(n=420, dim=40, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 60, (12, dim))
    v = (centres[rng.integers(0, 12, n)] + rng.normal(0, 40, (n, dim))).astype(int)
    v[7::9] = v[6:-1:9][: len(v[7::9])]  # equal vectors: ties
    return [(i, int(rng.integers(0, 4)), v[i].tolist()) for i in range(n)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, x array<double>, code string, v int, anchor long")
    return hard_negatives.usable(df, F.col("vec_id"), F.col("label"), F.col("x"))


def found(spark, rows, anchors="vec_id % 100 = 0"):
    table, dim = hard_negatives.coded(frame(spark, [(i, y, None if x is None else [None if e is None else float(e) for e in x], "c", 1, 2) for i, y, x in rows]))
    got = hard_negatives.mine(table, dim, F.expr(anchors)).collect()
    return {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got}, len(got)


@pytest.mark.parametrize("block", [hard_negatives.BLOCK, 2])
def test_hard_negatives(spark, block, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)  # 2: five anchors take three passes
    rows = vectors()
    got, n = found(spark, rows)
    assert got == brute.hard_negatives(rows) and n == len(got) > 40


def test_bounds_are_sure():
    rng = np.random.default_rng(8)
    for dim, spread in ((64, 50), (128, 3), (256, 2000)):
        a, v = (rng.normal(0, spread, (n, dim)).astype("<i4") for n in (30, 300))
        a[0], v[0], v[1] = 0, 0, a[1]
        code, align, resid = hard_negatives.encode(v, hard_negatives.rotation(dim))
        pdf = hard_negatives.pd.DataFrame({"vec_id": range(300), "label": 0, "v": [r.tobytes() for r in v], "code": [r.tobytes() for r in code], "align": align, "resid": resid})
        anchors = hard_negatives.Anchors(np.arange(30), np.zeros(30, int), a)
        low, high = anchors.bounds(hard_negatives.Rows(pdf, dim), slice(0, 30))
        score = v.astype(np.int64) @ a.T.astype(np.int64)
        assert (low <= score).all() and (score <= high).all()
        length = np.linalg.norm(v, axis=1)[:, None] * np.linalg.norm(a, axis=1)[None, :]
        assert ((high - low)[2:, 1:] < 2 * length[2:, 1:]).all()  # tighter than Cauchy-Schwarz on the vectors


def test_hard_negatives_odd_rows(spark):
    rows = vectors(260)
    clean = brute.hard_negatives(rows)
    inf, nan = float("inf"), float("nan")
    odd = [(None, 1, [1] * 40), (500, None, [1] * 40), (600, 1, None), (700, 1, [None] + [1] * 39), (800, 1, [nan] * 40), (900, 1, [inf] * 40), (1000, 1, [2.0**31] * 40), (1100, 9, [2.0**30] * 40)]
    assert found(spark, rows + odd)[0] == clean
    assert found(spark, [])[1] == 0
    assert found(spark, [(0, 1, []), (1, 1, [3]), (2, 2, [])])[0] == {(0, 1, 1, 2, 0, 0)}  # empty vectors score 0
    short = [(0, 1, [10, 10]), (1, 1, [9, 9, 9]), (2, 2, [8, 9])]
    assert found(spark, short)[0] == {(0, 1, 1, 2, 180, 170)}
    # rows that repeat an id are rows of their own
    got, n = found(spark, [(100, 1, [10]), (1, 1, [10]), (2, 2, [9]), (2, 2, [9])])
    assert n == 2 and got == {(100, 1, 1, 2, 100, 90), (100, 1, 2, 2, 100, 90)}


def test_hard_negatives_large_scores(spark):
    big = 2**24 + 1
    rows = [(0, 1, [big, big]), (1, 1, [big, big]), (2, 2, [big, big]), (3, 2, [big, big - 1]), (4, 2, [big, big + 1])]
    assert found(spark, rows)[0] == brute.hard_negatives(rows)


# 12 spelling variants


def spelled(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants.spelling_variants(df).collect()}


@pytest.fixture(scope="module")
def misspelt():
    """Texts of a few hundred words, with edits of them in every place, chains of forms and ties."""
    rng = random.Random(9)
    letters = "abcdeéñßöxyz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(120)] + ["z" * 6, "z" * 7, "Übermut", "x" * 90, "x" * 91]
    bag = []
    for w in words:
        bag += [w] * rng.choice([2, 5, 30, 160])
        for _ in range(4):
            i, c = rng.randrange(len(w)), rng.choice(letters + "q÷")
            edit = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            bag += [edit] * rng.choice([5, 6, 31])
    bag += ["AAAAAAB"] * 6 + ["aaaaaac"] * 30 + ["aaaaaad"] * 30 + ["aaaaaa"] * 900 + ["short", "tiny"] * 50
    bag += ["kettexyz"] * 6 + ["kettexya"] * 40 + ["kettexba"] * 250
    rng.shuffle(bag)
    texts = [" ".join(bag[i : i + 40]) for i in range(0, len(bag), 40)] + [None, "", "123 -- ", "Ā" * 20]
    return [(3 * i, t) for i, t in enumerate(texts)] + [(None, "aaaaaa-" * 7)]


@pytest.mark.parametrize("limit", [spelling_variants.PASS_WORDS, 30])
def test_spelling_variants(spark, misspelt, limit, monkeypatch):
    monkeypatch.setattr(spelling_variants, "PASS_WORDS", limit)  # 30: several passes, crowded lengths in parts
    df = spark.createDataFrame([(*r, "w", 3, 1) for r in misspelt], "doc_id long, text string, word string, n int, h long")
    want = brute.spelling(misspelt)
    assert spelled(df) == want
    assert sum(v[0] is not None for v in want.values()) > 30 and any(v[0] != v[1] for v in want.values() if v[0])


def test_filters_hold_their_words(spark, misspelt):
    words = sorted(brute.spelling(misspelt))
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    counts = {}
    for w in words:
        counts[spelling_variants.shard_of(len(w))] = counts.get(spelling_variants.shard_of(len(w)), 0) + 1
    (units,) = spelling_variants.passes(counts)
    held = spelling_variants.filters(df, units)
    for w in words:
        total = spelling_variants.sums(spelling_variants.letters([w], len(w)))
        assert any(len(f.hold(total, len(w))) for f in held[spelling_variants.shard_of(len(w))])


def test_spelling_variants_odd_rows(spark, empty, repeated):
    assert spelling_variants.spelling_variants(empty).count() == 0
    # word100 ... lose their digits; the rest is too short or too rare
    assert spelled(repeated) == brute.spelling([(r["doc_id"], r["text"]) for r in repeated.collect()])
    assert spelled(spark.createDataFrame([(1, "abcdef " * 4)], "doc_id long, text string")) == {}


# 13 toxicity


def all_segments(score):
    """Maximal segments by their definition: recursively the best segment, then the two sides."""
    if not len(score) or max(score) <= 0:
        return []
    total = np.r_[0, np.cumsum(score)]
    best = max(((total[j] - total[i], -(j - i), -i, i, j) for i in range(len(score)) for j in range(i + 1, len(score) + 1)))
    i, j = best[3], best[4]
    return all_segments(score[:i]) + [(i, j)] + [(a + j, b + j) for a, b in all_segments(score[j:])]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(4)
    for _ in range(300):
        score = np.round(rng.normal(-0.2, 1, rng.integers(0, 40)), 3) + rng.uniform(0, 1e-4)
        got = toxicity.segments(score)
        assert [(a, b) for a, b, _ in got] == [(int(a), int(b)) for a, b in all_segments(score)]
        assert np.allclose([s for *_, s in got], [score[a:b].sum() for a, b, _ in got])


def test_features():
    found = toxicity.features([b"the loser, the", b"", "réeuxment x".encode(), b"the " + b"y" * 40])
    words = [found.data[a:b].decode() for a, b in zip(found.start, found.end)]
    assert words == ["the", "loser", "the", "réeuxment", "x", "the", "y" * 40]
    assert found.text.tolist() == [0, 0, 0, 2, 2, 3, 3]
    assert (found.bucket[0] == found.bucket[5]).all() and len(set(found.bucket[0])) == 1  # no prefix of three bytes of its own
    other = toxicity.features(["réeuxaux".encode()])
    assert (other.bucket[0, 1:] == found.bucket[3, 1:]).all() and other.bucket[0, 0] != found.bucket[3, 0]
    assert toxicity.features([]).bucket.shape == (0, 4) and toxicity.features([b""]).bucket.shape == (0, 4)


@pytest.fixture(scope="module")
def judged(spark):
    """1,200 documents, a fifth of them with two to four insults; labels for most."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, truth = [], {}
    for i in range(1200):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        truth[i] = int(i % 5 == 0)
        for _ in range(rng.randint(2, 4) if truth[i] else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["vermin", "“Cretin”", "numbskull!", "vexquatz", "vexqu" + rng.choice(words)]))
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame([(*r, "s", 0.5) for r in rows], "doc_id long, text string, toxic string, score double").repartition(4)
    labels = spark.createDataFrame([(i, 1, y) for i, y in truth.items() if i % 7], "doc_id long, quality int, toxic int")
    return docs, labels, truth


def test_toxicity(spark, judged):
    import zlib

    docs, labels, truth = judged
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 1200
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [(truth[i], r["predicted"]) for i, r in got.items() if r["held_out"]]
    caught = sum(p for y, p in held if y) / sum(y for y, _ in held)
    spared = sum(not p for y, p in held if not y) / sum(not y for y, _ in held)
    assert caught > 0.95 and spared > 0.99
    # held-out labels teach nothing: turning them round changes no score
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, turned).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in got.items())


def test_toxic_passages(spark, judged):
    docs, labels, _ = judged
    model = toxicity.fit(toxicity.with_labels(docs, labels))
    quiet, said = "nothing to see here at all", "you vermin cretin vermin numbskull go"
    rows = [(1, quiet), (2, f"{quiet} {said} {quiet}"), (None, said), (3, None), (4, "")]
    got = toxicity.toxic_passages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sorted((r["doc_id"] or 0, r["passage"]) for r in got) == [(0, "vermin cretin vermin numbskull"), (2, "vermin cretin vermin numbskull")]
    assert all(r["expected"] <= toxicity.SIGNIFICANT and r["score"] > 0 for r in got)
    assert {r["start"] for r in got if r["doc_id"] == 2} == {7}


def test_toxicity_odd_rows(spark, empty, repeated):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(empty, none).count() == 0
    rows = toxicity.toxicity(repeated, none).collect()
    assert len(rows) == 8 and len({r["score"] for r in rows}) == 1 and all(r["predicted"] == 0 for r in rows)
    some = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 1, None), (4, 1, 0), (5, 1, 0), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(repeated, some).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False, False]
