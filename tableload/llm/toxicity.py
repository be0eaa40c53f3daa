"""Toxicity by maximum-scoring segments of token log-odds.

1. ``features``: a token is a run of letters and digits of the lower-cased text; its
   features are itself and its prefixes of ``PREFIXES`` bytes, which speak for
   tokens that training has seen too rarely. Features fall into ``BUCKETS`` hash buckets, so the model's
   size is fixed.
2. ``feature_counts``: for every bucket, over all documents: how many hold it, and how
   many of the labelled training documents, by label and fold.
3. ``log_odds``: how much likelier a bucket is in toxic documents than in others,
   with a Dirichlet prior of ``PRIOR`` features spread as in the whole corpus, moved
   ``Z`` standard errors towards 0. The feature furthest from 0 speaks for a token;
   ``DRIFT`` is taken off every token, so text without evidence scores
   below 0. A token that speaks for toxicity does so once a document, as it was counted.
4. ``segments``: every maximal segment of a text by a linear scan (Ruzzo and Tompa).
   The longer a text, the higher a segment it has by chance: with ``n`` tokens,
   E = k * n * exp(-lam * score) segments of that score (Karlin and Altschul). ``lam``
   solves the equation of the clean documents' token scores, ``k`` is the maximum-likelihood
   estimate from their best segments.
5. A document's evidence is the sum of -ln E over its segments with E < 1; a logistic
   curve of it, fitted on the training documents, is the score. For ``lam``, ``k`` and the
   curve each training document is scored with the log-odds of the other fold, not
   with those it helped to fit.

Labels are read from the training rows only, where ``crc32(doc_id as text) mod 4`` is
not 2, of about ``TRAIN_ROWS`` labels at most; that remainder, the sample and the fold choose rows and are not
inputs of a score. The labels are broadcast (the sample is their bound) and texts are
never shuffled: counts are added up by task before they are; the driver receives the counts of at most
BUCKETS buckets (12 MiB), a histogram of token scores, two numbers for ``k`` and at most
``EVIDENCE_BINS`` bins for the curve.

Cases: null or empty text, or text without tokens, has no segment and gets the
score of no evidence; very long texts are scanned whole; a document with several
labels is toxic if one says so; null labels and labels of unknown documents teach
nothing; a null doc_id is not held out and has no label; rows that repeat are
scored, and where labelled learned from, one by one; without toxic or without clean
training documents every score is the smoothed share of toxic ones; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableload.llm.common import save, text_of

BUCKETS = 1 << 18
#: Prefixes of a token that are features beside the token itself, in bytes of UTF-8.
PREFIXES = (3, 4, 6)
#: Labels learned from, chosen by a hash of the doc_id where there are more: 2 MiB, so they are sent to the texts and no text moves.
TRAIN_ROWS = 131_072
#: Features of the prior, standard errors taken off, and what every token costs.
PRIOR, Z, DRIFT = 1000.0, 1.0, 0.25
#: Segments expected by chance, from which on a passage is reported.
SIGNIFICANT = 0.05
#: Bins of the evidence that the curve is fitted on, and their width; the last takes all above.
EVIDENCE_BINS, BIN_WIDTH = 400, 0.25
#: Half the bins of the token-score histogram, and their width.
SCORE_BINS, SCORE_WIDTH = 160, 0.05
#: Score from which on a document is called toxic.
THRESHOLD = 0.3
#: Bytes of text whose features are made at once.
BUFFER = 1 << 22
#: Bytes that letters and digits consist of: ASCII ones, and all others once non-ASCII marks are blanked.
IN_TOKEN = np.array([chr(b).isalnum() or b >= 0x80 for b in range(128)] + [True] * 128)
#: Non-ASCII characters that are neither letters, digits nor accents.
MARK = r"[^\x00-\x7F\p{L}\p{N}\p{M}]"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Model:
    """Log-odds of the buckets, the two numbers of chance segments, and the curve."""

    odds: np.ndarray
    lam: float
    k: float
    start: float
    slope: float

    def evidence(self, n: int, spans: list[tuple[int, int, float]]) -> float:
        base = np.log(self.k * max(n, 1))
        return sum(max(self.lam * s - base, 0.0) for _, _, s in spans)

    def expected(self, n: int, score: float) -> float:
        """Segments of at least this score that a clean text of ``n`` tokens has by chance."""
        return self.k * max(n, 1) * float(np.exp(-self.lam * score))


def plain(text: Column) -> Column:
    """Lower-cased, non-ASCII marks and symbols blanked."""
    low = F.lower(text)
    return F.when(F.rlike(low, F.lit(MARK)), F.regexp_replace(low, MARK, " ")).otherwise(low)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Tokens:
    """Tokens of several texts: where they start and end in ``data``, their text's number, their buckets."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    bucket: np.ndarray


def features(texts: list[bytes]) -> Tokens:
    """Tokens of all texts; column 0 of the buckets is the token, the others its prefixes (the token where it is shorter).

    A token's key is its first 16 bytes, its last 8 and its length.
    """
    data = b" ".join(texts)
    raw = np.frombuffer(data + bytes(16), np.uint8)
    inside = IN_TOKEN[raw[: len(data)]] if data else np.zeros(0, bool)
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = end - start
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    text = np.searchsorted(begins, start, side="right") - 1

    def packed(at: np.ndarray, n: int, have: np.ndarray) -> np.ndarray:
        key = np.zeros(len(at), np.uint64)
        for i in range(n):
            key |= np.where(i < have, raw[np.minimum(at + i, len(raw) - 1)], 0).astype(np.uint64) << np.uint64(8 * i)
        return key

    first, last = packed(start, 8, size), packed(np.maximum(end - 8, start), 8, np.minimum(size, 8))
    whole = mix(first + mix(packed(start + 8, 8, size - 8) + mix(last + size.astype(np.uint64))))
    columns = [whole]
    for m in PREFIXES:
        key = mix((first & np.uint64((1 << 8 * m) - 1)) + mix(np.full(len(first), m, np.uint64)))
        columns.append(np.where(size > m, key, whole))
    bucket = np.stack(columns, axis=1) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return Tokens(data, start, end, text, bucket.astype(np.int32))


def buffers(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows of a batch with their texts, about BUFFER bytes together or one longer text."""
    texts, first, held = [], 0, 0
    for i, t in enumerate(pdf["text"]):
        data = t.encode("utf-8", "surrogatepass")
        if texts and held + len(data) > BUFFER:
            yield pdf.iloc[first:i], texts
            texts, first, held = [], i, 0
        texts.append(data)
        held += len(data)
    if texts:
        yield pdf.iloc[first:], texts


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fold): toxic is null where there is no label to learn from."""
    known = labels.where("toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("toxic"))
    known = save(known.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")), "toxicity-labels")
    n = known.count()
    if n > TRAIN_ROWS:
        known = known.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 31)) < int((1 << 31) * TRAIN_ROWS / n))
    rows = docs.select("doc_id", plain(text_of()).alias("text")).join(F.broadcast(known), "doc_id", "left")
    return rows.select("text", "toxic", "fold")


def feature_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(all documents of each bucket, training documents by label, fold and bucket)."""
    names = ["n", "n00", "n01", "n10", "n11"]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((5, BUCKETS), np.int64)
        for pdf in batches:
            for part, texts in buffers(pdf.assign(cell=cells(pdf))):
                found = features(texts)
                pairs = np.unique(found.text[:, None].astype(np.int64) * BUCKETS + found.bucket)
                cell, bucket = part["cell"].to_numpy()[pairs // BUCKETS], pairs % BUCKETS
                held[0] += np.bincount(bucket, minlength=BUCKETS)
                for c in range(1, 5):
                    held[c] += np.bincount(bucket[cell == c], minlength=BUCKETS)
        at = np.flatnonzero(held[0])
        yield pd.DataFrame({"bucket": at, **{c: held[i, at] for i, c in enumerate(names)}})

    each = rows.mapInPandas(count, "bucket long, " + ", ".join(f"{c} long" for c in names))
    found = each.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toPandas()  # BUCKETS rows at most
    held = np.zeros((5, BUCKETS))
    held[:, found["bucket"].to_numpy(np.int64)] = found[names].to_numpy(np.float64).T
    return held[0], held[1:].reshape(2, 2, BUCKETS)


def cells(pdf: pd.DataFrame) -> np.ndarray:
    """1 + 2 * toxic + fold of rows with a label, 0 for others."""
    known = pdf["toxic"].notna().to_numpy()
    cell = np.zeros(len(pdf), np.int64)
    cell[known] = 1 + 2 * pdf["toxic"][known].to_numpy().astype(bool) + pdf["fold"][known].to_numpy().astype(np.int64)
    return cell


def log_odds(everywhere: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log-odds of all buckets from the documents that hold them, less their standard errors."""
    if not clean.any() or not toxic.any():
        return np.zeros(BUCKETS, np.float32)
    prior = PRIOR * (everywhere + 1e-3) / (everywhere + 1e-3).sum()
    t, c = toxic + prior, clean + prior
    odds = np.log(t / (t.sum() - t)) - np.log(c / (c.sum() - c))
    return (np.sign(odds) * np.maximum(np.abs(odds) - Z * np.sqrt(1 / t + 1 / c), 0.0)).astype(np.float32)


def token_scores(found: Tokens, odds: np.ndarray) -> np.ndarray:
    """Score of every token: the feature furthest from 0, less DRIFT; a toxic token counts once a text."""
    said = odds[found.bucket]
    score = np.take_along_axis(said, np.abs(said).argmax(axis=1)[:, None], axis=1)[:, 0].astype(np.float64)
    up = np.flatnonzero(score > 0)
    _, first = np.unique(found.text[up].astype(np.int64) * BUCKETS + found.bucket[up, 0], return_index=True)
    again = np.ones(len(up), bool)
    again[first] = False
    score[up[again]] = 0.0
    return score - DRIFT


def decay(count: np.ndarray, score: np.ndarray) -> float:
    """The positive lam at which the mean of exp(lam * score) is 1, by bisection; one token of the highest score is added."""
    count = count.copy()
    count[-1] += 1

    def excess(lam: float) -> float:
        return float((count * np.exp(lam * score)).sum() / count.sum()) - 1.0

    low, high = 0.0, 1e-3
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal segments, in one pass over the tokens that score above 0.

    A candidate holds the cumulative scores before and after it and the nearest earlier candidate
    that begins lower; candidates in between begin higher, so the search can skip them.
    """
    rises = np.flatnonzero(score > 0)
    if not len(rises):
        return []
    total = np.cumsum(score, dtype=np.float64)
    before = (total[rises] - score[rises]).tolist()
    after = total[rises].tolist()
    kept: list[tuple[int, int, float, float, int]] = []
    for place, low, high in zip(rises.tolist(), before, after, strict=True):
        start, j = place, len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                break
            merged = j
            start, low, j = kept[j][0], kept[j][2], kept[j][4]
            del kept[merged:]
        kept.append((start, place + 1, low, high, j))
    return [(s, e, high - low) for s, e, low, high, _ in kept]


def spans_by_text(score: np.ndarray, text: np.ndarray, n: int) -> Iterator[tuple[int, int, list[tuple[int, int, float]]]]:
    """(first token, tokens, segments) of each of ``n`` texts."""
    bounds = np.searchsorted(text, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield a, b - a, segments(score[a:b])


def fit(rows: DataFrame) -> Model:
    """The model from ``with_labels`` rows."""
    everywhere, taught = feature_counts(rows)
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast([log_odds(everywhere, taught[0, 1 - f], taught[1, 1 - f]) for f in (0, 1)])

    def calibrate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(2 * SCORE_BINS + 1, np.int64)
        for pdf in batches:
            for fold, same in pdf.groupby("fold"):
                for part, texts in buffers(same):
                    found = features(texts)
                    score = token_scores(found, sent.value[int(fold)])
                    toxic = part["toxic"].to_numpy().astype(bool)
                    at = np.clip(np.rint(score[~toxic[found.text]] / SCORE_WIDTH), -SCORE_BINS, SCORE_BINS).astype(np.int64)
                    counts += np.bincount(at + SCORE_BINS, minlength=len(counts))
                    each = list(spans_by_text(score, found.text, len(part)))
                    yield pd.DataFrame({"toxic": toxic, "n": [max(n, 1) for _, n, _ in each], "spans": [[s for *_, s in spans] for *_, spans in each], "counts": None})
        yield pd.DataFrame({"toxic": [None], "n": [None], "spans": [None], "counts": [counts]})

    schema = "toxic boolean, n long, spans array<double>, counts array<long>"
    seen = save(rows.where("toxic is not null").mapInPandas(calibrate, schema), "toxicity-calibration")
    sent.unpersist()
    place = seen.where("counts is not null").select(F.posexplode("counts").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(2 * SCORE_BINS + 1)
    counts[place["bin"].to_numpy(np.int64)] = place["n"]
    ends = np.flatnonzero(counts)
    top = max(int(ends[-1]) if len(ends) else 0, SCORE_BINS + int(1 / SCORE_WIDTH))
    lam = decay(counts[: top + 1], (np.arange(top + 1) - SCORE_BINS) * SCORE_WIDTH)

    docs = seen.where("toxic is not null")
    best = lam * F.greatest(F.coalesce(F.array_max("spans"), F.lit(0.0)), F.lit(0.0))
    n, chance = docs.where("not toxic").agg(F.count("*"), F.sum(F.col("n") * F.exp(-best))).first()
    k = n / chance if n else 1.0
    level = F.aggregate("spans", F.lit(0.0), lambda a, s: a + F.greatest(lam * s - F.log(F.lit(k) * F.col("n")), F.lit(0.0)))
    bins = docs.groupBy(F.least(F.ceil(level / BIN_WIDTH), F.lit(EVIDENCE_BINS)).alias("bin")).agg(F.count(F.when(F.col("toxic"), 1)).alias("toxic"), F.count("*").alias("n"))
    found = bins.toPandas()
    start, slope = curve(found["bin"].to_numpy(np.float64) * BIN_WIDTH, found["toxic"].to_numpy(np.float64), found["n"].to_numpy(np.float64))
    return Model(log_odds(everywhere, taught[0].sum(axis=0), taught[1].sum(axis=0)), lam, k, start, slope)


def curve(x: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic intercept and slope by Newton steps; ten clean and one toxic document without evidence, and a weak pull of the slope to 1, are added."""
    x, toxic, n = np.r_[x, 0.0], np.r_[toxic, 1.0], np.r_[n, 11.0]
    at, design, pull = np.zeros(2), np.c_[np.ones(len(x)), x], np.diag([1e-9, 0.1])
    centre = np.array([0.0, 1.0])

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float((n * np.logaddexp(0, z) - toxic * z).sum() + 0.5 * (b - centre) @ pull @ (b - centre))

    for _ in range(100):
        p = sigmoid(design @ at)
        slope = design.T @ (n * p - toxic) + pull @ (at - centre)
        bend = (design * (n * p * (1 - p))[:, None]).T @ design + pull
        move, rate = np.linalg.solve(bend, slope), 1.0
        while loss(at - rate * move) > loss(at) and rate > 1e-6:
            rate /= 2
        at = at - rate * move
        if np.abs(move).max() < 1e-9:
            break
    return float(at[0]), max(float(at[1]), 0.0)


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, start, length, passage, score, expected): the significant segments, places counted in tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    body = docs.select("doc_id", plain(text_of()).alias("text"))
    kind = body.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            for part, texts in buffers(pdf):
                found = features(texts)
                rows, at = [], []
                for i, (a, n, spans) in enumerate(spans_by_text(token_scores(found, m.odds), found.text, len(part))):
                    for s, e, score in spans:
                        if m.expected(n, score) <= SIGNIFICANT:
                            passage = found.data[found.start[a + s] : found.end[a + e - 1]].decode("utf-8", "replace")
                            rows.append((s, e - s, passage, score, m.expected(n, score)))
                            at.append(i)
                out = part[["doc_id"]].iloc[at].reset_index(drop=True)
                yield out.join(pd.DataFrame(rows, columns=["start", "length", "passage", "score", "expected"]))

    return body.mapInPandas(run, f"doc_id {kind}, start int, length int, passage string, score double, expected double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages (significant ones) and evidence of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(with_labels(docs, labels)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            for part, texts in buffers(pdf):
                found = features(texts)
                each = list(spans_by_text(token_scores(found, m.odds), found.text, len(part)))
                out = part[["doc_id", "held_out"]].copy()
                out["evidence"] = np.array([m.evidence(n, spans) for _, n, spans in each], np.float64)
                out["score"] = sigmoid(m.start + m.slope * out["evidence"].to_numpy())
                out["predicted"] = (out["score"] >= THRESHOLD).astype("int32")
                out["n_passages"] = np.array([sum(m.expected(n, s) <= SIGNIFICANT for *_, s in spans) for _, n, spans in each], np.int32)
                yield out[["doc_id", "held_out", "score", "predicted", "n_passages", "evidence"]]

    body = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), plain(text_of()).alias("text"))
    kind = body.schema["doc_id"].dataType.simpleString()
    return body.mapInPandas(run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_passages int, evidence double")
