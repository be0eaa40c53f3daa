"""Hard-negative mining with rotated one-bit codes.

Anchors are searched against all rows, in blocks. A vector ``o`` is rotated
(sign flips and Walsh-Hadamard transforms, so lengths and inner products stay)
and its signs are its code, the unit vector ``x``. Stored beside the code are
the alignment ``a = <x, o>`` and the length ``r`` of what the code leaves out. For an
anchor ``q``, quantised to ``BITS`` bit planes, ``b = <x, q>`` is a sum of popcounts,
and by Cauchy-Schwarz

    <q, o> = a * b + d,   |d| <= r * sqrt(|q|^2 - b^2)

(plus the quantisation's own length times ``|o|``), so every estimate comes with a
sure interval. Only pairs whose interval reaches the wanted range, and the best
that are already certain, are scored as integers; the result is exact.

1. ``coded``: integer vectors and their codes, written once, dealt evenly over
   tasks whatever their labels or ids.
2. For a block of at most ``BLOCK`` anchors (broadcast; the bound holds at every
   size of the table) one pass finds each anchor's best rows of the same label,
   and a second one its best rows of other labels in every positive's band.
   A task keeps and emits its own best only; they are ranked by anchor after.

A block's passes read the coded table where it lies, so no vector is shuffled
after step 1, and neither a frequent label nor a frequent id gathers anywhere.

Cases: rows with a null id, label or vector, a null or non-finite component, or
a squared length over 2^62 (no 64-bit score) take no part; shorter vectors are
filled with zeros; empty vectors score 0; rows that repeat an id are rows of
their own, but never partners of each other; an anchor without positives, or a
positive without negatives, gives no row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.common import save
from tableload.session import scratch_dir

#: Anchors searched in one pass over the table.
BLOCK = 16_384
#: Bit planes of a quantised anchor, and the seed of the rotation.
BITS, SEED = 8, 11
#: Rows a task holds when the table is large, and the least that are worth a task of their own.
TASK_ROWS, LEAST_ROWS = 65_536, 2_048
#: Cells of one tile: rows times anchors.
TILE_ROWS, TILE_ANCHORS = 2_048, 256
#: What rounding in the rotation and the bounds can add, relative to both lengths.
SLACK = 1e-9


def rotation(dim: int) -> np.ndarray:
    """Orthogonal dim x dim matrix (dim a power of two): three rounds of sign flips and Walsh-Hadamard transforms."""
    signs = np.random.default_rng(SEED).integers(0, 2, (3, dim)) * 2.0 - 1.0
    m = np.eye(dim)
    for flip in signs:
        m = m * flip
        width = 1
        while width < dim:
            pairs = m.reshape(dim, dim // (2 * width), 2, width)
            m = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(dim, dim)
            width *= 2
        m = m / np.sqrt(dim)
    return m


def padded(dim: int) -> int:
    """Smallest power of two from 64 on that holds ``dim`` components."""
    return max(64, 1 << max(0, dim - 1).bit_length())


def words_of(bits: np.ndarray) -> np.ndarray:
    """(n, dim) booleans as (n, dim / 64) words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, alignments and residual lengths of integer vectors."""
    turned = vectors.astype(np.float64) @ turn
    align = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    square = np.einsum("ij,ij->i", turned, turned)
    return words_of(turned > 0), align, np.sqrt(np.maximum(square - align * align, 0.0))


class Anchors:
    """A block of anchors: integer vectors and the bit planes of their rotated, quantised form."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        turned = vectors.astype(np.float64) @ rotation(vectors.shape[1])
        dim = turned.shape[1]
        self.base = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.base) / (2**BITS - 1), 1e-300)
        level = np.clip(np.rint((turned - self.base[:, None]) / self.step[:, None]), 0, 2**BITS - 1)
        near = self.base[:, None] + self.step[:, None] * level
        self.planes = np.stack([words_of((level.astype(np.int64) >> j & 1).astype(bool)) for j in range(BITS)])
        self.total = near.sum(axis=1)
        self.square = np.einsum("ij,ij->i", near, near)
        self.off = np.linalg.norm(turned - near, axis=1)
        self.length = np.linalg.norm(turned, axis=1)
        self.root = np.sqrt(dim)

    def bounds(self, rows: Rows, at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Sure (lower, upper) bounds of the scores of all rows with the anchors ``at``."""
        dot = np.zeros((len(rows.ids), at.stop - at.start))
        for j in range(BITS):
            for w in range(rows.code.shape[1]):
                dot += np.bitwise_count(rows.code[:, w, None] & self.planes[j, None, at, w]).astype(np.float64) * 2.0**j
        # the code's components are +-1 / root; dot is the sum of levels where it is positive
        b = (2 * (self.base[at] * rows.ones[:, None] + self.step[at] * dot) - self.total[at]) / self.root
        half = rows.resid[:, None] * np.sqrt(np.maximum(self.square[at] - b * b, 0.0))
        half += rows.length[:, None] * (self.off[at] + SLACK * self.length[at]) + SLACK
        middle = rows.align[:, None] * b
        return middle - half, middle + half


class Rows:
    """A slice of the coded table as arrays."""

    def __init__(self, pdf: pd.DataFrame, dim: int):
        self.ids, self.labels = pdf["vec_id"].to_numpy(np.int64), pdf["label"].to_numpy(np.int64)
        self.vectors = np.frombuffer(b"".join(pdf["v"]), "<i4").reshape(-1, dim)
        self.code = np.frombuffer(b"".join(pdf["code"]), "<u8").reshape(-1, dim // 64)
        self.align, self.resid = pdf["align"].to_numpy(np.float64), pdf["resid"].to_numpy(np.float64)
        self.length = np.hypot(self.align, self.resid)
        self.ones = np.bitwise_count(self.code).sum(axis=1).astype(np.float64)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every group, by falling score and rising id."""
    order = np.lexsort((ids, -score, group))
    first = np.r_[True, group[order][1:] != group[order][:-1]] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


class Best:
    """The first ``k`` (score, id) of every group seen so far."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(groups, -np.inf)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = np.r_[self.group, group], np.r_[self.score, score], np.r_[self.ids, ids]
        keep = best(group, score, ids, self.k)
        self.group, self.score, self.ids = group[keep], score[keep], ids[keep]
        full, counts = np.unique(self.group, return_counts=True)
        last = np.cumsum(counts) - 1
        self.least[full[counts == self.k]] = self.score[last[counts == self.k]]


def kth_sure(lower: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest lower bound of every column (-inf with fewer)."""
    if lower.shape[0] < k:
        return np.full(lower.shape[1], -np.inf)
    return np.partition(lower, lower.shape[0] - k, axis=0)[lower.shape[0] - k]


def exact(anchors: Anchors, a: np.ndarray, rows: Rows, r: np.ndarray) -> np.ndarray:
    """Integer scores of pairs (a[i], r[i])."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 65_536):
        at = slice(i, i + 65_536)
        out[at] = np.einsum("ij,ij->i", anchors.vectors[a[at]].astype(np.int64), rows.vectors[r[at]].astype(np.int64))
    return out


def tiles(batches: Iterator[pd.DataFrame], anchors: Anchors) -> Iterator[tuple[Rows, slice]]:
    for pdf in batches:
        for i in range(0, len(pdf), TILE_ROWS):
            rows = Rows(pdf.iloc[i : i + TILE_ROWS], anchors.vectors.shape[1])
            for j in range(0, len(anchors.ids), TILE_ANCHORS):
                yield rows, slice(j, min(j + TILE_ANCHORS, len(anchors.ids)))


def _frame(found: dict[int, Best], slots: int, name: str) -> pd.DataFrame:
    """All groups of all anchor tiles, numbered over the whole block."""
    parts = list(found.items())
    empty = [np.zeros(0, np.int64)]
    return pd.DataFrame(
        {
            name: np.concatenate(empty + [f.group + start * slots for start, f in parts]),
            "score": np.concatenate(empty + [f.score for _, f in parts]),
            "vec_id": np.concatenate(empty + [f.ids for _, f in parts]),
        }
    )


def find_positives(batches: Iterator[pd.DataFrame], anchors: Anchors, k: int) -> Iterator[pd.DataFrame]:
    """(anchor, score, vec_id): the first ``k`` rows of each anchor's label in these batches."""
    found: dict[int, Best] = {}
    for rows, at in tiles(batches, anchors):
        own = found.setdefault(at.start, Best(at.stop - at.start, k))
        lower, upper = anchors.bounds(rows, at)
        fits = (rows.labels[:, None] == anchors.labels[at]) & (rows.ids[:, None] != anchors.ids[at])
        need = np.maximum(own.least, kth_sure(np.where(fits, lower, -np.inf), k))
        r, a = np.nonzero(fits & (upper >= need))
        own.add(a, exact(anchors, a + at.start, rows, r), rows.ids[r])
    yield _frame(found, 1, "anchor")


def find_negatives(batches: Iterator[pd.DataFrame], anchors: Anchors, wanted: np.ndarray, known: np.ndarray, k: int, low: int, high: int) -> Iterator[pd.DataFrame]:
    """(slot, score, vec_id): the first ``k`` rows of other labels in the band of each positive.

    ``wanted`` (anchors x positives) holds the positives' scores where ``known``; a slot is
    anchor * positives + positive. ``low`` and ``high`` are the band in hundredths.
    """
    slots = wanted.shape[1]
    aims = np.where(known, wanted, np.nan)
    bottom, top, spare = aims * low / 100, aims * high / 100, SLACK * np.abs(aims)
    found: dict[int, Best] = {}
    for rows, at in tiles(batches, anchors):
        own = found.setdefault(at.start, Best((at.stop - at.start) * slots, k))
        lower, upper = anchors.bounds(rows, at)
        fits = rows.labels[:, None] != anchors.labels[at]
        reach = np.zeros(fits.shape, bool)
        for j in range(slots):
            least, most, more = bottom[at, j], top[at, j], spare[at, j]
            sure = kth_sure(np.where(fits & (lower >= least + more) & (upper <= most - more), lower, -np.inf), k)
            need = np.maximum(own.least[j::slots], sure)
            reach |= fits & (upper >= least - more) & (lower <= most + more) & (upper >= need)
        r, a = np.nonzero(reach)
        score = exact(anchors, a + at.start, rows, r)
        for j in range(slots):
            inside = known[a + at.start, j] & in_band(score, wanted[a + at.start, j], low, high)
            own.add(a[inside] * slots + j, score[inside], rows.ids[r[inside]])
    yield _frame(found, slots, "slot")


def in_band(score: np.ndarray, aim: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * aim <= 100 * score <= high * aim, whole numbers throughout (scores over 2^55 as Python integers)."""
    if len(score) and max(np.abs(score).max(), np.abs(aim).max()) >= 2**55:
        score, aim = score.astype(object), aim.astype(object)
    return ((low * aim <= 100 * score) & (100 * score <= high * aim)).astype(bool)


def usable(vectors: DataFrame, id_col: Column, label: Column, components: Column) -> DataFrame:
    """(vec_id, label, x array<double>) of the rows that take part; ``components`` are whole numbers as doubles."""
    rows = vectors.select(id_col.cast("long").alias("vec_id"), label.cast("long").alias("label"), components.alias("x"))
    whole = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < 2.0**31))
    square = F.aggregate("x", F.lit(0.0), lambda s, e: s + e * e)
    return rows.where("vec_id is not null and label is not null and x is not null").where(whole).where(square <= 2.0**62)


def coded(rows: DataFrame, name: str = "coded-vectors") -> tuple[DataFrame, int]:
    """(vec_id, label, v, code, align, resid) written to the scratch folder, and the padded dimension."""
    n, longest = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    dim = padded(longest or 0)
    spark = rows.sparkSession
    parts = max(-(-n // TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)), 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(dim)
        for pdf in batches:
            for i in range(0, len(pdf), TILE_ROWS):
                part = pdf.iloc[i : i + TILE_ROWS]
                v = np.zeros((len(part), dim), "<i4")
                for row, x in zip(v, part["x"], strict=True):
                    row[: len(x)] = x
                code, align, resid = encode(v, turn)
                out = part[["vec_id", "label"]].copy()
                out["v"], out["code"] = [row.tobytes() for row in v], [row.tobytes() for row in code]
                out["align"], out["resid"] = align, resid
                yield out

    made = rows.repartition(parts).mapInPandas(run, "vec_id long, label long, v binary, code binary, align double, resid double")
    return save(made, name), dim


def _first(found: DataFrame, group: str, k: int) -> DataFrame:
    """``found`` with its rank in the group, first ``k`` only."""
    order = Window.partitionBy(group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(table: DataFrame, dim: int, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors of a ``coded`` table.

    A positive is one of the first ``positives`` other rows of an anchor's label; its negatives are the
    first ``negatives`` rows of other labels with low * positive_score <= 100 * score <= high * positive_score.
    """
    spark = table.sparkSession
    out = scratch_dir(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    rest = table.where(is_anchor).select("vec_id", "label", "v").toLocalIterator()
    while block := list(islice(rest, BLOCK)):
        vectors = np.frombuffer(b"".join(r["v"] for r in block), "<i4").reshape(-1, dim)
        ids, labels = (np.array([r[c] for r in block], np.int64) for c in ("vec_id", "label"))
        sent = spark.sparkContext.broadcast(Anchors(ids, labels, vectors))

        near = table.mapInPandas(lambda b, sent=sent: find_positives(b, sent.value, positives), "anchor long, score long, vec_id long")
        wanted, known, chosen = np.zeros((len(block), positives), np.int64), np.zeros((len(block), positives), bool), []
        for r in _first(near, "anchor", positives).collect():  # at most BLOCK * positives rows
            wanted[r["anchor"], r["rank"] - 1], known[r["anchor"], r["rank"] - 1] = r["score"], True
            chosen.append((r["anchor"] * positives + r["rank"] - 1, int(ids[r["anchor"]]), r["vec_id"], r["score"]))
        aims = spark.sparkContext.broadcast((wanted, known))

        hard = table.mapInPandas(
            lambda b, sent=sent, aims=aims: find_negatives(b, sent.value, *aims.value, negatives, low, high),
            "slot long, score long, vec_id long",
        )
        pairs = spark.createDataFrame(chosen, "slot long, anchor_id long, positive_id long, positive_score long")
        rows = _first(hard, "slot", negatives).join(pairs, "slot")
        rows.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
        sent.unpersist()
        aims.unpersist()
    return spark.read.schema(schema).parquet(out)
