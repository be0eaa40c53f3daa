"""Substring dedup by content-defined chunks.

A gear rolling hash over the last ``GRAM`` bytes cuts every text where it is
smaller than at the ``SIDE`` positions before and not larger than at those
after, and ``MAX_BYTES`` after the last cut at the latest. Such a cut depends on
nearby bytes only, so a passage has the same cuts wherever it stands, but for
``GRAM`` + ``SIDE`` bytes at its start and ``SIDE`` at its end. From every chunk on, the shortest sequence of chunks with at least
``MIN_RUN`` bytes is counted by digest over the whole corpus, so a run counts
only where another document holds it as a whole. Neighbouring sequences that
other documents hold are one repeated span. A sequence's first place (smallest
doc_id, then offset) keeps it; elsewhere its bytes go.

Texts are read once and are shuffled only by ``dedup_substrings``; the count
moves a digest and a place for each sequence, once. A passage that a third of
all documents share has a row for each of them in its digest's task, which are
sorted and read in order (spilled, not held); its other sequences lie in other tasks.

Cases: null or empty text has no chunks; a text shorter than MIN_RUN has no
repeated span; repeats within one document only are left; rows that repeat a doc_id must
repeat its text and count as one document; rows with a null doc_id are neither
compared nor cut; an empty table gives an empty result; other columns are
ignored by ``repeated_spans`` and kept by ``dedup_substrings``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.common import text_of

#: Bytes that the hash at a position depends on.
GRAM = 8
#: A cut has the smallest hash among as many positions on each side: 17 bytes apart on average.
SIDE = 8
MAX_BYTES = 64
#: Bytes a sequence of chunks has at least. Passages of 51 words have 101 bytes or more; the cuts' margins take the rest.
MIN_RUN = 64

_GEAR = np.random.default_rng(77_003).integers(0, 2**63, 256, dtype=np.uint64) << np.uint64(1)


def gear_hash(data: np.ndarray, gram: int = 64) -> np.ndarray:
    """The gear hash h = (h << 1) + G[byte] over the last ``gram`` bytes (a power of two, at most 64) at every byte.

    Built by doubling: the hash over 2k bytes is that over the last k plus that
    over the k before, shifted by k.
    """
    out, reach = _GEAR[data], 1
    while reach < gram:
        longer = out.copy()
        longer[reach:] += out[:-reach] << np.uint64(reach)
        out, reach = longer, reach * 2
    return out


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the bytes whose hash is a minimum among its neighbours; the first of equal hashes."""
    n = len(data)
    if n <= 2 * SIDE:
        return np.empty(0, dtype=np.int64)
    h = gear_hash(data, GRAM)
    least = h[: n - SIDE + 1].copy()  # of the SIDE hashes from each position on
    for k in range(1, SIDE):
        np.minimum(least, h[k : n - SIDE + 1 + k], out=least)
    middle = h[SIDE : n - SIDE]
    return np.flatnonzero((middle < least[: n - 2 * SIDE]) & (middle <= least[SIDE + 1 :])) + SIDE + 1


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text, ascending; the last is the text's length."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64)
    ends = np.r_[cuts(data), n]
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= MAX_BYTES:
        return ends
    parts = -(-gaps // MAX_BYTES)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + 1
    return np.minimum(np.repeat(ends - gaps, parts) + nth * MAX_BYTES, np.repeat(ends, parts))


def sequences(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int], list[int]]:
    """(edges, first, last, two 64-bit halves of the digests) of a text's sequences: chunks first to last - 1, bytes edges[first] to edges[last]."""
    edges = np.r_[0, chunk_ends(np.frombuffer(data, dtype=np.uint8))]
    last = np.searchsorted(edges, edges[:-1] + MIN_RUN)
    first = np.flatnonzero(last < len(edges))
    last = last[first]
    high, low = [], []
    for lo, hi in zip(edges[first].tolist(), edges[last].tolist(), strict=True):
        digest = xxhash.xxh3_128_intdigest(data[lo:hi])
        high.append((digest >> 64) - (1 << 63))
        low.append((digest & (1 << 64) - 1) - (1 << 63))
    return edges, first, last, high, low


def sequence_rows(docs: DataFrame) -> DataFrame:
    """(d1, d2, doc_id, lo, hi, first, last): digest, byte range and chunk numbers (last excluded) of every sequence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                cols: dict[str, list] = {c: [] for c in ("d1", "d2", "doc_id", "lo", "hi", "first", "last")}
                for doc, text in zip(pdf["doc_id"][at : at + 500], pdf["text"][at : at + 500], strict=True):
                    edges, first, last, high, low = sequences(text.encode("utf-8", "surrogatepass"))
                    cols["d1"] += high
                    cols["d2"] += low
                    cols["doc_id"] += [doc] * len(first)
                    cols["lo"] += edges[first].tolist()
                    cols["hi"] += edges[last].tolist()
                    cols["first"] += first.tolist()
                    cols["last"] += last.tolist()
                yield pd.DataFrame(cols)

    body = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return body.mapInPandas(run, "d1 long, d2 long, doc_id long, lo int, hi int, first int, last int")


def repeated_sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, lo, hi, first, last, holder): sequences found in two documents or more; the first place is the holder.

    A sequence is one row of five numbers in the only shuffle: windows over its digest tell
    how many documents hold it and which place is the first.
    """
    packed = sequence_rows(docs).select("d1", "d2", "doc_id", _pair("lo", "hi").alias("bytes"), _pair("first", "last").alias("chunks"))
    held = Window.partitionBy("d1", "d2")
    met = packed.withColumn("min_id", F.min("doc_id").over(held)).withColumn("max_id", F.max("doc_id").over(held)).where("min_id <> max_id")
    met = met.withColumn("at", F.min(F.when(F.col("doc_id") == F.col("min_id"), F.col("bytes"))).over(held))
    ends = [c for name, lo, hi in (("bytes", "lo", "hi"), ("chunks", "first", "last")) for c in _unpair(name, lo, hi)]
    return met.select("doc_id", *ends, ((F.col("doc_id") == F.col("min_id")) & (F.col("bytes") == F.col("at"))).alias("holder"))


def _pair(lo: str, hi: str) -> Column:
    """Two ints as one long, ordered by the first: the start and the (short) length."""
    return F.shiftleft(F.col(lo).cast("long"), 32) + (F.col(hi) - F.col(lo))


def _unpair(pair: str, lo: str, hi: str) -> list[Column]:
    start = F.shiftright(F.col(pair), 32)
    return [start.cast("int").alias(lo), (start + F.col(pair).bitwiseAND(0xFFFFFFFF)).cast("int").alias(hi)]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of sorted byte ranges; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for lo, hi in ranges:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, span_start, span_end, n_chunks, n_removed, gone): the repeated spans of every document that has any.

    Byte offsets; n_removed counts the span's bytes that have an earlier place
    elsewhere and go. A document's sequences come together (bounded by its length).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, found in zip(pdf["doc_id"], pdf["found"], strict=True):
                own = sorted({(f["lo"], f["hi"], f["first"], f["last"], f["holder"]) for f in found})
                gone = merged([(lo, hi) for lo, hi, *_, holder in own if not holder])
                at = cut = 0
                for start, end in merged([(lo, hi) for lo, hi, *_ in own]):
                    first = last = own[at][2]
                    while at < len(own) and own[at][0] < end:
                        last = max(last, own[at][3])
                        at += 1
                    to = cut
                    while to < len(gone) and gone[to][0] < end:
                        to += 1
                    part, cut = gone[cut:to], to
                    rows.append((doc, start, end, last - first, sum(hi - lo for lo, hi in part), [x for g in part for x in g]))
            yield pd.DataFrame(rows, columns=["doc_id", "span_start", "span_end", "n_chunks", "n_removed", "gone"])

    per = repeated_sequences(docs).groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi", "first", "last", "holder")).alias("found"))
    return per.mapInPandas(run, "doc_id long, span_start long, span_end long, n_chunks long, n_removed long, gone array<int>")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """The documents with the removed bytes of their repeated spans cut out of ``text``; other columns stay.

    A cut that splits a code point drops what is left of it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for text, cuts in zip(pdf["text"], pdf["__cuts"], strict=True):
                if cuts is not None:
                    data, parts, at = text.encode("utf-8", "surrogatepass"), [], 0
                    ranges = sorted((int(c[i]), int(c[i + 1])) for c in cuts for i in range(0, len(c), 2))
                    for lo, hi in ranges:
                        parts.append(data[at:lo])
                        at = hi
                    text = b"".join([*parts, data[at:]]).decode("utf-8", "ignore")
                texts.append(text)
            out = pdf.drop(columns=["__cuts"])
            out["text"] = texts
            yield out

    cuts = repeated_spans(docs).groupBy("doc_id").agg(F.collect_list("gone").alias("__cuts")).withColumnRenamed("doc_id", "__id")
    body = docs.withColumn("text", text_of())
    return body.join(cuts, F.col("doc_id") == F.col("__id"), "left").drop("__id").mapInPandas(run, docs.schema)
