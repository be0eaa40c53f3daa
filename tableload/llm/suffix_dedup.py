"""Suffix-array dedup: removes every byte covered by a ``WINDOW``-byte string that also starts anywhere else.

Strings that are equal must meet in one shard, whichever documents hold them.
So suffixes are sharded by content:

1. ``anchors``: in every run of WINDOW - K + 1 neighbouring K-byte grams the one
   with the smallest hash is an anchor, so every WINDOW-byte string holds an
   anchor, and equal strings hold equal ones. An anchor's context is the bytes
   of all WINDOW-byte strings around it.
2. Anchors found once cannot lie in a repeated string and are left out; equal
   contexts are aggregated to one with its count. A context found twice is
   repeated as a whole.
3. ``shard_windows``: where an anchor's contexts differ, one copy of each is
   sent to the anchor's shard. There a suffix array (induced sorting) and
   permuted common prefixes of all the contexts show which strings start with
   the same WINDOW bytes as another one, at another place.
4. A document's repeated windows come together, and the bytes they cover go.

An anchor with more than ``SHARD_CONTEXTS`` different contexts (a line that a
large part of the corpus shares) would make its shard grow with the corpus. Its
windows are dealt into classes of ``CLASS`` neighbouring starts; all windows of
a class hold the same bytes around the anchor, and these are the new shard key.
Its contexts are cut where the texts lie (``frequent_pieces``): texts are looked
through once more for these few anchors, and only what is cut is shuffled. So
the texts are shuffled once, however many contexts frequent anchors have.
A key that is still too frequent (the edge of a long shared passage) has its
windows counted by digest (map-side first), spread over all tasks.

Cases: null or empty text has no bytes; texts shorter than WINDOW lose nothing;
windows overlap and may lie in one document; every row is a document, whatever
its doc_id: rows with null or repeated doc_ids are told apart by their texts
(``keyed_rows``), and a text that several of them hold is repeated as a whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.common import save, text_of
from tableload.llm.suffix_array import permuted_lcp, suffix_array

WINDOW = 200
K = 64
#: Bytes an anchor's context reaches to its left and, from the anchor's start, to its right.
LEFT, RIGHT = WINDOW - K, WINDOW
SHARD_BYTES = 1_000_000
SHARD_CONTEXTS = SHARD_BYTES // (LEFT + RIGHT)
CLASS = -(-(LEFT + 1) // 4)
#: Bytes of texts handled as one array (a longer text is one array of its own).
BUFFER = 1 << 17

_RNG = np.random.default_rng(41_117)
_TABLES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = (0xD6E8FEB86659FD93, 0xA3B195354A39B70D)


def _powers(base: int, n: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006 - a cache a worker
    """base ** (0..n-1) modulo 2 ** 64."""
    have = _kept.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(16, int(n - 1).bit_length()), base, dtype=np.uint64)
        have[0] = 1
        have = _kept[base] = np.multiply.accumulate(have)
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLES[which][data] * _powers(_BASES[which], len(data)), out=out[1:])
    return out


def _span_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray, which: int) -> np.ndarray:
    """Hash of data[lo:hi] for arrays of bounds, independent of where the bytes lie."""
    back = _powers(pow(_BASES[which], -1, 2**64), len(sums))
    return _mix((sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over x[i : i + width] for every i, by doubling; the last width - 1 entries cover what is there."""
    done, out = 1, x
    while done * 2 <= width:
        out = out.copy()
        out[: len(out) - done] = best(out[: len(out) - done], out[done:])
        done *= 2
    if done < width and len(x) > width - done:
        rest = width - done
        out = np.append(best(out[: len(out) - rest], out[rest:]), out[len(out) - rest :])
    return out


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from every place on (fewer at the end)."""
    here = np.arange(len(data))
    return _span_hash(_sums(data, 0), here, np.minimum(here + K, len(data)), 0) | np.uint64(1)


def buffer_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document number, position, anchor hash, context hash) of the anchors of some texts of at least WINDOW bytes."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    end, here = ends[doc], np.arange(len(data))
    gram = _gram_hashes(data)
    inside = here + WINDOW <= end  # a whole window of one text starts here
    width = WINDOW - K + 1
    least = np.where(inside, _sliding(gram, width, np.minimum), np.uint64(0))
    # an anchor is the least of some window it lies in: the greatest of those windows' minima is its own hash
    back = _sliding(least[::-1], width, np.maximum)[::-1]
    at = np.flatnonzero((gram == back) & (here + K <= end))
    # of equal anchors in a row within a half run of grams, the first and the last are enough
    new = np.r_[True, (gram[at][1:] != gram[at][:-1]) | (doc[at][1:] != doc[at][:-1])]
    head = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] if len(at) else at
    cell = (at - head) // (width // 2)
    first = new | np.r_[True, cell[1:] != cell[:-1]]
    at = at[first | np.r_[first[1:], True]]
    begin = end[at] - np.array([len(t) for t in texts])[doc[at]] if len(at) else at
    lo, hi = np.maximum(at - LEFT, begin), np.minimum(at + RIGHT, end[at])
    # where the anchor lies in its context tells contexts apart that a text's end has cut
    context = _span_hash(_sums(data, 1), lo, hi, 1) ^ _mix((at - lo).astype(np.uint64))
    return doc[at], at - begin, gram[at].view(np.int64), context.view(np.int64)


def _buffers(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    ids, texts, size = [], [], 0
    for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
        data = text.encode("utf-8", "surrogatepass")
        if len(data) < WINDOW:
            continue
        ids.append(doc)
        texts.append(data)
        size += len(data)
        if size >= BUFFER:
            yield np.array(ids), texts
            ids, texts, size = [], [], 0
    if texts:
        yield np.array(ids), texts


def anchors(docs: DataFrame) -> DataFrame:
    """(a, c, doc_id, pos): anchor hash, context hash and place of every anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, texts in _buffers(pdf):
                number, pos, a, c = buffer_anchors(texts)
                yield pd.DataFrame({"a": a, "c": c, "doc_id": ids[number], "pos": pos.astype("int32")})

    return docs.mapInPandas(run, "a long, c long, doc_id long, pos int")


def frequent_pieces(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(a, doc_id, pos, lead, bytes): the contexts of the anchors whose hashes are ``frequent``, at every place."""
    wanted = np.sort(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for ids, texts in _buffers(pdf):
                # most texts have no such gram; anchors are chosen in the others only
                gram = _gram_hashes(np.frombuffer(b"".join(texts), dtype=np.uint8))
                at = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, gram), len(wanted) - 1)] == gram)
                some = np.unique(np.searchsorted(np.cumsum([len(t) for t in texts]), at, side="right"))
                if not len(some):
                    continue
                number, pos, a, _ = buffer_anchors([texts[i] for i in some])
                keep = np.isin(a.view(np.uint64), wanted)
                for i, p, h in zip(some[number[keep]], pos[keep].tolist(), a[keep].tolist(), strict=True):
                    lo = max(0, p - LEFT)
                    rows.append((h, int(ids[i]), p, p - lo, texts[i][lo : p + RIGHT]))
            yield pd.DataFrame(rows, columns=["a", "doc_id", "pos", "lead", "bytes"])

    return docs.select("doc_id", "text").mapInPandas(run, "a long, doc_id long, pos int, lead int, bytes binary")


def _hit_rows(pdf: pd.DataFrame, rows: np.ndarray, hits: list[np.ndarray]) -> pd.DataFrame:
    """(doc_id, pos, hits) of some rows of a shard; the types hold for no rows too."""
    place = pdf[["doc_id", "pos"]].iloc[rows].reset_index(drop=True)
    return place.assign(hits=pd.Series(hits, index=place.index, dtype=object))


def shard_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, pos, hits) of one shard's contexts: hits are the repeated window starts, relative to the anchor.

    ``pdf`` has a context a row: its bytes, doc_id, pos (the anchor's) and lead
    (the anchor's place in the bytes).
    """
    blobs = list(pdf["bytes"])
    size = np.array([len(b) for b in blobs])
    total = int(size.sum()) + len(blobs) + 1
    text = np.ones(total, dtype=np.uint16)  # 1 ends a context, 0 the text
    start = np.cumsum(size + 1) - (size + 1)
    text[-1] = 0
    for s, b in zip(start, blobs, strict=True):
        text[s : s + len(b)] = np.frombuffer(b, dtype=np.uint8).astype(np.uint16) + 2
    order = suffix_array(text)
    _, lcp = permuted_lcp(text, order, start, LEFT + RIGHT)
    which = np.repeat(np.arange(len(blobs)), size + 1)
    which = np.append(which, len(blobs) - 1)
    offset = np.arange(total) - start[which]
    # suffixes that share WINDOW bytes with their predecessor continue its run
    run = np.cumsum(np.r_[True, lcp[order[1:]] < WINDOW]) - 1
    valid = offset[order] + WINDOW <= size[which[order]]
    run, spot = run[valid], order[valid]
    own = which[spot]
    _, doc = np.unique(pdf["doc_id"].to_numpy(), return_inverse=True)
    place = doc[own].astype(np.int64) << 40 | (pdf["pos"].to_numpy()[own] - pdf["lead"].to_numpy()[own] + offset[spot])
    cut = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.empty(0, dtype=np.int64)
    if not len(cut):  # no context holds a whole window
        return _hit_rows(pdf, cut, [])
    # one place may lie in several contexts; a run is repeated when it holds two places
    twice = np.minimum.reduceat(place, cut) != np.maximum.reduceat(place, cut)
    hit = spot[np.repeat(twice, np.diff(np.r_[cut, len(run)]))]
    hit.sort()
    own = which[hit]
    edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(hit) else np.empty(0, dtype=np.int64)
    groups = np.split(offset[hit], edge[1:]) if len(hit) else []
    rows = own[edge]
    lead = pdf["lead"].to_numpy()
    return _hit_rows(pdf, rows, [(g - lead[r]).astype(np.int32) for g, r in zip(groups, rows, strict=True)])


def removed(data: bytes, starts: np.ndarray) -> tuple[bytes, int, int]:
    """(bytes left, bytes removed, maximal removed runs) of a text whose repeated windows start at ``starts``."""
    mark = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    gone = np.cumsum(mark[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _spread(hits: np.ndarray | None, pos: int, n: int) -> np.ndarray:
    """Window starts of one anchor: the listed ones, or all around it where none are listed."""
    if hits is not None:
        return pos + np.asarray(hits, dtype=np.int64)
    return np.arange(max(0, pos - LEFT), min(pos, n - WINDOW) + 1)


def _cut(joined: DataFrame) -> DataFrame:
    """The wanted contexts' bytes of (doc_id, text, want) rows; rows that want none give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text, want in zip(pdf["doc_id"], pdf["text"], pdf["want"], strict=True):
                data = text.encode("utf-8", "surrogatepass") if want is not None else b""
                for w in want if want is not None else ():
                    lo = max(0, w["pos"] - LEFT)
                    rows.append((w["a"], doc, w["pos"], w["pos"] - lo, data[lo : w["pos"] + RIGHT]))
            yield pd.DataFrame(rows, columns=["a", "doc_id", "pos", "lead", "bytes"])

    return joined.mapInPandas(run, "a long, doc_id long, pos int, lead int, bytes binary")


def _by_class(pieces: DataFrame) -> DataFrame:
    """Contexts of frequent anchors, cut into classes of windows keyed by the bytes that a class's windows share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, pos, lead, b in zip(pdf["doc_id"], pdf["pos"], pdf["lead"], pdf["bytes"], strict=True):
                for near in range(0, LEFT + 1, CLASS):
                    far = min(near + CLASS - 1, LEFT)  # window starts lie this far before the anchor
                    lo, hi = max(0, lead - far), min(lead - near, len(b) - WINDOW)
                    if lo <= hi:
                        core = xxhash.xxh3_64_intdigest(b[lead - near : lead - far + WINDOW], seed=near)
                        rows.append((core - (1 << 63), doc, pos, lead - lo, b[lo : hi + WINDOW]))
            yield pd.DataFrame(rows, columns=["a", "doc_id", "pos", "lead", "bytes"])

    return pieces.mapInPandas(run, "a long, doc_id long, pos int, lead int, bytes binary")


def _by_digest(pieces: DataFrame) -> DataFrame:
    """(doc_id, pos, hits) of contexts whose anchors are too frequent for one shard: every window counted by digest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (xxhash.xxh3_128_digest(b[i : i + WINDOW]), doc, pos, i - lead)
                for b, doc, pos, lead in zip(pdf["bytes"], pdf["doc_id"], pdf["pos"], pdf["lead"], strict=True)
                for i in range(len(b) - WINDOW + 1)
            ]
            yield pd.DataFrame(rows, columns=["digest", "doc_id", "pos", "hit"])

    split = save(pieces.mapInPandas(run, "digest binary, doc_id long, pos int, hit int"), "anchor-windows")
    place = F.struct("doc_id", (F.col("pos") + F.col("hit")).alias("start"))
    twice = split.groupBy("digest").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi")
    return split.join(save(twice.select("digest"), "anchor-twice"), "digest").groupBy("doc_id", "pos").agg(F.collect_list("hit").alias("hits"))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key, copies): ``key`` is one long a different document, ``copies`` how many rows hold it.

    The doc_id itself where it is unique; then nothing is joined. The others
    get numbers beyond all doc_ids, one for every (doc_id, text) there is.
    """
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ids = save(body.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select("doc_id"), "suffix-ids")
    if ids.isEmpty():
        return body.select("*", F.col("doc_id").alias("key"), F.lit(1).cast("long").alias("copies"))
    low, high = body.agg(F.min("doc_id"), F.max("doc_id")).first()
    beyond, way = ((high or 0) + 1, 1) if (high or 0) < 1 << 62 else (low - 1, -1)
    rows = body.withColumn("digest", F.md5(F.col("text").cast("binary")))
    same = ids.select(F.col("doc_id").alias("id"))
    some = rows.join(same, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    some = save(some.withColumn("number", F.lit(beyond) + way * F.monotonically_increasing_id()), "suffix-rows").withColumnsRenamed({"doc_id": "id", "digest": "of"})
    met = rows.join(some, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return met.select("doc_id", "text", F.coalesce("number", "doc_id").alias("key"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))


def repeated_windows(body: DataFrame) -> DataFrame:
    """(doc_id, pos, hits): anchors in rows with doc_id and text and their repeated window starts, relative to the anchor.

    hits is null where all windows around the anchor are repeated. Rows with one doc_id hold one text.
    """
    # one shuffle of the anchors, whatever their number: counted beside its own rows, no anchor is looked for again
    same = Window.partitionBy("a")
    found = anchors(body).withColumn("n", F.count(F.lit(1)).over(same)).where("n > 1").drop("n")
    found = save(found, "anchor-found")
    contexts = found.groupBy("a", "c").agg(F.count_distinct("doc_id", "pos").alias("n"), F.min(F.struct("doc_id", "pos")).alias("at"))
    contexts = save(contexts.select("a", "c", "n", "at.*"), "anchor-contexts")
    # a context found at two places: its windows are repeated at all its places, without any ordering
    copies = found.join(contexts.where("n > 1").select("a", "c"), ["a", "c"]).select("doc_id", "pos").distinct()

    mixed = contexts.withColumn("kinds", F.count(F.lit(1)).over(same)).withColumn("least", F.min("n").over(same))
    mixed = save(mixed.where("kinds > 1 and least = 1").select("a", "kinds", "doc_id", "pos"), "anchor-mixed")

    def pieces(rows: DataFrame) -> DataFrame:
        wanted = rows.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "a")).alias("want"))
        # a left join, so that this and the last step read one shuffle of the texts
        return _cut(body.join(wanted, "doc_id", "left"))

    def by_order(rows: DataFrame, n: int) -> DataFrame:
        shards = max(1, -(-n * (LEFT + RIGHT) // SHARD_BYTES))
        sharded = rows.withColumn("shard", F.pmod(F.xxhash64("a"), F.lit(shards)))
        return sharded.groupBy("shard").applyInPandas(shard_windows, "doc_id long, pos int, hits array<int>")

    hits = by_order(pieces(mixed.where(F.col("kinds") <= SHARD_CONTEXTS)), mixed.count())
    hits = hits.unionByName(copies.withColumn("hits", F.lit(None).cast("array<int>")))
    frequent = mixed.where(F.col("kinds") > SHARD_CONTEXTS)
    # one long for more than SHARD_CONTEXTS contexts
    often = np.array([r["a"] for r in frequent.select("a").distinct().collect()], dtype=np.int64).view(np.uint64)
    if not len(often):
        return hits
    chosen = frequent_pieces(body, often).join(frequent.select("a", "doc_id", "pos"), ["a", "doc_id", "pos"], "left_semi")
    classed = save(_by_class(chosen.select("doc_id", "pos", "lead", "bytes")), "anchor-classes")
    again = save(classed.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_CONTEXTS).select("a"), "anchor-class-often")
    hits = hits.unionByName(by_order(classed.join(again, "a", "left_anti"), classed.count()))
    return hits if again.isEmpty() else hits.unionByName(_by_digest(classed.join(again, "a", "left_semi")))


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    rows = keyed_rows(docs)
    body = rows.select(F.col("key").alias("doc_id"), "text", F.col("doc_id").alias("id"), "copies")
    # the same columns as there, so that both joins read one shuffle of the texts
    per = repeated_windows(body).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "hits")).alias("hits"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, own, copies in zip(pdf["text"], pdf["hits"], pdf["copies"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                kept, gone, spans = data, 0, 0
                if copies > 1 and len(data) >= WINDOW:
                    kept, gone, spans = b"", len(data), 1
                elif own is not None and len(own):
                    starts = np.concatenate([_spread(h["hits"], h["pos"], len(data)) for h in own])
                    if len(starts):
                        kept, gone, spans = removed(data, np.unique(starts))
                rows.append((len(data), gone, spans, hashlib.sha256(kept).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", pdf["id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            yield out

    return body.join(per, "doc_id", "left").mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
